"""Pandas functions by key in Spark tasks.

Spark brings the rows of a key together in one sorted partition and marks the first of each; a task cuts its batches at
these marks. A key so costs a slice of a frame, not an Arrow stream of its own, and may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegralType, StructField, StructType

# Results of a task that are handed on together: at most so many frames, and rows before the last of them.
HELD_FRAMES, HELD_ROWS = 1000, 10_000


def _first(keys: list[str], order: list) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1


def _fills(field: StructField) -> bool:
    return isinstance(field.dataType, (IntegralType, BooleanType))


def _packed(fields: list[StructField], at: int, own: bool) -> list[Column]:
    """Columns c<n> and, of integers and booleans, n<n>: is null. These are filled, as one null changes a batch's type."""
    out = []
    for i, field in enumerate(fields, at):
        value = F.col(f"c{i}") if own else F.lit(None).cast(field.dataType)
        if _fills(field):
            out.append(F.coalesce(value, F.lit(0).cast(field.dataType)).alias(f"c{i}"))
            out.append((value.isNull() if own else F.lit(False)).alias(f"n{i}"))
        else:
            out.append(value.alias(f"c{i}"))
    return out


class _Side:
    """The columns of one input in a batch: frames of its rows, with the types Spark gives to these rows alone."""

    def __init__(self, batch: pd.DataFrame, fields: list[StructField], at: int) -> None:
        self.values = batch[[f"c{i}" for i in range(at, at + len(fields))]].copy()
        self.values.columns = [f.name for f in fields]
        nulls = [(i, batch[f"n{at + i}"].to_numpy()) for i, f in enumerate(fields) if _fills(f)]
        self.nulls = [(i, null) for i, null in nulls if null.any()]

    def rows(self, start: int, end: int) -> pd.DataFrame:
        out = self.values.iloc[start:end].reset_index(drop=True)
        for i, null in self.nulls:
            null = null[start:end]
            if null.any():
                value = out.iloc[:, i].to_numpy()
                out.isetitem(i, np.where(null, None, value) if value.dtype == bool else np.where(null, np.nan, value.astype(np.float64)))
        return out


def _cut(batches: Iterator[pd.DataFrame], sides: list[list[StructField]]) -> Iterator[tuple[int, list[pd.DataFrame]]]:
    """(number of the key, frames of its rows in the batch, one for each side)."""
    number = 0
    for batch in batches:
        begins = batch["first"].to_numpy()
        cuts = np.unique(np.r_[0, np.flatnonzero(begins), len(batch)]).tolist()
        begins = begins.tolist()
        ats = np.cumsum([0, *map(len, sides)]).tolist()
        made = [_Side(batch, fields, at) for fields, at in zip(sides, ats, strict=False)]
        second = np.r_[0, np.cumsum(batch["side"].to_numpy())].tolist()
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            number += int(begins[start])
            middle = end - (second[end] - second[start])
            spans = [(start, middle), (middle, end)]
            yield number, [side.rows(*span) for side, span in zip(made, spans, strict=False)]


def _together(frames: list[pd.DataFrame]) -> pd.DataFrame:
    filled = [frame for frame in frames if len(frame)] or frames[:1]
    return filled[0] if len(filled) == 1 else pd.concat(filled, ignore_index=True)


def _handed_on(results: Iterator[Any], names: list[str]) -> Iterator[Any]:
    """Frames of equal columns and types as one; those without rows are left out, others as they are for Spark to judge."""
    held: list = []
    rows, kind = 0, None
    for frame in results:
        if not isinstance(frame, pd.DataFrame):
            yield frame
            continue
        if not len(frame) and (not len(frame.columns) or set(frame.columns) == set(names)):
            continue
        now = [list(frame.columns), list(frame.dtypes)]
        if held and (now != kind or rows >= HELD_ROWS or len(held) >= HELD_FRAMES):
            yield _together(held)
            held, rows = [], 0
        held.append(frame)
        rows, kind = rows + len(frame), now
    if held:
        yield _together(held)


def apply_by_keys(frames: list[DataFrame], keys: list[str], order: list, schema: Any, call: Callable) -> DataFrame:
    """``call`` once for each value of the keys, null among them, in Spark tasks.

    It gets an iterator of lists, one frame for each of the one or two inputs, and gives an iterator of frames of
    ``schema``. One input comes in the order of ``order``.
    """
    sides = [frame.schema.fields for frame in frames]
    if any("struct<" in field.dataType.simpleString() for fields in sides for field in fields):
        return _apply_by_groups(frames, keys, order, schema, call)
    if len(frames) == 1:
        (frame,), (fields,) = frames, sides
        marked = frame.select("*", _first(keys, order or keys).alias("first")).toDF(*[f"c{i}" for i in range(len(fields))], "first")
        rows = marked.select("first", F.lit(0).alias("side"), *_packed(fields, 0, True))
    else:
        named = [f"k{i}" for i in range(len(keys))]
        parts = []
        for own, frame in enumerate(frames):
            at = own * len(sides[0])
            plain = frame.select(*keys, "*").toDF(*named, *[f"c{i}" for i in range(at, at + len(sides[own]))])
            packed = [c for s in (0, 1) for c in _packed(sides[s], s * len(sides[0]), s == own)]
            parts.append(plain.select(*named, F.lit(own).alias("side"), *packed))
        both = parts[0].unionByName(parts[1])
        rows = both.withColumn("first", _first(named, ["side"])).drop(*named)
    names = StructType.fromDDL(schema).fieldNames() if isinstance(schema, str) else schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def results() -> Iterator[pd.DataFrame]:
            for _, parts in groupby(_cut(batches, sides), key=lambda part: part[0]):
                yield from call(part[1] for part in parts)

        return _handed_on(results(), names)

    return rows.mapInPandas(run, schema)


def _apply_by_groups(frames: list[DataFrame], keys: list[str], order: list, schema: Any, call: Callable) -> DataFrame:
    """The same by Spark's own groups: numbers inside structs take a type from all rows of a batch, so a key needs its own."""
    if len(frames) == 2:
        left, right = (frame.groupBy(*keys) for frame in frames)
        return left.cogroup(right).applyInPandas(lambda a, b: next(call(iter([[a, b]]))), schema)

    def run(batches):
        return call([batch] for batch in batches)

    run.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    # rows of a key already lie together in order, which the grouping keeps
    return frames[0].repartition(*keys).sortWithinPartitions(*keys, *order).groupBy(*keys).applyInPandas(run, schema)


def whole_key(parts: Iterator[list[pd.DataFrame]], most: int, refuse: Callable[[], Exception]) -> list[pd.DataFrame]:
    """All rows of a key, a frame for each input; ``refuse`` gives the error for an input with more than ``most``."""
    held: list[list[pd.DataFrame]] = []
    sizes: list[int] = []
    for part in parts:
        held.append(part)
        sizes = [n + len(frame) for n, frame in zip(sizes or [0] * len(part), part, strict=True)]
        if max(sizes) > most:
            raise refuse()
    return [_together(list(frames)) for frames in zip(*held, strict=True)]
