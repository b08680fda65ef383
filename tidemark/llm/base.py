"""Shared helpers of the corpus operators: reading documents, bytes of Arrow batches, distributed prefix sums."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"

# A side of fixed-width columns is broadcast up to this many rows: under 16 MB at 64 bytes a row.
BROADCAST_ROWS = 200_000

SPLITS = "spark.sql.files.minPartitionNum"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors."""
    return materialize(df, label)[0]


def bounded_side(df: DataFrame, label: str) -> DataFrame:
    """A join side of fixed-width columns, written and counted: broadcast up to ``BROADCAST_ROWS`` rows, else merged."""
    table, rows = materialize(df, label)
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table.hint("merge")


# Physical operators that give the same rows in the same partitions and order each time.
_STEADY = {"AdaptiveSparkPlan", "WholeStageCodegen", "InputAdapter", "ColumnarToRow", "Project", "Filter", "Union", "FileScan", "Scan", "LocalTableScan"}


def settled(rows: DataFrame, label: str) -> DataFrame:
    """``rows``, if they come straight from a scan, else stored: after a shuffle, limit or function rows can change their places.

    Whoever reads places twice has to call this once before.
    """
    plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    operators = {found[1] for line in plan if "==" not in line and (found := re.match(r"[\s:+*()\d-]*([A-Za-z]+)", line))}
    return rows if operators <= _STEADY else stored(rows, label)


def placed(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (``settled`` ones) with their place (partition and position) as a number in column ``name``.

    Rows read from files are cut into as many partitions as the cores of the moment suggest, so a scan planned after an
    executor was lost would give other places. The number is therefore settled in the session the first time.
    """
    spark = rows.sparkSession
    if spark.conf.get(SPLITS, None) is None:
        spark.conf.set(SPLITS, str(spark.sparkContext.defaultParallelism))
    return rows.withColumn(name, F.monotonically_increasing_id())


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary or string Arrow column without a copy, and the offset of each row (one more than rows).

    Null rows have no bytes.
    """
    kind = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


_WHITE = np.zeros(256, bool)
_WHITE[list(b" \t\n\x0b\x0c\r")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words (``WORD``, A-Z in lower case) of the texts that ``offsets`` cut from ``data``, and where those of each text begin and end."""
    first, end = int(offsets[0]), int(offsets[-1])
    data, offsets = _LOWER[data[first:end]], offsets - first
    inside = ~_WHITE[data]
    filled = np.diff(offsets) > 0
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[heads] |= inside[heads]
    ends[:-1] &= ~inside[1:]
    ends[tails] |= inside[tails]
    starts = np.flatnonzero(begins)
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(np.flatnonzero(ends) - starts + 1, out=bounds[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
    return words.dictionary_encode(), np.searchsorted(starts, offsets)


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together, or of a single longer row."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def unit_hash(*columns: Column) -> Column:
    """A pseudorandom number from 0 to below 1 that depends on the columns only."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def with_prefix(df: DataFrame, group: str, unit: str, order: list[str], value: str | None = None) -> DataFrame:
    """Adds ``n`` (rows of the group), ``rank`` (from 0, by ``unit`` and ``order``), with ``value`` also ``total`` and ``start``.

    ``unit`` lies between 0 and 1 and must spread the rows of a group about evenly. A group of n rows is cut
    into sqrt(n) cells along it; cells are counted with map-side aggregation and ranked inside, so neither the
    window over the cells of a group nor the one over the rows of a cell holds more than about sqrt(n) rows.
    ``df`` is read three times: pass a stored, narrow table without null groups.
    """
    amount = F.col(value) if value else F.lit(0)
    totals = bounded_side(df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total")), "totals")
    cells = F.ceil(F.sqrt("n"))
    placed = df.join(totals, group).withColumn("_cell", F.least(F.floor(F.col(unit) * cells), cells - 1))
    per_cell = placed.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_rows"), F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = per_cell.select(
        group,
        "_cell",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum"),
    )
    inside = Window.partitionBy(group, "_cell").orderBy(unit, *order)
    ranked = placed.join(bounded_side(before, "cells"), [group, "_cell"]).withColumn(
        "rank", F.col("_rows") + F.row_number().over(inside) - 1
    )
    if value:
        above = inside.rowsBetween(Window.unboundedPreceding, -1)
        ranked = ranked.withColumn("start", F.col("_sum") + F.coalesce(F.sum(value).over(above), F.lit(0)))
    else:
        ranked = ranked.drop("total")
    return ranked.drop("_cell", "_rows", "_sum")
