"""Exact deduplication by Grace hashing: spill files by hash until a bucket fits an open-addressing table."""

from __future__ import annotations

import hashlib
import os
import pickle
import random
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from pathlib import Path

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import documents, placed, settled, stored, utf8

FIT_BYTES = 48 << 20  # of distinct content in one table
FAN_OUT_BITS = 4
HASH_BITS = 128
LOCAL_ROWS = 1 << 19  # of a task that are grouped together before the shuffle


class ContentTable:
    """Distinct contents by open addressing with linear probing; equal means all bytes are equal."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def add(self, digest: int, content: bytes) -> int:
        """The number of the content, given in order of arrival."""
        if 2 * len(self.contents) >= len(self.slots):
            self._grow()
        mask = len(self.slots) - 1
        at = digest & mask
        while (found := self.slots[at]) >= 0:
            if self.hashes[found] == digest and self.contents[found] == content:
                return found
            at = (at + 1) & mask
        self.slots[at] = len(self.contents)
        self.hashes.append(digest)
        self.contents.append(content)
        return len(self.contents) - 1

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for number, digest in enumerate(self.hashes):
            at = digest & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = number


def _spill_root() -> str | None:
    """One of the folders in which this executor keeps its shuffle and spill files; None outside of Spark."""
    return random.choice([d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if d] or [None])


def content_hash(content: bytes) -> int:
    return xxhash.xxh3_128_intdigest(content)


def classes(records: Iterable[tuple[bytes, tuple]], fit_bytes: int = FIT_BYTES, hash_of=content_hash) -> Iterator[tuple[bytes, list[tuple]]]:
    """Each distinct content with the rows that have it.

    Records are kept in memory up to ``fit_bytes``; beyond that all go to spill files by the first bits of their hash,
    and each file is treated likewise by the next bits. A file whose hashes are used up is read straight into the
    table, which holds each content once. Files lie beside Spark's own spill files, in a folder that no other task reads
    and that is removed when this one ends; a task that runs again, wherever that is, makes its own.
    """
    root = _spill_root()
    if root is not None:
        Path(root).mkdir(parents=True, exist_ok=True)
    folder = tempfile.mkdtemp(prefix="grace-", dir=root)
    try:
        yield from _bucket(((hash_of(c), c, row) for c, row in records), 0, fit_bytes, Path(folder))
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def _bucket(records: Iterator[tuple[int, bytes, tuple]], used_bits: int, fit_bytes: int, folder: Path) -> Iterator[tuple[bytes, list[tuple]]]:
    table, rows, held = ContentTable(), [], 0
    for digest, content, row in records:
        number = table.add(digest >> used_bits, content)
        if number == len(rows):
            rows.append([])
            held += len(content) + 200
        rows[number].append(row)
        if held > fit_bytes and len(rows) > 1 and used_bits < HASH_BITS:
            break
    else:
        yield from zip(table.contents, rows, strict=True)
        return
    files: dict[int, object] = {}
    mask = (1 << FAN_OUT_BITS) - 1

    def spill(rest: int, content: bytes, some: list[tuple]) -> None:
        part = rest & mask
        if part not in files:
            files[part] = (folder / f"{used_bits}-{part}").open("wb")
        pickle.dump((rest >> FAN_OUT_BITS, content, some), files[part], pickle.HIGHEST_PROTOCOL)

    for rest, content, some in zip(table.hashes, table.contents, rows, strict=True):
        spill(rest, content, some)
    del table, rows
    for digest, content, row in records:
        spill(digest >> used_bits, content, [row])
    for part in sorted(files):
        files[part].close()
        path, inner = folder / f"{used_bits}-{part}", folder / f"in-{used_bits}-{part}"
        inner.mkdir()
        yield from _bucket(_read(path, used_bits + FAN_OUT_BITS), used_bits + FAN_OUT_BITS, fit_bytes, inner)
        path.unlink()


def _read(path: Path, used_bits: int) -> Iterator[tuple[int, bytes, tuple]]:
    with path.open("rb") as file:
        while True:
            try:
                rest, content, rows = pickle.load(file)
            except EOFError:
                return
            for row in rows:
                yield rest << used_bits, content, row


_LOCAL = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("leader", pa.int64()), ("content", pa.binary()), ("sha256", pa.string()), ("copies", pa.int64()), ("top_id", pa.int64()), ("top_rid", pa.int64())])
_FINAL = pa.schema([("leader", pa.int64()), ("keep_id", pa.int64()), ("keep_rid", pa.int64()), ("group_size", pa.int64())])


def _batched(rows: Iterator[tuple], schema: pa.Schema, limit: int = 16 << 20, content: int | None = None) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 100 + (len(row[content] or b"") if content is not None else 0)
        if size > limit:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _rank(row: tuple) -> tuple:
    """Order in which rows of equal text stay: the largest id, null ids last, then the last row."""
    return row[0] is not None, row[0] or 0, row[1]


def _local(fit_bytes: int, most_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[bytes, tuple]]:
            for b in batches:
                for rid, doc_id, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                    yield content.as_py(), (doc_id, rid)

        def parts() -> Iterator[tuple[bytes, list[tuple]]]:
            left = records()
            for first in left:  # many empty or equal texts are few bytes: rows are bounded too
                yield from classes(chain([first], islice(left, most_rows - 1)), fit_bytes)

        def out() -> Iterator[tuple]:
            for content, rows in parts():
                top, sha = max(rows, key=_rank), hashlib.sha256(content).hexdigest()
                leader = rows[0][1]
                for doc_id, rid in rows:
                    first = rid == leader
                    yield (rid, doc_id, leader, content if first else None, sha, len(rows) if first else None, top[0] if first else None, top[1] if first else None)

        yield from _batched(out(), _LOCAL, content=3)

    return run


def _across(fit_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[bytes, tuple]]:
            for b in batches:
                rest = [b.column(i).to_pylist() for i in (1, 2, 3, 4)]
                for content, leader, copies, top_id, top_rid in zip(b.column(0), *rest, strict=True):
                    yield content.as_py(), (top_id, top_rid, leader, copies)

        def out() -> Iterator[tuple]:
            for _, rows in classes(records(), fit_bytes):
                top, size = max(rows, key=_rank), sum(r[3] for r in rows)
                for row in rows:
                    yield row[2], top[0], top[1], size

        yield from _batched(out(), _FINAL)

    return run


def groups(rows: DataFrame, text: str = "text", key: str = "doc_id", fit_bytes: int = FIT_BYTES, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Per row: rid (its place), doc_id, keep_id, group_size, kept, text_sha256. Of rows with equal text the one with the largest id stays.

    Each task first groups its own rows, ``local_rows`` at a time, so a text held by a third of all rows leaves it once
    for each such part; only these leaders, with their counts, are shuffled by hash and grouped again, and the rows find their group through their leader.

    Null texts count as empty, and all empty texts are equal. Of rows that share text and id exactly one stays; a
    null id stays only where no other is there. Texts of any length are compared whole. An empty table gives no rows.
    """
    own = placed(rows, "_exact_rid").select(F.col("_exact_rid").alias("rid"), F.col(key).cast("long").alias("doc_id"), utf8(text).alias("content"))
    local = stored(own.mapInArrow(_local(fit_bytes, local_rows), "rid long, doc_id long, leader long, content binary, sha256 string, copies long, top_id long, top_rid long"), "local-classes")
    leaders = local.filter("copies IS NOT NULL").select("content", "leader", "copies", "top_id", "top_rid")
    final = leaders.repartition(F.xxhash64("content")).mapInArrow(_across(fit_bytes), "leader long, keep_id long, keep_rid long, group_size long")
    return local.select("rid", "doc_id", "leader", "sha256").join(final, "leader").select(
        "rid", "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), F.col("sha256").alias("text_sha256")
    )


def distinct_rows(rows: DataFrame, text: str = "text", key: str = "doc_id", fit_bytes: int = FIT_BYTES) -> DataFrame:
    """The rows that stay, with all their columns: one for each text. Cases as in ``groups``.

    Rows are found again by their place; those that don't come straight from a scan are stored first.
    """
    rows = settled(rows, "settled")
    kept = groups(rows, text, key, fit_bytes).filter("kept").select(F.col("rid").alias("_exact_rid"))
    return placed(rows, "_exact_rid").join(kept.hint("merge"), "_exact_rid", "left_semi").drop("_exact_rid")


def op7_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return groups(documents(spark, sf_dir)).drop("rid")


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
