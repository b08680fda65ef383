"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs, subtracted and peeled."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import documents, stored, utf8

CELLS = 15  # of the written fingerprint
HASHES = 3
GROWTH = 4
CUT = 8  # a paragraph of running text has about so many words
LONG_WORD, PIECE, BEFORE = 64, 4, 8  # a word of more bytes is cut into pieces of about so many characters, by the bytes before a cut
CHUNK_BYTES = 1 << 20
RANGE_BYTES = 8 << 20
MOST_RANGES = 100_000  # beyond it ranges grow; they are streamed, and their bounds are broadcast

_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_PRIME = np.uint64(0x100000001B3)
_POWERS = np.cumprod(np.full(LONG_WORD, _PRIME))
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mix(x: np.ndarray, seed: np.uint64) -> np.ndarray:
    x = (x ^ seed) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inner_starts(data: np.ndarray, blank: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where words of more than ``LONG_WORD`` bytes are cut: at characters chosen by a hash of the ``BEFORE`` bytes before."""
    long = first[np.diff(np.r_[first, len(data)]) > LONG_WORD]
    blanks = np.flatnonzero(blank) if len(long) else long
    size = blanks[np.searchsorted(blanks, long)] - long
    long, size = long[size > LONG_WORD], size[size > LONG_WORD] - BEFORE
    if not len(long):
        return long
    at = np.repeat(long + BEFORE - (np.cumsum(size) - size), size) + np.arange(size.sum())
    at = at[(data[at] & 0xC0) != 0x80]
    before = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, BEFORE)[at - BEFORE]).view("<u8")[:, 0]
    return at[_mix(before, _SEEDS[1]) % np.uint64(PIECE) == 0]


def paragraph_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the paragraphs of all texts, and the text of each key.

    A paragraph ends at a newline, and after each word whose hash is a multiple of ``CUT``, so that long lines are cut
    at places which an edit elsewhere doesn't move. Words of more than ``LONG_WORD`` bytes, such as lines without white
    space, are cut into pieces, which count as words but differ from words of their own. Each byte counts with its place.
    A paragraph that a text repeats has another key each time.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    blank = _SPACE[data]
    first = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inner = _inner_starts(data, blank, first)
    if len(inner):
        first = np.sort(np.concatenate([first, inner]))
    inside = np.arange(len(data), dtype=np.int64)
    run = np.diff(np.r_[first, len(data)])
    tail = slice(first[0], None)
    inside = inside[tail] - np.repeat(first, run)
    powers = _POWERS
    if run.max() > LONG_WORD and (longest := int(inside.max(where=~blank[tail], initial=0)) + 1) > LONG_WORD:
        powers = np.cumprod(np.full(longest, _PRIME))
    letters = np.where(blank[tail], np.uint64(0), (data[tail].astype(np.uint64) + np.uint64(1)) * powers[np.minimum(inside, len(powers) - 1)] + (inside.astype(np.uint64) << np.uint64(7)))
    sums = np.add.reduceat(letters, first - first[0])
    sums[np.searchsorted(first, inner)] ^= _SEEDS[2]
    words = _mix(sums, _SEEDS[0])
    lines = np.add.reduceat((data[tail] == 10).astype(np.int32), first - first[0])
    ends = (lines > 0) | (words % np.uint64(CUT) == 0)
    ends[-1] = True
    last = np.flatnonzero(ends)
    begin = np.r_[0, last[:-1] + 1]
    place = np.arange(len(words)) - np.repeat(begin, last - begin + 1)
    digest = _mix(np.add.reduceat(_mix(words + place.astype(np.uint64) * _SEEDS[1], _SEEDS[2]), begin), _SEEDS[3])
    owner = np.searchsorted(np.cumsum(lengths), first[begin], "right")
    order = np.lexsort((digest, owner))
    same = np.r_[False, (digest[order][1:] == digest[order][:-1]) & (owner[order][1:] == owner[order][:-1])]
    heads = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    again = np.zeros(len(order), np.uint64)
    again[order] = (np.arange(len(order)) - heads).astype(np.uint64)
    return _mix(digest + again * _SEEDS[4], _SEEDS[0]), owner


def _places(keys: np.ndarray, cells: int) -> np.ndarray:
    """The cells of each key, one in each third of the table."""
    part = np.uint64(cells // HASHES)
    return np.stack([(_mix(keys, _SEEDS[k] + np.uint64(cells)) % part).astype(np.int64) + k * (cells // HASHES) for k in range(HASHES)])


class Sketches:
    """Tables of ``cells`` cells, one for each document: counts, xor of keys, xor of the keys' checks."""

    def __init__(self, keys: np.ndarray, owner: np.ndarray, documents: int, cells: int) -> None:
        self.cells, self.documents = cells, documents
        self.count = np.zeros(documents * cells, np.int64)
        self.key = np.zeros(documents * cells, np.uint64)
        self.check = np.zeros(documents * cells, np.uint64)
        self._toggle(keys, owner, np.ones(len(keys), np.int64))

    def _toggle(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray) -> None:
        checks = _mix(keys, _SEEDS[4])
        for place in _places(keys, self.cells):
            at = owner * self.cells + place
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, checks)

    def minus(self, other: Sketches) -> Sketches:
        """The sketches of the differences, document by document."""
        out = Sketches(np.zeros(0, np.uint64), np.zeros(0, np.int64), self.documents, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Takes keys out of cells that hold a single one until none is left: (keys, documents, signs, whole).

        ``whole`` says for each document whether all its cells became empty, so that all its keys were recovered.
        """
        found: list[tuple] = []
        active = np.arange(len(self.count))
        while len(active):
            single = active[np.abs(self.count[active]) == 1]
            single = single[self.check[single] == _mix(self.key[single], _SEEDS[4])]
            if not len(single):
                break
            keys, owner, sign = self.key[single], single // self.cells, self.count[single]
            order = np.lexsort((keys, owner))
            new = np.r_[True, (keys[order][1:] != keys[order][:-1]) | (owner[order][1:] != owner[order][:-1])]
            keys, owner, sign = keys[order][new], owner[order][new], sign[order][new]
            found.append((keys, owner, sign))
            self._toggle(keys, owner, -sign)
            active = np.unique((owner * self.cells + _places(keys, self.cells)).ravel())
        left = (self.count != 0) | (self.key != 0)
        whole = ~left.reshape(self.documents, self.cells).any(axis=1) if self.documents else np.zeros(0, bool)
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), whole
        return *(np.concatenate(x) for x in zip(*found, strict=True)), whole

    def written(self, sizes: np.ndarray) -> list[str]:
        """Base64 of the number of keys and the cells of each document."""
        cell = np.zeros((self.documents, self.cells), np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")]))
        cell["count"] = self.count.reshape(cell.shape)
        cell["key"] = self.key.reshape(cell.shape)
        cell["check"] = (self.check & np.uint64(0xFFFFFFFF)).reshape(cell.shape)
        return [base64.b64encode(int(n).to_bytes(8, "little") + row.tobytes()).decode() for n, row in zip(sizes, cell, strict=True)]


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], documents: int, cells: int = CELLS) -> np.ndarray:
    """How many keys are in only one of ``a`` and ``b`` (keys, owner), for each document: sketches are subtracted and
    peeled, and made again with ``GROWTH`` times the cells for the documents where peeling gets stuck."""
    out, todo = np.zeros(documents, np.int64), np.arange(documents)
    while len(todo):
        number = np.full(documents, -1)
        number[todo] = np.arange(len(todo))
        parts = []
        for keys, owner in (a, b):
            mine = number[owner]
            parts.append(Sketches(keys[mine >= 0], mine[mine >= 0], len(todo), cells))
        _, owner, _, whole = parts[0].minus(parts[1]).peel()
        out[todo[whole]] = np.bincount(owner, minlength=len(todo))[whole]
        todo, cells = todo[~whole], cells * GROWTH
    return out


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], documents: int) -> np.ndarray:
    """Shared over all keys, from the sizes and the recovered differences; 1 where neither has any."""
    both = np.bincount(a[1], minlength=documents) + np.bincount(b[1], minlength=documents)
    apart = differences(a, b, documents)
    return np.where(both > 0, (both - apart) / np.maximum(1, both + apart), 1.0)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(texts: list[str], nexts: list[str]) -> dict:
    changed = [edited(t, n) for t, n in zip(texts, nexts, strict=True)]
    raw = [c.encode() for c in changed]
    n = len(texts)
    own, made, after = (paragraph_keys(x) for x in ([t.encode() for t in texts], raw, [t.encode() for t in nexts]))
    return {
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(r).hexdigest() for r in raw],
        "fingerprint": Sketches(*own, n, CELLS).written(np.bincount(own[1], minlength=n)),
        "edited_fingerprint": Sketches(*made, n, CELLS).written(np.bincount(made[1], minlength=n)),
        "near_edited": likeness(own, made, n),
        "near_next": likeness(own, after, n),
    }


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Rows of a range in order, the first row of the next range (marked as borrowed) after them."""
    ids: list = []
    texts: list[str] = []
    held = 0

    def out() -> pd.DataFrame:
        frame = pd.DataFrame({"doc_id": pd.array(ids[: len(texts) - 1], "Int64")} | _compare(texts[:-1], texts[1:]))
        return frame

    for b in batches:
        for doc_id, borrowed, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            if held == -1:
                continue
            ids.append(doc_id)
            texts.append(content.as_py().decode("utf-8", "replace"))
            held += len(texts[-1])
            if borrowed:
                yield out()
                held = -1  # equal first rows of the next range: one is enough
            elif held > CHUNK_BYTES and len(texts) > 1:
                yield out()
                ids, texts, held = ids[-1:], texts[-1:], len(texts[-1])


def _as_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in _versions(batches):
        if len(frame):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)


def version_sketches(rows: DataFrame, text: str = "text", key: str = "doc_id", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each row's text beside its edited version and the row after it: fingerprints and likenesses.

    Rows are in order of the key (null first) and, where keys are equal, of a hash of the text; the row after the last is
    the first. They are dealt once, by ranges of the key of about ``range_bytes`` of text; each range also gets the first
    row of the next one. Texts without words have no paragraphs: two of them are alike by 1. A single row is
    its own next one. Repeated rows are rows of their own. No rows: no rows.
    """
    spark = rows.sparkSession
    keyed = rows.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("k"), utf8(text).alias("content")).withColumn("tie", F.xxhash64("content"))
    size = keyed.agg(F.sum(F.octet_length("content")).alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("k"), F.max("k")).first()
    if not size.n:
        return spark.createDataFrame([], _RESULT)
    wanted = min(MOST_RANGES, max(1, -(-(size.bytes + 100 * size.n) // range_bytes)))
    cuts = keyed.select("k").stat.approxQuantile("k", [i / wanted for i in range(1, wanted)], 1 / (20 * wanted)) if wanted > 1 else []
    bounds = np.unique(np.array(cuts, np.float64)).astype(np.int64)

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.to_numpy(), "right").astype(np.int32))

    placed = keyed.withColumn("range", range_of("k"))
    firsts = stored(placed.groupBy("range").agg(F.min(F.struct("k", "tie")).alias("f")).select("range", "f.*"), "range-firsts")
    order = sorted(r["range"] for r in firsts.select("range").collect())
    previous = spark.createDataFrame([(r, order[i - 1]) for i, r in enumerate(order)], "range int, previous int")
    heads = F.broadcast(firsts.join(F.broadcast(previous), "range").withColumnsRenamed({"k": "hk", "tie": "htie"}))
    is_first = (F.col("k") == F.col("hk")) & (F.col("tie") == F.col("htie"))
    home = F.struct(F.lit(False).alias("borrowed"), F.col("range").alias("at"))
    lent = F.struct(F.lit(True).alias("borrowed"), F.col("previous").alias("at"))
    dealt = placed.join(heads, "range").withColumn("to", F.explode(F.when(is_first, F.array(home, lent)).otherwise(F.array(home))))
    return (
        dealt.select("to.at", "to.borrowed", "k", "tie", "content")
        .repartitionById(len(bounds) + 1, "at")
        .sortWithinPartitions("borrowed", "k", "tie")
        .select(F.when(F.col("k") > -(1 << 63), F.col("k")).alias("doc_id"), "borrowed", "content")
        .mapInArrow(_as_arrow, _RESULT)
    )


def op6_paragraph_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return version_sketches(documents(spark, sf_dir))
