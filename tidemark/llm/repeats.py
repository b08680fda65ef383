"""Removal of long repeated passages: anchors bring equal passages together, a run-length BWT index finds long matches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import BROADCAST_ROWS, batch_bytes, chunks, documents, placed, settled, stored, utf8
from tidemark.session import materialize

LENGTH = 200  # bytes of a passage
GRAM_STEPS = (1, 2, 4, 8, 16, 32)
GRAM = 64  # bytes that make an anchor: one more than the sum of the steps
SLICE = 1 << 20
HOT = 4096  # stretches with one anchor, beyond which they are cut finer
FINE = 8  # starts of a finer stretch
BLOCK_BYTES = 1 << 20
SYMBOLS = 7  # packed into the first sort key, nine bits each
_TABLE = np.random.default_rng(64).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, count, anchor) of runs of start positions in a buffer of texts whose passages of ``length`` bytes share an anchor.

    The anchor of a passage is its leftmost gram of least hash. It depends on the passage's bytes only, so equal
    passages have equal anchors wherever they stand. Passages don't cross the ends of texts.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none
    valid = np.zeros(len(data) + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= length)
    valid[offsets[long]] = 1
    np.subtract.at(valid, offsets[long + 1] - length + 1, 1)
    valid = np.cumsum(valid[:n]) > 0
    if not valid.any():
        return none
    value = _grams(data)
    window = length - GRAM + 1
    place = np.arange(len(value), dtype=np.int32)
    width = 1
    while width < window:
        m = min(width, window - width)
        better = value[m:] < value[:-m]
        place = np.where(better, place[m:], place[:-m])
        value = np.minimum(value[m:], value[:-m])
        width += m
    new = place[1:] != place[:-1]
    starts = valid.copy()
    starts[1:] &= ~valid[:-1] | new
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | new
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) - first + 1, value[first].view(np.int64)


def anchor_place(passage: bytes) -> int:
    """Where the anchor of a passage begins."""
    value = _grams(np.frombuffer(passage, np.uint8))
    return int(np.argmin(value))


def _grams(data: np.ndarray) -> np.ndarray:
    value = _TABLE[data]
    for m in GRAM_STEPS:
        mixed = value[:-m] * np.uint64(0x9E3779B97F4A7C15)
        mixed += value[m:]
        mixed ^= mixed >> np.uint64(29)
        value = mixed
    return value


def _runs(length: int):
    def one(rid: int, base: int, raw: bytes, found: tuple) -> list[np.ndarray]:
        first, count, anchor = found
        digest = np.fromiter((xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)), np.uint64, len(first))
        return [np.full(len(first), rid), first + base, count, anchor, digest.view(np.int64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rid", "start", "n", "anchor", "digest"]
        for b in batches:
            rids, (data, offsets) = b.column(0).to_numpy(), batch_bytes(b.column(1))
            for i, j in chunks(offsets, SLICE):
                low, high = int(offsets[i]), int(offsets[j])
                if j - i == 1 and high - low > 2 * SLICE:  # a very long text: slice by slice, each start in one of them
                    parts = []
                    for at in range(low, high, SLICE):
                        piece = data[at : min(high, at + SLICE + length - 1)]
                        parts.append(one(int(rids[i]), at - low, piece.tobytes(), stretches(piece, np.array([0, len(piece)]), length)))
                    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                else:
                    piece, cuts = data[low:high], offsets[i : j + 1] - low
                    columns = one(0, 0, piece.tobytes(), found := stretches(piece, cuts, length))
                    owner = np.searchsorted(cuts, found[0], "right") - 1
                    columns[0], columns[1] = rids[i:j][owner], columns[1] - cuts[owner]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)

    return run


class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of several pieces of bytes, with the suffixes at both ends of each run.

    ``order`` holds the suffixes sorted, equal ones by position. Only the heads of runs need a comparison of bytes: within a run
    the neighbours of a suffix are those of the suffix one byte earlier, so its common prefix is shorter by one.
    """

    def __init__(self, pieces: list[bytes]) -> None:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.text = np.frombuffer(b"".join(pieces), np.uint8)
        self.starts = np.r_[0, np.cumsum(lengths)]
        self.left = np.repeat(self.starts[1:], lengths) - np.arange(len(self.text))  # bytes up to the end of the piece
        self.order = self._sorted()
        before = np.full(len(self.text), -1, np.int16)  # the byte before each suffix, none at the start of a piece
        before[1:] = self.text[:-1]
        before[self.starts[:-1][lengths > 0]] = -1
        transform = before[self.order]
        head = np.r_[True, (transform[1:] != transform[:-1]) | (transform[1:] < 0)] if len(transform) else np.zeros(0, bool)
        self.heads = np.flatnonzero(head)
        self.symbols = transform[self.heads]  # one for each run
        self.run_first = self.order[self.heads]
        self.run_last = self.order[np.r_[self.heads[1:] - 1, len(self.order) - 1]] if len(self.order) else self.order

    def _sorted(self) -> np.ndarray:
        """Prefix doubling, from packed symbols on, over what is not yet told apart."""
        n = len(self.text)
        padded = np.zeros(n + SYMBOLS, np.uint64)
        padded[:n] = self.text.astype(np.uint64) + np.uint64(1)
        key = np.zeros(n, np.uint64)
        for k in range(SYMBOLS):
            key = (key << np.uint64(9)) | np.where(self.left > k, padded[k : k + n], np.uint64(0))
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.r_[True, sorted_key[1:] != sorted_key[:-1]] if n else np.zeros(0, bool)
        rank = np.zeros(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
        width, most = SYMBOLS, int(self.left.max()) if n else 0
        while width < most:
            heads = np.flatnonzero(new)
            sizes = np.diff(np.r_[heads, n])
            open_ = np.repeat(sizes > 1, sizes)
            at = np.flatnonzero(open_)
            if not len(at):
                break
            suffix = order[at]
            second = np.where(self.left[suffix] > width, rank[np.minimum(suffix + width, n - 1)], 0)
            pair = (rank[suffix] << 32) | second
            suffix = suffix[again := np.argsort(pair, kind="stable")]
            pair = pair[again]
            order[at] = suffix
            split = np.r_[True, pair[1:] != pair[:-1]]
            new[at] = split
            rank[suffix] = np.maximum.accumulate(np.where(split, at, 0)) + 1
            width *= 2
        if n:  # equal up to the ends of their pieces: by position
            group = np.cumsum(new)
            order = order[np.lexsort((order, group))]
        return order

    def common_prefixes(self) -> np.ndarray:
        """Of each suffix and the one before it in order, by position in the text, streamed from the run ends."""
        n = len(self.text)
        if not n:
            return np.zeros(0, np.int64)
        a, b = self.run_last[:-1], self.run_first[1:]
        limit = np.minimum(self.left[a], self.left[b])
        padded = np.r_[self.text, np.zeros(8, np.uint8)]
        words = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1))
        shared = np.zeros(len(a), np.int64)
        todo = np.arange(len(a))
        while len(todo):
            x = np.ascontiguousarray(words[np.minimum(a[todo] + shared[todo], n - 1)]).view(np.uint64)[:, 0]
            y = np.ascontiguousarray(words[np.minimum(b[todo] + shared[todo], n - 1)]).view(np.uint64)[:, 0]
            diff = x ^ y
            low = diff & (~diff + np.uint64(1))
            equal = np.where(diff == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
            shared[todo] = np.minimum(shared[todo] + equal, limit[todo])
            todo = todo[(equal == 8) & (shared[todo] < limit[todo])]
        direct = np.zeros(n, np.int64)
        known = np.zeros(n, bool)
        direct[b], known[b] = shared, True
        known[self.order[0]] = True
        last = np.maximum.accumulate(np.where(known, np.arange(n), 0))
        return np.maximum(0, direct[last] - (np.arange(n) - last))

    def matching(self) -> np.ndarray:
        """For each position, how long a match it has anywhere else in the pieces (not beyond the end of a piece)."""
        n = len(self.text)
        above = self.common_prefixes()[self.order] if n else np.zeros(0, np.int64)
        out = np.zeros(n, np.int64)
        out[self.order] = np.maximum(above, np.r_[above[1:], 0])
        return out


def repeated_ranges(groups: list[tuple[bytes, int]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each (piece, times it stands in the corpus): ranges of starts whose passage occurs elsewhere as well."""
    index = RunLengthIndex([p for p, _ in groups])
    far = index.matching() >= length
    out = []
    for k, (piece, times) in enumerate(groups):
        many = len(piece) - length + 1
        if times > 1:
            out.append([(0, many - 1)])
            continue
        hit = far[index.starts[k] : index.starts[k] + many].astype(np.int8)
        edges = np.flatnonzero(np.diff(np.r_[0, hit, 0]))
        out.append(list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True)))
    return out


def _pieces(length: int):
    """Stretches as pieces: a row for each place, its bytes only where the task has not sent them before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for b in batches:
            rows: list[tuple] = []
            for rid, content, found in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                raw = content.as_py()
                for r in found:
                    start, n, key = r["start"], r["n"], r["anchor"]
                    # cut finer at places counted from the anchor, which are the same wherever a passage stands
                    place = start + anchor_place(raw[start : start + length]) if r["hot"] else 0
                    cuts = [start, *range(start + 1 + (place - start) % FINE, start + n, FINE), start + n] if r["hot"] else [start, start + n]
                    for first, end in zip(cuts, cuts[1:], strict=False):
                        last = end - 1
                        piece = raw[first : last + length]
                        if r["hot"]:  # what the passages of a whole such part share
                            low = place - (place - first) // FINE * FINE - FINE + 1
                            key = xxhash.xxh64_intdigest(raw[low + FINE - 1 : low + length], 1) - (1 << 63)
                        digest = xxhash.xxh3_128_intdigest(piece)
                        name = (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63)
                        fresh = name not in sent
                        if fresh and len(sent) < 200_000:
                            sent.add(name)
                        rows.append((rid, first, key, *name, piece if fresh else None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["rid", "start", "key", "d1", "d2", "piece"])

    return run


def _indexed(length: int):
    """Pieces sorted by key: blocks of whole keys are indexed; per piece the ranges of repeated starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size, last = 0, None

        def out() -> pa.RecordBatch:
            rows = []
            for (piece, info), ranges in zip(held.items(), repeated_ranges([(p, i[2]) for p, i in held.items()], length), strict=True):
                rows += [(info[0], info[1], first, end) for first, end in ranges]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["d1", "d2", "low", "high"])

        for b in batches:
            for key, d1, d2, times, piece in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if key != last and size > BLOCK_BYTES:
                    yield out()
                    held, size = {}, 0
                last = key
                if piece in held:
                    held[piece][2] += times
                else:
                    held[piece] = [d1, d2, times]
                    size += len(piece)
        if held:
            yield out()

    return run


def _single(length: int):
    """Pieces cut into single starts: each with the digest of its whole passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d1, d2, piece in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                for low in range(len(piece) - length + 1):
                    digest = xxhash.xxh3_128_intdigest(piece[low : low + length])
                    rows.append((d1, d2, low, (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["d1", "d2", "low", "p1", "p2"])

    return run


def split_crowded(pieces: DataFrame, hot: int) -> tuple[DataFrame, DataFrame | None]:
    """``pieces`` that carry bytes, of keys with at most ``hot`` of them and of all other keys (None if there is none)."""
    sent = pieces.filter("piece IS NOT NULL")
    keys, many = materialize(sent.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("key"), "crowded-keys")
    if not many:
        return sent, None
    keys = F.broadcast(keys) if many <= BROADCAST_ROWS else keys.hint("merge")
    return sent.join(keys, "key", "left_anti"), sent.join(keys, "key", "left_semi")


def single_ranges(crowded: DataFrame, times: DataFrame, length: int) -> DataFrame:
    """(d1, d2, low, high): the starts in ``crowded`` pieces whose passage stands in several places, counted by its digest.

    Counting has a map-side part, so a passage in any number of pieces gathers nowhere.
    """
    singles = stored(crowded.select("d1", "d2", "piece").mapInArrow(_single(length), "d1 long, d2 long, low long, p1 long, p2 long").join(times.hint("merge"), ["d1", "d2"]), "single-starts")
    places = ["d1", "d2", "low"]  # a piece sent by several tasks is one place: only different ones, or its times, count
    ends = [f(c).alias(f"{n}_{c}") for c in places for f, n in ((F.min, "min"), (F.max, "max"))]
    differ = " OR ".join(f"min_{c} <> max_{c}" for c in places)
    repeated = stored(singles.groupBy("p1", "p2").agg(F.max("times").alias("most"), *ends).filter(f"most > 1 OR {differ}").select("p1", "p2"), "repeated-starts")
    return singles.join(repeated.hint("merge"), ["p1", "p2"]).select("d1", "d2", "low", F.col("low").alias("high"))


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, kept = [], []
            for content, found in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                raw = content.as_py()
                merged: list[list[int]] = []
                for r in sorted(found, key=lambda r: r["low"]):
                    if merged and r["low"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["high"] + length)
                    else:
                        merged.append([r["low"], r["high"] + length])
                cuts = [0, *(x for m in merged for x in m), len(raw)]
                spans.append([{"first": a, "end": z} for a, z in merged])
                kept.append(b"".join(raw[i:j] for i, j in zip(cuts[::2], cuts[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], names=["rid", "spans", "kept"])

    return run


def numbered(rows: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(rid, doc_id, content); rows that don't come straight from a scan are stored first."""
    return placed(settled(rows, "settled"), "_repeat_rid").select(F.col("_repeat_rid").alias("rid"), F.col(key).cast("long").alias("doc_id"), utf8(text).alias("content"))


def repeated_passages(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(rid, spans, kept) of the ``numbered`` rows with a passage of ``length`` bytes that also starts anywhere else.

    ``spans`` are the maximal runs of bytes covered by such passages, ``kept`` the other bytes.

    Starts with the same anchor form stretches; a table of them is counted by anchor with map-side aggregation. An anchor
    met once repeats nothing. Where all stretches of an anchor have the same bytes, all their passages are repeated, and no
    bytes move; a group of copies of any size ends here. For other anchors the distinct stretches of each task
    are shuffled by anchor and indexed in blocks: passages with a match of ``length`` bytes elsewhere in the index, or
    in a stretch that stands in several places, are repeated. An anchor with more than ``hot`` stretches, say in a line that very
    many texts hold, is replaced by what ``FINE`` neighbouring passages share, nearly their whole length. Where still more than
    ``hot`` pieces share this, say at the edges of such a line, single passages are counted by their digests, so no index
    holds more than ``hot`` pieces of a key.

    Null and empty texts, and texts shorter than ``length``, repeat nothing. Repeated rows repeat each other.
    A text of one repeated byte repeats itself. Very long texts are read in slices. No rows: no rows.
    """
    runs = stored(docs.select("rid", "content").mapInArrow(_runs(length), "rid long, start long, n long, anchor long, digest long").select("rid", F.col("start").cast("int"), F.col("n").cast("int"), "anchor", "digest"), "stretches")
    # stored, so that the join's both sides are plain shuffles, which adaptive execution splits at a hot anchor
    shared = stored(
        runs.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("times"), F.min("digest").alias("d"), F.max("digest").alias("e"))
        .filter("times > 1")
        .select("anchor", (F.col("d") == F.col("e")).alias("alike"), (F.col("times") > hot).alias("hot")),
        "shared-anchors",
    )
    found = runs.select("rid", "start", "n", "anchor").join(shared.hint("merge"), "anchor").groupBy("rid").agg(F.collect_list(F.struct("start", "n", "anchor", "alike", "hot")).alias("found"))
    touched = stored(docs.select("rid", "content").join(found.hint("merge"), "rid"), "touched")
    mixed = touched.withColumn("found", F.filter("found", lambda f: ~f["alike"])).filter(F.size("found") > 0)
    pieces = stored(mixed.mapInArrow(_pieces(length), "rid long, start long, key long, d1 long, d2 long, piece binary"), "pieces")
    # a piece that several tasks have sent stands there once for each; that it stands there more often is in the counts
    times = pieces.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("times"))
    few, crowded = split_crowded(pieces, hot)
    first = few.join(times.hint("merge"), ["d1", "d2"])
    ranges = first.repartition(F.col("key")).sortWithinPartitions("key").select("key", "d1", "d2", F.col("times"), "piece").mapInArrow(_indexed(length), "d1 long, d2 long, low long, high long")
    if crowded is not None:
        ranges = ranges.union(single_ranges(crowded, times, length))
    ranges = stored(ranges.distinct(), "repeated-ranges")
    inside = pieces.select("rid", "start", "d1", "d2").join(ranges.hint("merge"), ["d1", "d2"]).select("rid", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
    whole = touched.select("rid", F.explode(F.filter("found", lambda f: f["alike"])).alias("f")).select("rid", F.col("f.start").cast("long").alias("low"), (F.col("f.start") + F.col("f.n") - 1).cast("long").alias("high"))
    marks = inside.union(whole).groupBy("rid").agg(F.collect_list(F.struct("low", "high")).alias("marks"))
    return touched.select("rid", "content").join(marks.hint("merge"), "rid").mapInArrow(_cut(length), "rid long, spans array<struct<first: long, end: long>>, kept binary")


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of 200 bytes that stand anywhere else."""
    docs = numbered(documents(spark, sf_dir))
    cut = repeated_passages(docs).select("rid", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.first)").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("sha"))
    plain = docs.select("rid", "doc_id", F.octet_length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("own"))
    zero = F.lit(0).cast("long")
    return plain.join(cut.hint("merge"), "rid", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"))
