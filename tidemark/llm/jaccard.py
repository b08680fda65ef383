"""Near-duplicates by Jaccard similarity of shingle sets, joined through a token-group matrix."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import batch_bytes, bounded_side, chunks, documents, split_words, stored, utf8
from tidemark.llm.components import components

SHINGLE = 3
PERCENT = 90
HOT = 64
GROUP = 32
CHUNK_BYTES = 4 << 20
# A bitmap has a power of two of bits, so many for each token and in all.
BITMAP_EACH, BITMAP_LEAST = 8, 1024
# A filter of tokens: bits for each, and the least and largest size as powers of two.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 16, 28
# Tokens that a task holds before it deals them out, and about as many as a part of all tokens gets.
DEALT_TOKENS, PART_TOKENS, LEAST_PARTS = 2 << 20, 6 << 20, 16

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def token_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of its shingles; a text of fewer words is one shingle, or none."""
    words, cuts = split_words(data, offsets)
    digest = xxhash.xxh3_64_intdigest
    distinct = np.fromiter((digest(w) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    hashes = distinct[words.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    value = np.full(max(0, len(hashes) - shingle + 1), shingle, np.uint64)
    for k in range(shingle):
        value = value * _STEP + hashes[k : k + len(value)]
    value = _mixed(value)
    out = []
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if j - i >= shingle:
            out.append(np.unique(value[i : j - shingle + 1]))
        elif j > i:
            whole = np.array([j - i], np.uint64)
            for k in range(i, j):
                whole = whole * _STEP + hashes[k]
            out.append(_mixed(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * _MIX
    return value ^ (value >> np.uint64(29))


def least_overlap(size: int, percent: int) -> int:
    """The tokens that a set of this size shares with any set as similar as ``percent``."""
    return -(-size * percent // 100)


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "V16").view(np.int64).reshape(-1, 2)


def _described(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = batch_bytes(b.column(1))
            for i, j in chunks(offsets, CHUNK_BYTES):
                sets = token_sets(data, offsets[i : j + 1], shingle)
                digests = _digests(sets)
                columns = [b.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1])]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "d1", "d2"])

    return run


_PIECES = "part int, digests binary, counts binary, tokens binary"


def _dealt(shingle: int, parts: int):
    """Tokens dealt out to ``parts`` by their upper half; of a token its lower half is sent, of each set its digest and number of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0

        def out() -> pa.RecordBatch:
            digests, tokens = np.array(list(held), np.int64), np.concatenate(list(held.values()))
            owner = np.repeat(np.arange(len(held)), [len(s) for s in held.values()])
            part = ((tokens >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16 if parts <= 65536 else np.uint32)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            lower, owner = tokens.astype(np.uint32)[order], owner[order]
            rows = []
            for k, (first, end) in enumerate(itertools.pairwise(cuts.tolist())):
                if first < end:
                    heads = np.flatnonzero(np.r_[True, owner[first + 1 : end] != owner[first : end - 1]])
                    rows.append((k, digests[owner[first:end][heads]].tobytes(), np.diff(np.r_[heads, end - first]).astype(np.int32).tobytes(), lower[first:end].tobytes()))
            return _rows(rows, _PIECES)

        for b in batches:
            data, offsets = batch_bytes(b.column(0))
            for i, j in chunks(offsets, CHUNK_BYTES):
                sets = token_sets(data, offsets[i : j + 1], shingle)
                for s, digest in zip(sets, _digests(sets)[:, 0].tolist(), strict=True):
                    if len(s) and digest not in held:
                        held[digest] = s
                        size += len(s)
                if size > DEALT_TOKENS:
                    yield out()
                    held, size = {}, 0
        if held:
            yield out()

    return run


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    kinds = [{"int": pa.int32(), "binary": pa.binary()}[k] for k in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)], names=list(names))


def _by_first(batches: Iterator[pa.RecordBatch]) -> dict[int, list[list]]:
    """The binary columns of all rows of a task, by the number in the first column."""
    out: dict[int, list[list]] = {}
    for b in batches:
        for k, *more in zip(*(c.to_pylist() for c in b.columns), strict=True):
            out.setdefault(k, []).append(more)
    return out


_RATED = "bucket int, part int, digests binary, singles binary, counts binary, tokens binary, many binary"


def _rated(hot: int, buckets: int):
    """Of each set, in one part of all tokens: how many tokens no other set has, the others, and in how many sets these are
    (at most ``hot``). Equal sets count once. Dealt out to ``buckets`` by the sets' digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _by_first(batches)
        while held:
            part, pieces = held.popitem()
            digests, counts, tokens = (np.frombuffer(b"".join(x[k] for x in pieces), t) for k, t in enumerate((np.int64, np.int32, np.uint32)))
            del pieces
            first = np.unique(digests, return_index=True)[1]
            if len(first) < len(digests):
                once = np.zeros(len(digests), bool)
                once[first] = True
                tokens, digests, counts = tokens[np.repeat(once, counts)], digests[once], counts[once]
            # sets in order of their buckets
            bucket = (digests.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(order), np.uint64)
            place[order] = np.arange(len(order), dtype=np.uint64)
            both = tokens.astype(np.uint64) << np.uint64(32) | np.repeat(place, counts)
            both.sort()
            token, of = both >> np.uint64(32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
            del both
            heads = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            times = np.diff(np.r_[heads, len(token)])
            many = np.repeat(times, times)
            several = many > 1
            singles = np.bincount(of[~several], minlength=len(order)).astype(np.int32)
            token, of, many = token[several].astype(np.uint32), of[several], np.minimum(many[several], min(hot, 255)).astype(np.uint8)
            by_set = np.argsort(of, kind="stable")
            token, many, counts = token[by_set], many[by_set], np.bincount(of, minlength=len(order)).astype(np.int32)
            digests, bucket = digests[order], bucket[order]
            ends = np.r_[0, np.cumsum(counts, dtype=np.int64)]
            cuts, rows = np.searchsorted(bucket, np.arange(buckets + 1)), []
            for k, (i, j) in enumerate(itertools.pairwise(cuts.tolist())):
                if i < j:
                    x, y = int(ends[i]), int(ends[j])
                    rows.append((k, part, *(v.tobytes() for v in (digests[i:j], singles[i:j], counts[i:j], token[x:y], many[x:y]))))
            yield _rows(rows, _RATED)

    return run


def _prefixes(percent: int):
    """Of each set the first tokens in the common order, from the rarest to the most frequent: (token, digest, size, place, singles).

    Tokens that no other set has come first and bring no rows, but take places. Sets without room for others bring none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces in _by_first(batches).values():
            digests, singles, counts, tokens, many = (
                np.frombuffer(b"".join(x[k] for x in pieces), t) for k, t in ((1, np.int64), (2, np.int32), (3, np.int32), (4, np.uint32), (5, np.uint8))
            )
            part = np.repeat([x[0] for x in pieces], [len(x[1]) // 8 for x in pieces])
            digest, of = np.unique(digests, return_inverse=True)
            single = np.bincount(of, singles, len(digest)).astype(np.int64)
            size = single + np.bincount(of, counts, len(digest)).astype(np.int64)
            room = size - -(-size * percent // 100) + 1
            owner = np.repeat(of, counts)
            some = np.flatnonzero(single[owner] < room[owner])
            owner, token, many = owner[some], (np.repeat(part, counts).astype(np.int64) << 32 | tokens)[some], many[some]
            order = np.lexsort((token, many, owner))
            owner, token = owner[order], token[order]
            place = np.arange(len(owner)) - np.searchsorted(owner, owner) + single[owner]
            new = np.r_[True, (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])] if len(owner) else np.zeros(0, bool)
            at = np.flatnonzero(new & (place < room[owner]))
            columns = [token[at], digest[owner[at]], size[owner[at]], place[at], single[owner[at]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "d1", "n", "place", "singles"])

    return run


def _places(tokens: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mixed, mask = tokens * _MIX, np.uint64(bits - 1)
    return (mixed >> np.uint64(8)) & mask, (mixed >> np.uint64(34)) & mask


def _marks(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.concatenate(_places(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 16), pa.array(at & 65535)], names=["block", "bit"])

    return run


def _mark_block(frame):
    import pandas as pd

    out = np.zeros(65536, np.uint8)
    out[frame["bit"].to_numpy()] = 1
    return pd.DataFrame({"block": [frame["block"].iat[0]], "marks": [np.packbits(out).tobytes()]})


def frequent_filter(tokens: DataFrame, rows: int) -> np.ndarray:
    """A Bloom filter of ``tokens``, at most 2**28 bits: built block by block in tasks, so bounded on the driver."""
    bits = 1 << min(MOST_BITS, max(LEAST_BITS, (rows * BITS_EACH).bit_length()))
    out = np.zeros(bits // 8, np.uint8)
    made = tokens.mapInArrow(_marks(bits), "block long, bit long").groupBy("block").applyInPandas(_mark_block, "block long, marks binary")
    # one job, not one for each partition
    for b in made.toArrow().to_batches():
        for block, marks in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            out[block * 8192 : (block + 1) * 8192] = np.frombuffer(marks.as_buffer(), np.uint8)
    return out


def _is_frequent(tokens: np.ndarray, marks: np.ndarray) -> np.ndarray:
    found = np.ones(len(tokens), bool)
    for at in _places(tokens, 8 * len(marks)):
        found &= marks[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1 != 0
    return found


def _tokens(column: pa.Array, i: int) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), np.uint64)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """The number of common tokens of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))


def _bitmap(tokens: np.ndarray) -> bytes:
    """One bit for each token, in a bitmap that grows with the set."""
    size = max(BITMAP_LEAST, 1 << (BITMAP_EACH * len(tokens) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(tokens * _MIX >> np.uint64(24) & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _folded(*bitmaps: bytes) -> list[np.ndarray]:
    """Bitmaps as numbers, larger ones folded to the size of the smallest."""
    words = [np.frombuffer(x, np.uint64) for x in bitmaps]
    least = min(map(len, words))
    return [x if len(x) == least else np.bitwise_or.reduce(x.reshape(-1, least), axis=0) for x in words]


def _near_by_bits(percent: int):
    """Drops pairs whose bitmaps alone differ in more bits than similar sets do in tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, (n, m) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                x, y = _folded(b.column(4)[i].as_py(), b.column(5)[i].as_py())
                # |A| + |B| - 2 |A and B| of sets with 100 |A and B| >= percent (|A| + |B| - |A and B|)
                most = n + m - 2 * -(-percent * (n + m) // (100 + percent))
                keep[i] = int(np.bitwise_count(x ^ y).sum()) <= most
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def _unions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmaps of the members of each group as one."""
    for b in batches:
        out = [np.bitwise_or.reduce(_folded(*bits.as_py()), axis=0).tobytes() for bits in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["cls", "part", "of_group"])


def _opens(percent: int):
    """Drops (query, group) where more bits of the query's tokens are missing in the group than tokens may be.

    A bit that no member of the group has stands for tokens that none has, so nothing similar is dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, n in enumerate(b.column(3).to_pylist()):
                query, group = _folded(b.column(4)[i].as_py(), b.column(5)[i].as_py())
                keep[i] = int(np.bitwise_count(query & ~group).sum()) <= n - least_overlap(n, percent)
            yield pa.RecordBatch.from_arrays([b.column(k) for k in range(4)], names=["node", "cls", "part", "n"]).filter(pa.array(keep))

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = _tokens(b.column(2), i), _tokens(b.column(3), i)
                both = _shared(x, y)
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def _whole_sets(shingle: int):
    """(t1, t2, tokens, bits) of texts, each text once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            new = []
            for i, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            if not new:
                continue
            b = b.take(pa.array(new))
            data, offsets = batch_bytes(b.column(2))
            for i, j in chunks(offsets, CHUNK_BYTES):
                sets = token_sets(data, offsets[i : j + 1], shingle)
                columns = [pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([_bitmap(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), *columns], names=["t1", "t2", "tokens", "bits"])

    return run


def _lane(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "content")


def _sizes_allow(n: str, m: str, percent: int) -> Column:
    return 100 * F.least(F.col(n), F.col(m)) >= percent * F.greatest(F.col(n), F.col(m))


def _places_allow(places: Column, sizes: Column, percent: int) -> Column:
    """Of the first common token: those before it are in one set only, and so many the sets may differ in."""
    return (100 + percent) * places <= (100 - percent) * sizes


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of distinct (a, b) those similar enough: first by their bitmaps, then by all tokens. ``sets``: (node, n, tokens, bits)."""
    x, y = (sets.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits_{k}")) for k in "ab")
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "bits_a", "bits_b")
    near = stored(both.mapInArrow(_near_by_bits(percent), "a long, b long"), "near")
    joined = near.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    joined = joined.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return stored(joined.select("a", "b", "x", "y").mapInArrow(_similar(percent), "a long, b long"), "links")


def similar_groups(
    rows: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT, hot: int = HOT, group: int = GROUP
) -> DataFrame:
    """Per row: id (the key), n (distinct shingles), component_id, the least key that can be reached by links.

    Two rows link when 100 times the common shingles are at least ``percent`` times all shingles of both. Rows with
    equal sets are one node. Similar nodes share one of their first tokens in any common order (here: from the rarest to the
    most frequent, counted over all tokens of all nodes, ``hot`` and more as one), so nodes are brought together by these.
    Tokens that only one node has come first, so a node with enough of its own meets none. Places in the order say how much
    two nodes differ at least. Of all nodes with such a token the one with the least share of tokens of its own is the
    pivot, and the others are compared with it; what links to it is one class, whose members need no comparison. Classes are
    cut into groups of about ``group`` nodes. The token-group matrix says which groups of other classes hold a
    query's first tokens; where the union of a group's tokens, as a bitmap, lacks too many of the query's for any member to be
    similar, it stays shut; the members of the groups that open are compared with the query exactly.

    Shingles are told apart by 64-bit hashes, texts and sets by 128-bit ones (in the search for
    pairs: sets by 64 bits of these, and tokens by 32 bits and their part, which may bring more pairs). Null and empty texts have no shingles, link with nothing and keep their own key. Null
    keys count for no least key. Repeated rows are rows of their own in one node. Texts of any length are read whole.
    No rows: no rows. Other columns are not read, whatever their names.
    """
    spark = rows.sparkSession
    narrow = rows.select(F.col(key).cast("long").alias("id"), utf8(text).alias("content")).withColumns({"t1": _lane(1), "t2": _lane(2)})
    described = narrow.select(F.struct("id", "t1", "t2").alias("id"), "content").mapInArrow(
        _described(shingle), "id struct<id: long, t1: long, t2: long>, n long, d1 long, d2 long"
    )
    docs = stored(described.select("id.*", "n", "d1", "d2").withColumn("rid", F.monotonically_increasing_id()), "described")
    made = docs.filter("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("least"), F.min(F.struct("rid", "n", "t1", "t2")).alias("of"))
    nodes = stored(made.select("d1", "d2", "least", F.col("of.rid").alias("node"), "of.n", "of.t1", "of.t2"), "nodes")

    # every token is counted in its part; sets come together again by their digests
    tokens = docs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    parts = max(LEAST_PARTS, -(-tokens // PART_TOKENS))
    rated = narrow.select("content").mapInArrow(_dealt(shingle, parts), _PIECES).repartition(parts, "part").mapInArrow(_rated(hot, parts), _RATED)
    first = rated.repartition(parts, "bucket").mapInArrow(_prefixes(percent), "token long, d1 long, n long, place long, singles long")
    postings = stored(stored(first, "prefixes").join(nodes.select("d1", "node"), "d1").drop("d1"), "postings")
    own = F.struct((F.col("singles") / F.col("n")).alias("own"), "n", "node", "place")
    buckets = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min(own).alias("p")).filter("c > 1")
    buckets = buckets.select("token", F.col("p.node").alias("pivot"), F.col("p.n").alias("m"), F.col("p.place").alias("pivot_place"))
    shared = stored(postings.join(bounded_side(buckets, "buckets"), "token"), "shared")

    found = nodes.join(shared.select("node").distinct(), "node").select("node", "n", "t1", "t2")
    found = stored(found, "needed")
    chosen = narrow.join(bounded_side(found.select("t1", "t2").distinct(), "texts"), ["t1", "t2"], "left_semi")
    made = chosen.select("t1", "t2", "content").mapInArrow(_whole_sets(shingle), "t1 long, t2 long, tokens binary, bits binary")
    sets = stored(found.join(made.dropDuplicates(["t1", "t2"]), ["t1", "t2"]).select("node", "n", "tokens", "bits"), "sets")

    to_pivot = shared.filter((F.col("node") != F.col("pivot")) & _sizes_allow("n", "m", percent))
    to_pivot = to_pivot.filter(_places_allow(F.col("place") + F.col("pivot_place"), F.col("n") + F.col("m"), percent))
    pairs = to_pivot.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    links = _links(stored(pairs, "pairs"), sets, percent)

    # classes, cut into groups; the matrix of tokens and groups
    label = components(links, "cls").withColumnRenamed("a", "node")
    query = shared.select("token", "node", "n", "place").join(label, "node", "left").withColumn("cls", F.coalesce("cls", "node"))
    query = stored(query, "queries")
    members = query.select("node", "n", "cls").distinct()
    parts = members.groupBy("cls").agg(F.ceil(F.count(F.lit(1)) / group).alias("parts"))
    members = stored(members.join(parts, "cls").select("node", "n", "cls", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")), "members")
    several = query.groupBy("token").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).filter("x <> y").select("token")
    open_query = stored(query.join(bounded_side(several, "several"), "token", "left_semi"), "open")
    matrix = open_query.select("token", "node", "place").join(members, "node").groupBy("token", F.col("cls").alias("to"), "part")
    matrix = stored(matrix.agg(F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.min("place").alias("least_place")), "matrix")
    fits = (F.col("cls") < F.col("to")) & (100 * F.col("most_n") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("least_n"))
    fits &= _places_allow(F.col("place") + F.col("least_place"), F.col("n") + F.col("most_n"), percent)
    meets = stored(open_query.join(matrix, "token").filter(fits).select("node", "n", F.col("to").alias("cls"), "part").distinct(), "meets")

    # the union of a group is a bitmap
    grouped = members.select("node", "cls", "part").join(meets.select("cls", "part").distinct(), ["cls", "part"], "left_semi")
    unions = sets.select("node", "bits").join(grouped, "node").groupBy("cls", "part").agg(F.collect_list("bits").alias("bits"))
    unions = stored(unions.mapInArrow(_unions, "cls long, part long, of_group binary"), "unions")
    checked = meets.join(sets.select("node", "bits"), "node").join(unions, ["cls", "part"]).select("node", "cls", "part", "n", "bits", "of_group")
    opened = checked.mapInArrow(_opens(percent), "node long, cls long, part long, n long")
    inside = opened.join(members.select(F.col("node").alias("b"), F.col("n").alias("m"), "cls", "part"), ["cls", "part"])
    inside = inside.filter(_sizes_allow("n", "m", percent))
    more = _links(stored(inside.select(F.col("node").alias("a"), "b"), "opened"), sets, percent)

    label = components(links.unionAll(more), "label").withColumnRenamed("a", "node")
    named = nodes.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(least, "label").select("d1", "d2", "component_id")
    linked = docs.filter("n > 0").select("id", "n", "d1", "d2").join(named, ["d1", "d2"]).select("id", "n", "component_id")
    return linked.unionByName(docs.filter("n = 0").select("id", "n", F.col("id").alias("component_id")))


def op12_similar_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of three-word shingles of all documents, linked at nine tenths."""
    return similar_groups(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


OP12_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words
), sets AS (
  SELECT min(doc_id) AS node, list_sort(s) AS s, len(s) AS n FROM shingled WHERE len(s) > 0 GROUP BY list_sort(s), len(s)
), tokens AS (
  SELECT node, n, unnest(s) AS t FROM sets
), pairs AS (
  SELECT a.node AS a, b.node AS b, a.n AS n, b.n AS m, count(*) AS c FROM tokens a JOIN tokens b ON a.t = b.t AND a.node < b.node
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY 1, 2, 3, 4
), links AS (
  SELECT a, b FROM pairs WHERE 100 * c >= 90 * (n + m - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT node, node AS low FROM sets UNION SELECT l.b, r.low FROM reach r JOIN both_ways l ON l.a = r.node
), component AS (
  SELECT node, min(low) AS low FROM reach GROUP BY node
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(c.low, d.doc_id) AS component_id
FROM shingled d LEFT JOIN sets s ON s.s = list_sort(d.s) AND len(d.s) > 0 LEFT JOIN component c ON c.node = s.node
"""
