"""SimHash near-duplicates: fingerprints of word shingles, linked by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import bounded_side, documents, placed, settled, stored, utf8
from tidemark.llm.components import components

SHINGLE = 3
MOST_BITS = 2
HASH_SEED = 42
HOT = 4096
CHUNK = 1 << 19
# Bits still free at each level, and of them those that the equal block must share: a level has budget + 1 blocks.
FULL = 64


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each 1 if it is set in over half of the hashes of the shingles. No words: 0."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the white space of the contract
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)]
    else:
        line = b" ".join(words)
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[i:j], HASH_SEED) for i, j in zip(starts[: -shingle].tolist(), (starts[shingle:] - 1).tolist(), strict=True)]
    counts = np.zeros(FULL, np.int64)
    for i in range(0, len(hashes), CHUNK // 8):
        part = np.array(hashes[i : i + CHUNK // 8], np.uint64)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.fromiter((simhash(x.as_py(), shingle) for x in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values.view(np.int64))], names=["rid", "fp"])

    return run


def trie_pairs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in ``values`` (sorted, distinct uint64 in each range) at most ``budget`` bits apart.

    Each range starts as the root of a binary trie whose values share their first ``depth`` bits. Pairs of nodes are
    traversed together, breadth first in bounded chunks: a node with itself gives three pairs of children, two nodes
    give four, of which those across cost one differing bit; a pair is dropped once it has more than ``budget``.
    A pair of leaves is decided by all its bits.
    """
    keep = ends - starts > 1
    work = [(starts[keep], ends[keep], starts[keep], ends[keep], np.zeros(int(keep.sum()), np.int8), depth)]
    while work:
        la, ra, lb, rb, cost, level = work.pop()
        if len(la) > CHUNK:
            half = len(la) // 2
            work += [tuple(x[:half] for x in (la, ra, lb, rb, cost)) + (level,), tuple(x[half:] for x in (la, ra, lb, rb, cost)) + (level,)]
            continue
        leaf = (ra - la == 1) & (rb - lb == 1)
        if leaf.any():
            i, j = la[leaf], lb[leaf]
            near = (np.bitwise_count(values[i] ^ values[j]) <= budget) & (i != j)
            if near.any():
                yield i[near], j[near]
            la, ra, lb, rb, cost = (x[~leaf] for x in (la, ra, lb, rb, cost))
        if not len(la) or level >= FULL:
            continue
        bit = np.uint64(1) << np.uint64(FULL - 1 - level)
        ma, mb = _split(values, la, ra, bit), _split(values, lb, rb, bit)
        own = (la == lb) & (ra == rb)
        sides = [(la, ma, lb, mb, cost, None), (ma, ra, mb, rb, cost, None), (la, ma, mb, rb, cost + 1, None), (ma, ra, lb, mb, cost + 1, ~own)]
        made = []
        for a, b, c, d, k, only in sides:
            good = (a < b) & (c < d) & (k <= budget) & ~((a == c) & (b - a == 1) & (d - c == 1))
            if only is not None:
                good &= only
            made.append(tuple(x[good] for x in (a, b, c, d, k)))
        work.append(tuple(np.concatenate(x) for x in zip(*made, strict=True)) + (level + 1,))


def _split(values: np.ndarray, low: np.ndarray, high: np.ndarray, bit: np.uint64) -> np.ndarray:
    """In each sorted range whose values agree before ``bit``, the first position with the bit set."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        one = (values[np.minimum(middle, len(values) - 1)] & bit) != 0
        high = np.where(open_ & one, middle, high)
        low = np.where(open_ & ~one, middle + 1, low)
    return low


def _linked(budget: int):
    """Batches sorted by key and turned value; per key the links that connect what is near, each to the least of its set."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        key, value, fp = (frame[c].to_numpy() for c in ("key", "turned", "fp"))
        value = value.view(np.uint64)
        cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        parent = np.arange(len(fp))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for left, right in trie_pairs(value, cuts[:-1], cuts[1:], int(frame["depth"].iat[0]), budget):
            for i, j in zip(left.tolist(), right.tolist(), strict=True):
                a, b = root(i), root(j)
                if a != b:
                    low, high = (a, b) if fp[a] < fp[b] else (b, a)
                    parent[high] = low
        heads = np.array([root(i) for i in range(len(fp))], np.int64)
        moved = heads != np.arange(len(fp))
        return pd.DataFrame({"a": fp[moved], "b": fp[heads[moved]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in batches:
            if not len(frame):
                continue
            last = frame["key"].iat[-1]
            tail = frame["key"].to_numpy() == last
            if tail.all() and held and held[-1]["key"].iat[-1] == last:
                held.append(frame)
                continue
            done = pd.concat([*held, frame[~tail]])
            carry = done["key"].to_numpy() == last
            if (~carry).any():
                yield solve(done[~carry].reset_index(drop=True))
            held = [done[carry], frame[tail]] if carry.any() else [frame[tail]]
        if held:
            yield solve(pd.concat(held).reset_index(drop=True))

    return run


def links(prints: DataFrame, most_bits: int = MOST_BITS, hot: int = HOT) -> DataFrame:
    """(a, b) of distinct fingerprints ``fp``: links that connect all that are ``most_bits`` or fewer bits apart.

    Of most_bits + 1 blocks of a fingerprint one is equal in both of a near pair, so each fingerprint is sent once for
    each block, turned so that the block comes first, and a trie is built over those that share it. A block shared by
    more than ``hot`` fingerprints is cut again by blocks of the remaining bits, until so few bits remain free that a
    group cannot be larger than their combinations.
    """
    blocks, free, found = most_bits + 1, FULL, None
    level = prints.select("fp", F.col("fp").alias("turned"), F.lit(0).cast("long").alias("key"))
    while True:
        width = -(-free // blocks)
        share = free - (blocks - 1) * width if free - (blocks - 1) * width > 0 else 1
        low = (1 << free) - 1 if free < FULL else -1
        part = F.col("turned").bitwiseAND(F.lit(low)) if free < FULL else F.col("turned")
        options = []
        for k in range(blocks):
            by = min(k * width, free)
            turned = F.shiftleft(part, by).bitwiseOR(F.shiftrightunsigned(part, free - by)) if 0 < by < free else part
            if free < FULL:
                turned = turned.bitwiseAND(F.lit(low)).bitwiseOR(F.col("turned").bitwiseAND(F.lit(~low)))
            options.append(F.struct(F.lit(k).alias("k"), turned.alias("turned")))
        made = level.select("fp", "key", F.explode(F.array(*options)).alias("o")).select(
            "fp", "o.turned", F.xxhash64("key", "o.k", F.shiftrightunsigned("o.turned", free - share)).alias("key")
        )
        depth = FULL - free + share
        free -= share
        last = free <= 20
        rest = None
        if not last:
            large = bounded_side(made.groupBy("key").count().filter(F.col("count") > hot).select("key"), "hot-blocks")
            if not large.isEmpty():
                made = stored(made, "blocks")
                rest, made = made.join(large, "key", "left_semi"), made.join(large, "key", "left_anti")
        near = (
            made.repartition(F.col("key"))
            .withColumn("unsigned", F.col("turned").bitwiseXOR(F.lit(-(1 << 63))))
            .sortWithinPartitions("key", "unsigned")
            .select("key", "turned", "fp", F.lit(depth).alias("depth"))
            .mapInPandas(_linked(most_bits), "a long, b long")
        )
        found = near if found is None else found.union(near)
        if rest is None:
            return found
        level = rest.select("fp", "turned", "key")


def near_groups(rows: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """Per row: rid (its place), the key as doc_id, fp (64 bits), label (of its group) and component_id, the least key that
    can be reached.

    Equal fingerprints are one node from the start, so a group of copies of any size is one fingerprint in the tries.
    Null and empty texts have fingerprint 0 and are linked like any other. Null keys count for no least key; a
    group of null keys only has a null component_id. Repeated rows stay rows of their own. No rows: no rows.
    """
    numbered = placed(rows, "_near_rid").select(F.col("_near_rid").alias("rid"), F.col(key).cast("long").alias("doc_id"), utf8(text).alias("content"))
    numbered = numbered.select(F.struct("rid", "doc_id").alias("id"), "content")
    prints = stored(numbered.mapInArrow(_fingerprints(shingle), "rid struct<rid: long, doc_id: long>, fp long").select("rid.*", "fp"), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    label = components(links(nodes.select("fp"), most_bits), "label").withColumnRenamed("a", "fp")
    named = nodes.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(least, "label").select("fp", "label", "component_id"), "fp")


def distinct_rows(rows: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """One row of each group, with all its columns: the one with the least key, null keys last. Cases as in ``near_groups``.

    Rows are found again by their place; those that don't come straight from a scan are stored first.
    """
    rows = settled(rows, "settled")
    found = near_groups(rows, text, key, shingle, most_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid"))
    kept = found.groupBy("label").agg(first.alias("first")).select(F.col("first.rid").alias("_near_rid"))
    return placed(rows, "_near_rid").join(kept.hint("merge"), "_near_rid", "left_semi").drop("_near_rid")


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and groups of all documents: three words, two bits."""
    return near_groups(documents(spark, sf_dir)).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
