"""Mixing sources to target weights: fixed-length blocks drawn through pseudorandom index permutations."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import WORD, documents, placed, settled, stored, unit_hash, with_prefix

SHARDS = 16
BLOCK = 64  # words
SHARE = 1.5
MOST = 2.0  # of a source's own size
WEIGHTS = (3, 1, 2)
SEED = 31
SLOTS_A_ROW = 8192


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words of each source: ``share`` of all words by weight, at most ``most`` times the source, the excess reshared."""
    caps = [most * s for s in sizes]
    result, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s], share * sum(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > caps[i]]
        if not full:
            for i in open_:
                result[i] = weights[i] * unit
            break
        for i in full:
            result[i] = caps[i]
            left -= caps[i]
        open_ = [i for i in open_ if i not in set(full)]
    return result


def draw_counts(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source in each shard: multinomial draws conditional on the totals, so that these are met exactly."""
    generator, left = np.random.default_rng(seed), np.array(slots, np.int64)
    counts = np.zeros((shards, len(slots)), np.int64)
    for k in range(shards):
        want = int(left.sum()) // (shards - k)
        if k == shards - 1:
            counts[k] = left
        else:  # source after source: what a multinomial has given its total, without keeping a row per slot
            rest = int(left.sum())
            for i, have in enumerate(left):
                got = int(generator.hypergeometric(have, rest - have, want)) if want and have and rest < 1_000_000_000 else _large(generator, int(have), rest, want)
                counts[k, i], want, rest = got, want - got, rest - int(have)
        left -= counts[k]
    return counts


def _large(generator: np.random.Generator, have: int, rest: int, want: int) -> int:
    """The draw of ``hypergeometric`` beyond numpy's bound, by its normal limit; 0 where there is nothing to draw."""
    if not (want and have):
        return 0
    share = have / rest
    spread = (want * share * (1 - share) * (rest - want) / max(1, rest - 1)) ** 0.5
    return int(min(have, want, max(0, want - (rest - have), round(generator.normal(want * share, spread)))))


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0 to n - 1 for each key: a Feistel network, walked until it falls below n."""
    index, n, key = index.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(index))
    while len(todo):
        x, h, m, k = index[todo], half[todo], mask[todo], key[todo]
        left, right = x >> h, x & m
        for r in range(4):
            mixed = (right + k + np.uint64(r * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & m)
        index[todo] = (left << h) | right
        todo = todo[index[todo] >= n[todo]]
    return index.astype(np.int64)


def _slot_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        epoch, at = b["j"].to_numpy() // b["n_blocks"].to_numpy(), b["j"].to_numpy() % b["n_blocks"].to_numpy()
        with np.errstate(over="ignore"):
            block = permute(at, b["n_blocks"].to_numpy(), b["g"].to_numpy().astype(np.uint64) + epoch.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        yield pd.DataFrame({"g": b["g"], "shard": b["shard"], "j": b["j"], "epoch": epoch, "block": block})


def sizes_of(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with ``size``, the number of words of the text (null: 0)."""
    return rows.withColumn("size", F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"))


def mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, shards: int = SHARDS, block: int = BLOCK, share: float = SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The mixture of stored rows (rid, doc_id, source, size and, if there is one, tie): a row per source, and a row per piece drawn.

    ``tie`` is a hash of the text: rows are shuffled by doc_id and tie, so that rows with one id don't lie together.

    Sources: g, source, source_size, target. Pieces: rid, g, shard, j (the slot within the source), epoch, first and
    length (words of the row, counted from 0): ``shard``, ``g`` and ``j`` say where the piece stands in the output.

    Each source's words, its rows shuffled by a seeded hash, are cut into blocks of ``block`` words (fewer in a source
    of under 256 blocks); the blocks of a shard are drawn by source, a slot finds its block through the source's
    permutation, a new one each time all blocks are used up, and slots and blocks are joined by index. Nothing is used
    more than ``ceil(target / source_size)`` times. Only one row for each source passes the driver.

    Null sources are a source of their own, last in order. Rows without words are in no block. Ties and repeated rows
    are rows of their own by ``rid``. No rows: both results are empty.
    """
    spark = sized.sparkSession
    tie = F.col("tie") if "tie" in sized.columns else F.lit(0).cast("long")
    keyed = sized.withColumn("g", F.xxhash64(F.col("source").isNull(), F.col("source"))).withColumn("u", unit_hash(F.col("doc_id"), tie, F.lit(seed)))
    found = keyed.groupBy("source", "g").agg(F.sum("size").alias("size")).collect()
    found.sort(key=lambda r: (r.source is None, (r.source or "").encode("utf-32-be")))
    goal = targets([r.size for r in found], [weights[i % len(weights)] for i in range(len(found))], share)
    plan, slots = [], []
    for r, t in zip(found, goal, strict=True):
        length = min(block, max(1, r.size // 256))
        blocks = -(-r.size // length)
        slots.append(round(t * blocks / r.size) if r.size else 0)
        plan.append((r.g, r.source, r.size, t, length, max(1, blocks)))
    sources = spark.createDataFrame(plan, "g long, source string, source_size long, target double, block_words long, n_blocks long")
    counts = draw_counts(slots, shards, seed) if plan else np.zeros((0, 0), np.int64)
    first = np.cumsum(counts, axis=0) - counts
    runs = [(plan[i][0], k, int(first[k, i]), int(counts[k, i]), plan[i][5]) for k in range(counts.shape[0]) for i in range(counts.shape[1]) if counts[k, i]]
    drawn = (
        spark.createDataFrame(runs, "g long, shard int, first long, count long, n_blocks long")
        .withColumn("part", F.explode(F.expr(f"sequence(0L, (count - 1) div {SLOTS_A_ROW})")))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "g", "shard", "part")
        .withColumn("j", F.explode(F.expr(f"sequence(first + part * {SLOTS_A_ROW}, first + least(count, (part + 1) * {SLOTS_A_ROW}) - 1)")))
        .select("g", "shard", "j", "n_blocks")
        .mapInPandas(_slot_blocks, "g long, shard int, j long, epoch long, block long")
    )
    lengths = F.broadcast(sources.select("g", "block_words"))
    spans = with_prefix(keyed.select("rid", "doc_id", "g", "u", "size"), "g", "u", ["doc_id", "rid"], "size").filter("size > 0").join(lengths, "g")
    pieces = spans.withColumn("block", F.explode(F.expr("sequence(start div block_words, (start + size - 1) div block_words)"))).select(
        "g",
        "block",
        "rid",
        (F.greatest(F.expr("block * block_words"), F.col("start")) - F.col("start")).alias("first"),
        (F.least(F.expr("(block + 1) * block_words"), F.expr("start + size")) - F.greatest(F.expr("block * block_words"), F.col("start"))).alias("length"),
    )
    # the plan's size estimate knows nothing of the explosion: never broadcast the slots
    return sources, pieces.join(drawn.hint("merge"), ["g", "block"]).select("rid", "g", "shard", "j", "epoch", "first", "length")


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def taken_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The words of (first, count) spans, in order; neighbouring spans are one, others are joined by a newline."""
    edges = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    if sum(n for _, n in spans) == len(edges):
        return text
    merged: list[list[int]] = []
    for first, count in sorted(spans):
        if merged and merged[-1][1] == first:
            merged[-1][1] += count
        else:
            merged.append([first, first + count])
    return "\n".join(text[edges[a][0] : edges[b - 1][1]] for a, b in merged)


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [taken_text(t.as_py(), [(s["first"], s["length"]) for s in spans.as_py()]) for t, spans in zip(b.column(1), b.column(2), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["rest", "text"])


def mixed_rows(rows: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The mixture as rows with the columns of ``rows``: a row for each time some of its words are taken, with these words.

    A row whose words are all taken keeps its whole text; ``length``, if there is such a column, becomes the length of the new text in
    characters. Rows without words are in no mixture. Other cases as in ``mix``. Rows are found again by their place; those
    that don't come straight from a scan are stored first. Other columns may have any names but ``_mix_rid``.
    """
    rows = settled(rows, "settled")
    marked = placed(rows, "_mix_rid")
    sized = stored(sizes_of(marked.drop("size"), text).select(F.col("_mix_rid").alias("rid"), "doc_id", "source", "size", F.xxhash64(F.col(text)).alias("tie")), "sizes")
    _, pieces = mix(sized)
    per_row = pieces.groupBy("rid", "epoch").agg(F.collect_list(F.struct("first", "length")).alias("spans")).select(F.col("rid").alias("_mix_rid"), "spans")
    others = [c for c in rows.columns if c != text]
    rest = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)])
    joined = marked.join(per_row.hint("merge"), "_mix_rid").select(rest.alias("rest"), F.col(text).alias("text"), "spans")
    made = joined.mapInArrow(_taken, f"rest {joined.schema['rest'].dataType.simpleString()}, text string")
    new = {c: F.col(f"rest.c{i}") for i, c in enumerate(others)} | {text: F.col("text")}
    if length in new:
        new[length] = F.char_length("text").cast(rows.schema[length].dataType)
    return made.select(*[new[c].alias(c) for c in rows.columns])


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by the weights 3, 1, 2; words taken of each."""
    sized = stored(sizes_of(documents(spark, sf_dir)).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", "size", F.xxhash64("text").alias("tie")), "sizes")
    sources, pieces = mix(sized)
    taken = pieces.groupBy("rid").agg(F.sum("length").alias("taken"))
    by_source = F.broadcast(sources.select(F.col("source").alias("_source"), "source_size", "target"))
    return (
        sized.drop("tie").join(by_source, F.col("source").eqNullSafe(F.col("_source")))
        .join(taken, "rid", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "source")
    )
