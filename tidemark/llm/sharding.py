"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import documents, stored, unit_hash, utf8, with_prefix

SHARDS = 16
SEED = 20


def shard(rows: DataFrame, strata: str = "source", key: str = "doc_id", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Adds ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0) so that every shard has the mixture of the strata.

    Rows are shuffled within their stratum by a seeded hash of ``key`` and all columns and ranked, so rows that share a key
    spread like others; the fractional rank
    (rank + phase) / n, with a phase from 0 to 1 that depends on the stratum, interleaves the strata. The rows in
    that order are cut into shards whose row counts differ by one at most.

    Nulls: null strata are a stratum of their own, null keys a key. Rows equal in all columns are interchangeable and
    lie side by side. An empty table gives an empty result. All
    columns are kept; names starting with ``_shard_`` are reserved. The rows are written to the shared folder once,
    so pass narrow rows.
    """
    own = rows.columns
    table = stored(
        rows.withColumns(
            {
                "_shard_stratum": F.xxhash64(F.col(strata).isNull(), F.col(strata), F.lit(seed)),
                "_shard_unit": unit_hash(F.col(key), F.lit(seed), F.xxhash64(*own)),
                "_shard_tie": F.xxhash64(*own),
            }
        ),
        "shuffled",
    )
    ranked = with_prefix(table.select(*[F.col(c).alias(f"_shard_c{i}") for i, c in enumerate(own)], *_HIDDEN), "_shard_stratum", "_shard_unit", ["_shard_tie"])
    phase = unit_hash(F.col("_shard_stratum"), F.lit(seed + 1))
    merged = stored(
        ranked.withColumn("_shard_unit", (F.col("rank") + phase) / F.col("n")).withColumn("_shard_all", F.lit(0)).drop("n", "rank"), "interleaved"
    )
    cut = with_prefix(merged, "_shard_all", "_shard_unit", ["_shard_stratum", "_shard_tie"])
    at = F.expr(f"(rank * {shards}) div n").cast("long")
    return cut.withColumn("_shard_at", at).select(
        *[F.col(f"_shard_c{i}").alias(c) for i, c in enumerate(own) if c not in ("shard", "slot")],
        F.col("_shard_at").cast("int").alias("shard"),
        (F.col("rank") - F.expr(f"(_shard_at * n + {shards - 1}) div {shards}")).alias("slot"),
    )


_HIDDEN = ["_shard_stratum", "_shard_unit", "_shard_tie"]


def op3_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards; law ``rows``."""
    narrow = documents(spark, sf_dir).select(
        "doc_id",
        "source",
        (F.octet_length(utf8()) + 1).cast("long").alias("size"),
        F.crc32(utf8()).alias("text_crc32"),
    )
    return shard(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )
