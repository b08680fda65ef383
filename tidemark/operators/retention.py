"""Cached versions: hits and misses, retention, last write wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.transactions import top_per_key
from tidemark.session import measured_side

# Fixed value: versions kept per dataset.
KEEP_VERSIONS = 2


def cache_hits(wanted: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(cached.select(*keys), keys, "left_semi")


def cache_misses(wanted: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(cached.select(*keys), keys, "left_anti")


def evictions(versions: DataFrame, keys: list[str], keep: int = KEEP_VERSIONS) -> DataFrame:
    """Versions(keys, seq) older than the newest ``keep`` of their key.

    The cut-off is the oldest kept version, found from at most ``keep`` rows per key and map task; the evicted
    rows are then a plain filter on a join, without ranking a whole key. The cut-offs are measured first:
    while they are few, the versions are not shuffled at all.
    """
    newest = top_per_key(versions.select(*keys, "seq").distinct(), keys, [F.col("seq").desc()], keep)
    cut = measured_side(newest.groupBy(*keys).agg(F.min("seq").alias("oldest_kept")), "cutoffs")
    return versions.join(cut, keys).where(F.col("seq") < F.col("oldest_kept")).drop("oldest_kept")


def upsert(existing: DataFrame, updates: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Rows after writing ``updates`` over ``existing``: per key the row with the highest ``order``.

    Fixed-width columns only, so that the aggregation stays a hash aggregation with a map-side part.
    """
    rest = [c for c in existing.columns if c not in keys and c != order]
    return (
        existing.unionByName(updates)
        .groupBy(*keys)
        .agg(F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in rest])
        .select(*existing.columns)
    )
