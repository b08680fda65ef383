"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _stars(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Links every neighbour (only larger ones, or only smaller ones and the node itself) to the node's least neighbour."""
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger_only else pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if larger_only:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, label: str = "component") -> DataFrame:
    """(a, label): each node of ``links`` (a, b) with the least node that can be reached from it, least nodes left out.

    Large-star and small-star steps alternate until the links no longer change; every round is a written table. A node
    with very many neighbours is one key of a join that adaptive execution splits and of an aggregation that combines
    before the shuffle. No links: no rows.
    """
    now, count = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    while count:
        starred, _ = materialize(_stars(now, True), "large-star")
        after, count = materialize(_stars(starred, False), "small-star")
        changed = after.exceptAll(now).limit(1).count() or now.exceptAll(after).limit(1).count()
        now = after
        if not changed:
            break
    return now.select("a", F.col("b").alias(label))
