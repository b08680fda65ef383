"""Branches: lineage of forks, views of child branches, fallback to another branch.

A branches frame holds: rid string, branch string, parent string (NULL for a root), fork_seq bigint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, measured_side

UNBOUNDED = (1 << 63) - 1


def branch_lineage(branches: DataFrame) -> DataFrame:
    """(rid, branch, source, max_seq): transactions of ``source`` up to ``max_seq`` belong to ``branch``.

    Every step follows one parent link, and the tightest fork bound on the way applies. The loop ends when no
    branch has a parent left. A chain longer than its dataset has branches runs in a cycle, which is an error.
    Levels are written out, which keeps each step one join deep.
    """
    links = branches.select(
        "rid", F.col("branch").alias("source"), F.col("parent").alias("next"), F.col("fork_seq").alias("bound")
    )
    level, _ = materialize(
        branches.select("rid", "branch", F.col("branch").alias("source"), F.lit(UNBOUNDED).alias("max_seq")), "lineage"
    )
    lineage = level
    longest = branches.groupBy("rid").count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest):
        level, found = materialize(
            level.join(links, ["rid", "source"])
            .where(F.col("next").isNotNull())
            .select(
                "rid",
                "branch",
                F.col("next").alias("source"),
                F.least("max_seq", F.coalesce("bound", F.lit(UNBOUNDED))).alias("max_seq"),
            ),
            "lineage",
        )
        if not found:
            return lineage
        lineage = lineage.unionByName(level)
    if longest:
        raise ValueError("the parent links of branches form a cycle")
    return lineage


def inherited_ops(ops: DataFrame, lineage: DataFrame) -> DataFrame:
    """Operations as each branch sees them: its own, and its ancestors' up to the fork."""
    own = ops.withColumnRenamed("branch", "source")
    return (
        own.join(measured_side(lineage, "lineage"), ["rid", "source"])
        .where(F.col("seq") <= F.col("max_seq"))
        .drop("source", "max_seq")
    )


def list_branches(transactions: DataFrame, branches: DataFrame | None = None) -> DataFrame:
    """Branches with their first and last committed transaction (NULL where a branch has none)."""
    seen = transactions.groupBy("rid", "branch").agg(
        F.min(F.when(F.col("status") == "COMMITTED", F.col("seq"))).alias("first_seq"),
        F.max(F.when(F.col("status") == "COMMITTED", F.col("seq"))).alias("last_seq"),
        F.count_if(F.col("status") == "COMMITTED").alias("committed"),
    )
    return seen if branches is None else branches.join(seen, ["rid", "branch"], "left")


def resolve_branch(requests: DataFrame, branches: DataFrame, fallbacks: list[str]) -> DataFrame:
    """The branch each request gets: the wanted one, else the first fallback the dataset has, else NULL.

    ``requests`` holds rid and branch; ``branches`` must have one row per (rid, branch). The candidates of a
    dataset are reduced to one flag per fallback before the join, so a request matches at most two rows.
    """
    known = measured_side(branches.select("rid", "branch"), "branches")
    wanted = requests.join(known.withColumn("found", F.lit(True)), ["rid", "branch"], "left")
    order = F.array(*map(F.lit, fallbacks))
    best = (
        known.where(F.col("branch").isin(fallbacks))
        .groupBy("rid")
        .agg(F.min(F.array_position(order, F.col("branch")).cast("int")).alias("fallback_position"))
    )
    return (
        wanted.join(measured_side(best, "fallbacks"), "rid", "left")
        .withColumn(
            "used_branch",
            F.when(F.col("found"), F.col("branch")).otherwise(F.get(order, F.col("fallback_position") - 1)),
        )
        .drop("found", "fallback_position")
    )
