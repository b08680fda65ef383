"""Lineage between datasets, and the build questions asked of it.

Edges hold child and parent: a child dataset is built from its parents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.transactions import last_transactions, top_per_key
from tidemark.session import materialize, measured_side

# Fixed value: runs listed per check.
RUNS_PER_CHECK = 5
# Rounds of a closure kept as tables of their own before they become one.
ROUNDS_APART = 8
# Hops that one round follows while the newest nodes are at most so many: long thin chains would need a job for each hop.
HOPS, NARROW = 3, 100_000


def closure(
    edges: DataFrame,
    seeds: DataFrame,
    *,
    source: str,
    target: str,
    ignore: DataFrame | None = None,
) -> DataFrame:
    """Nodes reachable from seeds(node) along source → target, seeds included; ignored nodes are not entered.

    Each round follows the edges of the newest nodes only, some hops at once while these are few, and writes what it
    found as a table, so the lineage stays one round deep and a lost executor costs at most that round. The frontier has
    one row per node and a known size: Catalyst broadcasts it when small, and splits a hub's edges by the skew-join rule
    when not. Visited nodes are not entered again, so the rounds end by themselves; every few rounds they are folded into
    one table.
    """
    links = edges.select(F.col(source).alias("node"), F.col(target).alias("next"))

    def without(nodes: DataFrame, known: DataFrame | None) -> DataFrame:
        return nodes if known is None else nodes.join(known.select("node"), "node", "left_anti")

    frontier, found = materialize(without(seeds.select("node").distinct(), ignore), "closure")
    rounds = [frontier]
    while found:
        if len(rounds) > ROUNDS_APART:
            rounds = [materialize(reduce(DataFrame.union, rounds), "closure")[0]]
        seen, step, hops = reduce(DataFrame.union, rounds), frontier, []
        for hop in range(1, (HOPS if found <= NARROW else 1) + 1):
            step = without(links.join(step, "node", "left_semi").select(F.col("next").alias("node")).distinct(), ignore)
            hops.append(step.withColumn("hop", F.lit(hop)))
        new = without(reduce(DataFrame.union, hops).groupBy("node").agg(F.min("hop").alias("hop")), seen)
        table, _ = materialize(new, "closure")
        rounds.append(table.select("node"))
        # nodes found before the last hop were followed in it
        frontier = table.where(F.col("hop") == len(hops)).select("node")
        found = frontier.count()
    return reduce(DataFrame.union, rounds)


def upstream(edges: DataFrame, targets: DataFrame, ignore: DataFrame | None = None) -> DataFrame:
    """Everything the target datasets are built from, themselves included, not exploring past ignored ones."""
    return closure(edges, targets, source="child", target="parent", ignore=ignore)


def connecting(edges: DataFrame, above: DataFrame, below: DataFrame, ignore: DataFrame | None = None) -> DataFrame:
    """Datasets on any path from the upstream set ``above`` to the downstream set ``below``."""
    down = closure(edges, above, source="parent", target="child", ignore=ignore)
    # a node on such a path is reached downwards, so the upward search may keep to those edges
    inner, _ = materialize(edges.join(down.withColumnRenamed("node", "parent"), "parent", "left_semi"), "between")
    up = closure(inner, below, source="child", target="parent", ignore=ignore)
    return down.join(up, "node", "left_semi")


def select_jobs(specs: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(job specs chosen by ``wanted(key, required)``, required keys that no spec has)."""
    asked = measured_side(wanted.groupBy(key).agg(F.bool_or("required").alias("required")), "wanted")
    chosen = specs.join(asked, key, "left_semi")
    # only the asked keys that have a spec are compared, not all specs
    present = specs.select(key).join(asked, key, "left_semi").distinct()
    missing = asked.where("required").select(key).join(present, key, "left_anti")
    return chosen, missing


def stale_outputs(edges: DataFrame, transactions: DataFrame, *, force: bool = False) -> DataFrame:
    """Children whose newest committed transaction is older than that of some parent (or that have none).

    With ``force`` every child is due.
    """
    newest = measured_side(last_transactions(transactions, keys=["rid"]).select("rid", "seq"), "newest")
    per_child = (
        edges.join(newest.select(F.col("rid").alias("parent"), F.col("seq").alias("parent_seq")), "parent")
        .groupBy("child")
        .agg(F.max("parent_seq").alias("newest_input"))
    )
    joined = per_child.join(newest.select(F.col("rid").alias("child"), F.col("seq").alias("output_seq")), "child", "left")
    due = F.col("output_seq").isNull() | (F.col("newest_input") > F.col("output_seq")) | F.lit(force)
    return joined.where(due).select("child", "output_seq", "newest_input")


def latest_runs(runs: DataFrame, check: str = "check_rid", n: int = RUNS_PER_CHECK) -> DataFrame:
    """The last ``n`` runs of each check."""
    return top_per_key(runs, [check], [F.col("seq").desc()], n, "position")


def checks_for(checks: DataFrame, rid: str, branch: str) -> DataFrame:
    return checks.where((F.col("rid") == rid) & (F.col("branch") == branch))


def schedules_for(schedules: DataFrame, rid: str, branch: str | None = None) -> DataFrame:
    """Schedules whose build targets hold the dataset."""
    rows = schedules.where(F.array_contains("dataset_rids", rid))
    return rows if branch is None else rows.where(F.col("branch") == branch)
