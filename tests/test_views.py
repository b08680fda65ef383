"""Views and as-of lookups against a row-by-row replay of random logs."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, branches, retention, transactions, views

OPS = "rid string, branch string, seq bigint, type string, status string, path string, length bigint"


def random_log(seed, n=400, hot=0.4):
    """Transactions of up to three files; one dataset and one path get a large share."""
    rng, rows = random.Random(seed), []
    for seq in range(n):
        rid = "hot" if rng.random() < hot else f"ds{rng.randrange(4)}"
        kind = rng.choices(["SNAPSHOT", "APPEND", "UPDATE", "DELETE"], [1, 8, 8, 4])[0]
        status = rng.choices(["COMMITTED", "ABORTED", "OPEN"], [8, 1, 1])[0]
        for path in {("hot.parquet" if rng.random() < hot else f"p{rng.randrange(12)}") for _ in range(rng.randrange(1, 4))}:
            rows.append((rid, "master", seq, kind, status, path, rng.randrange(100)))
    return rows


def replay(rows, start=None, end=None, statuses=("COMMITTED",)):
    live = {}
    for rid, branch, seq, kind, status, path, length in sorted(rows, key=lambda r: r[2]):
        if status not in statuses or (start is not None and seq < start) or (end is not None and seq > end):
            continue
        files = live.setdefault((rid, branch), {})
        if kind == "SNAPSHOT":
            for old in [p for p, (s, _) in files.items() if s < seq]:
                del files[old]
        if kind == "DELETE":
            files.pop(path, None)
        else:
            files[path] = (seq, length)
    return sorted((*key, p, s, n) for key, files in live.items() for p, (s, n) in files.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_view_equals_replay(spark, seed):
    rows = random_log(seed)
    ops = spark.createDataFrame(rows, OPS)
    assert rows_of(views.view_files(ops)) == replay(rows)
    assert rows_of(views.view_files(ops, end=200)) == replay(rows, end=200)
    assert rows_of(views.view_files(ops, start=100, end=300)) == replay(rows, 100, 300)
    assert rows_of(views.view_files(ops, include_open=True)) == replay(rows, statuses=("COMMITTED", "OPEN"))


def test_empty_snapshot_hides_everything(spark):
    ops = spark.createDataFrame([("a", "master", 1, "APPEND", "COMMITTED", "x", 1)], OPS)
    log = spark.createDataFrame(
        [("a", "master", 1, "APPEND", "COMMITTED"), ("a", "master", 2, "SNAPSHOT", "COMMITTED")],
        "rid string, branch string, seq bigint, type string, status string",
    )
    assert views.view_files(ops, transactions=log).count() == 0
    assert views.view_files(ops, transactions=log, end=1).count() == 1


@pytest.mark.parametrize("strict", [False, True])
def test_asof_equals_search(spark, strict):
    rng = random.Random(5)
    facts = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}", rng.randrange(20_000)) for _ in range(500)]
    refs = [(i, "hot" if rng.random() < 0.5 else f"k{rng.randrange(7)}", rng.randrange(-50, 21_000)) for i in range(800)]
    refs += [(1000 + i, k, s) for i, (k, s) in enumerate(facts[:50])]
    found = asof.latest_before(
        spark.createDataFrame(refs, "id int, k string, at bigint"),
        spark.createDataFrame(facts, "k string, seq bigint"),
        ["k"],
        at="at",
        strict=strict,
    )
    got = {r["id"]: r["found"] for r in found.collect()}
    for i, key, at in refs:
        hits = [s for k, s in facts if k == key and (s < at if strict else s <= at)]
        assert got[i] == (max(hits) if hits else None)


def test_asof_without_facts(spark):
    refs = spark.createDataFrame([("a", 5)], "k string, at bigint")
    facts = spark.createDataFrame([], "k string, seq bigint")
    assert rows_of(asof.latest_before(refs, facts, ["k"], at="at")) == [("a", 5, None)]


def test_nested_branches(spark):
    known = spark.createDataFrame(
        [("d", "master", None, None), ("d", "dev", "master", 10), ("d", "fix", "dev", 20), ("d", "early", "dev", 5)],
        "rid string, branch string, parent string, fork_seq bigint",
    )
    bounds = {(r["branch"], r["source"]): r["max_seq"] for r in branches.branch_lineage(known).collect()}
    free = branches.UNBOUNDED
    assert bounds == {
        ("master", "master"): free,
        ("dev", "dev"): free,
        ("dev", "master"): 10,
        ("fix", "fix"): free,
        ("fix", "dev"): 20,
        ("fix", "master"): 10,
        ("early", "early"): free,
        ("early", "dev"): 5,
        ("early", "master"): 5,
    }


def test_branch_cycle_is_refused(spark):
    known = spark.createDataFrame(
        [("d", "a", "b", 1), ("d", "b", "a", 1)], "rid string, branch string, parent string, fork_seq bigint"
    )
    with pytest.raises(ValueError, match="cycle"):
        branches.branch_lineage(known)


def test_fallback_of_unknown_dataset_is_null(spark):
    known = spark.createDataFrame([("a", "dev")], "rid string, branch string")
    asked = spark.createDataFrame([("a", "x"), ("b", "x")], "rid string, branch string")
    assert rows_of(branches.resolve_branch(asked, known, ["master", "dev"]).select("rid", "used_branch")) == [("a", "dev"), ("b", None)]


def test_retention_keeps_short_histories_whole(spark):
    versions = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 7)], "rid string, seq bigint")
    assert rows_of(retention.evictions(versions, ["rid"])) == [("a", 1)]


def test_logical_path_prefers_the_exact_file(spark):
    files = spark.createDataFrame(
        [("a", "m", "x"), ("a", "m", "x/1"), ("b", "m", "x/1"), ("b", "m", "xy")], "rid string, branch string, path string"
    )
    assert rows_of(views.pick_logical_path(files, "x")) == [("a", "m", "x"), ("b", "m", "x/1")]
    assert views.pick_logical_path(files, None).count() == 4


def test_log_rules(spark):
    log = spark.createDataFrame(
        [("a", "m", 1, "OPEN"), ("a", "m", 2, "OPEN"), ("b", "m", 1, "OPEN"), ("b", "m", 2, "COMMITTED"), ("c", "m", 1, "COMMITTED"), ("c", "m", 2, "OPEN")],
        "rid string, branch string, seq bigint, status string",
    )
    assert rows_of(transactions.log_violations(log)) == [("a", "m", 2, True, False), ("b", "m", 1, False, True)]


def test_range_filters_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("seq"), F.col("event_type").alias("status"))
    plan = views.in_range(events, 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_id,10)" in plan and "LessThanOrEqual(event_id,20)" in plan


def test_view_aggregates_in_hash_tables_before_the_shuffle(spark, sf_dir):
    from tidemark.plans import queries_versions

    plan = queries_versions.view_files(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan and "partial_max" in plan


def test_top_per_key_is_limited_before_the_shuffle(spark, sf_dir):
    from tidemark.plans import queries_lineage

    plan = queries_lineage.latest_check_runs(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
