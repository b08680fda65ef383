"""Listings, lineage and statistics against plain Python, with keys that hold a large share of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import catalog, lineage, stats


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def reach(edges, seeds, ignored):
    seen = set(seeds) - set(ignored)
    todo = list(seen)
    while todo:
        node = todo.pop()
        for a, b in edges:
            if a == node and b not in seen and b not in ignored:
                seen.add(b)
                todo.append(b)
    return seen


@pytest.mark.parametrize("seed", range(2))
def test_lineage_equals_search(spark, seed):
    rng = random.Random(seed)
    # node 0 is a hub that a third of the edges touch; cycles are allowed
    pairs = {(rng.choice([0, rng.randrange(60), rng.randrange(60)]), rng.choice([0, rng.randrange(60), rng.randrange(60)])) for _ in range(90)}
    edges = spark.createDataFrame(sorted(pairs), "child int, parent int")
    node = lambda *ns: spark.createDataFrame([(n,) for n in ns], "node int")
    up = reach(pairs, [3, 7], [11, 12])
    assert {r[0] for r in lineage.upstream(edges, node(3, 7), node(11, 12)).collect()} == up
    down = reach({(b, a) for a, b in pairs}, [5, 0], [11])
    both = down & reach(pairs, [3, 7], [11])
    assert {r[0] for r in lineage.connecting(edges, node(5, 0), node(3, 7), node(11)).collect()} == both


def test_closure_of_nothing(spark):
    edges = spark.createDataFrame([(1, 2)], "child int, parent int")
    assert lineage.upstream(edges, spark.createDataFrame([], "node int")).count() == 0


def test_forced_builds_are_all_due(spark):
    log = spark.createDataFrame(
        [("a", "m", 1, "APPEND", "COMMITTED"), ("b", "m", 5, "APPEND", "COMMITTED"), ("c", "m", 9, "APPEND", "ABORTED")],
        "rid string, branch string, seq bigint, type string, status string",
    )
    edges = spark.createDataFrame([("b", "a"), ("c", "a"), ("a", "b")], "child string, parent string")
    assert rows_of(lineage.stale_outputs(edges, log)) == [("a", 1, 5), ("c", None, 1)]
    assert len(rows_of(lineage.stale_outputs(edges, log, force=True))) == 3


def test_events_page_is_exact_on_sparse_ids(spark):
    rng = random.Random(3)
    ids = sorted(rng.sample(range(1_000_000), 300))
    events = spark.createDataFrame([(i, "a" if n % 3 else "b") for n, i in enumerate(ids)], "event_id bigint, event_type string")
    wanted = [i for n, i in enumerate(ids) if n % 3]
    for limit in (1, 7, 250, 1000):
        assert [r[0] for r in catalog.events_page(events, ["a"], limit).collect()] == wanted[:limit]
    after = wanted[50]
    assert [r[0] for r in catalog.events_page(events, ["a"], 5, after).collect()] == wanted[51:56]
    assert catalog.events_page(events, ["a"], 5, 2_000_000).count() == 0


def test_search_pages_follow_each_other(spark):
    rows = [(f"r{i:02d}", f"N{i % 4}", i, ["t"]) for i in range(12)]
    resources = spark.createDataFrame(rows, "rid string, name string, last_modified int, tags array<string>")
    seen, after = [], None
    while True:
        page = catalog.search_resources(resources, query="n", tags=["t", "u"], sort=("NAME", "DESC"), page_size=5, after=after).collect()
        if not page:
            break
        seen += [(r["name"], r["rid"]) for r in page]
        after = seen[-1]
    assert seen == sorted(((n, r) for r, n, _, _ in rows), key=lambda p: (-int(p[0][1:]), p[1]))
    assert catalog.search_resources(resources, tags=["x"]).count() == 0
    with pytest.raises(ValueError):
        catalog.search_resources(resources, sort=("SIZE", "ASC"))


def test_sort_specs(spark):
    resources = spark.createDataFrame(
        [("1", "/f/b", "dataset", 5), ("2", "/f/a", "dataset", 9), ("3", "/f/c", "folder", 7)],
        "rid string, path string, kind string, last_modified int",
    )

    def listed(**kwargs):
        return [r["rid"] for r in catalog.list_children(resources, **kwargs).orderBy("position").collect()]

    assert listed() == ["2", "1", "3"] and listed(sort="name desc") == ["3", "1", "2"]
    assert listed(sort="lastModified") == ["1", "3", "2"] and listed(sort="rid desc") == ["3", "2", "1"]
    assert listed(kinds=["dataset"], limit=1) == ["2"]
    assert listed(folder="/f", sort="lastModified", limit=1, after=(5, "1")) == ["3"]
    assert listed(folder="/f", sort="name desc", after=("b", "1")) == ["2"] and listed(folder="/g") == []
    for bad in ("size", "name up"):
        with pytest.raises(ValueError):
            catalog.sort_order(bad)


def test_page_size_is_clamped():
    assert catalog.page_size_within(10) == 10
    with pytest.warns(UserWarning):
        assert catalog.page_size_within(0) == 1
    with pytest.warns(UserWarning):
        assert catalog.page_size_within(501) == 500


def test_identity_needs_exactly_one_hit(spark):
    ids = spark.createDataFrame(
        [("/a", "ri.x.main.dataset.1"), ("/b", "ri.x.main.dataset.2"), ("/b", "ri.x.main.dataset.3")],
        "dataset_path string, dataset_rid string",
    )
    refs = spark.createDataFrame([("/a",), ("/b",), ("/c",), ("ri.x.main.dataset.3",)], "ref string")
    got = {r["ref"]: (r["hits"], r["dataset_rid"]) for r in catalog.identity_lookup(refs, ids).collect()}
    assert got == {
        "/a": (1, "ri.x.main.dataset.1"),
        "/b": (2, None),
        "/c": (0, None),
        "ri.x.main.dataset.3": (1, "ri.x.main.dataset.3"),
    }


def test_set_patches_last_one_wins(spark):
    members = spark.createDataFrame([("g", "a"), ("g", "b")], "grp string, member string")
    patches = spark.createDataFrame(
        [("g", "a", 1, "REMOVE"), ("g", "c", 2, "ADD"), ("g", "a", 3, "ADD"), ("g", "b", 4, "REMOVE"), ("h", "x", 5, "REMOVE")],
        "grp string, member string, seq int, operation string",
    )
    assert rows_of(catalog.apply_set_patches(members, patches, "grp")) == [("g", "a"), ("g", "c")]


def test_column_stats(spark):
    df = spark.createDataFrame([("aa", 1), ("aa", None), (None, None), ("b", 10)], "s string, n int")
    got = {r["column"]: tuple(r)[1:] for r in stats.column_stats(df).collect()}
    assert got["s"] == (4, 1, 2, 5 / 3, 2) and got["n"] == (4, 2, 2, 1.5, 2)


def test_size_gate_bounds(spark):
    sized = spark.createDataFrame([(500 * 1024 * 1024 - 1,), (500 * 1024 * 1024,)], "size_in_bytes bigint")
    assert [r["read_mode"] for r in stats.size_gate(sized).orderBy("size_in_bytes").collect()] == ["FULL", "SAMPLE"]
    assert {r["read_mode"] for r in stats.size_gate(sized, force_full=True).collect()} == {"FULL"}


def test_random_sample_equals_sorting_everything(spark):
    df = spark.range(0, 20_000, 1, 8)
    drawn = {r["id"] for r in stats.sample_random(df, 500, seed=11).collect()}
    sorted_all = df.withColumn("r", F.rand(11)).orderBy("r").limit(500)
    assert drawn == {r["id"] for r in sorted_all.collect()} and len(drawn) == 500
    assert stats.sample_random(df, 50_000).count() == 20_000
    assert stats.sample_first(df, 10).count() == 10 and stats.sample_first(df.limit(3), 10).count() == 3
