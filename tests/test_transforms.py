import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import errors, transforms
from tidemark.plans.cache import VersionCache
from tidemark.plans.store import Store
from tidemark.transforms import (
    Context,
    Input,
    Markings,
    OrgMarkings,
    Output,
    configure,
    incremental,
    lightweight,
    transform,
    transform_df,
    transform_pandas,
    transform_polars,
)


@pytest.fixture(scope="module")
def shared(spark):
    """A store with two small inputs, and files without a schema."""
    store = Store(spark)
    for path, rows in (("/input1", [("1", "x")]), ("/input2", [("2", "y")])):
        store.create_dataset(path).save_dataframe(spark.createDataFrame(rows, "a string, b string").coalesce(1))
    with store.create_dataset("/binary").transaction_context("SNAPSHOT"):
        pass
    store.dataset("/binary").put_file("bin", b"\x00\x01", kind="SNAPSHOT")
    return store


@pytest.fixture
def context(shared):
    return Context(shared)


def test_transform_df(context):
    @transform_df(Output("/o"), one=Input("/input1"), two=Input("/input2"))
    def stack(one, two):
        return one.union(two)

    assert sorted(r["a"] for r in stack.compute(context).collect()) == ["1", "2"]

    @transform_df(Output("/o"), one=Input("/input1"))
    def wrong(one):
        return one.toPandas()

    with pytest.raises(TypeError, match="DataFrame"):
        wrong.compute(context)


def test_context_argument(context):
    @transform_df(Output("/o"), one=Input("/input1"))
    def uses(ctx, one):
        assert ctx.spark_session is context.spark and ctx.is_incremental is False
        return one

    assert uses.compute(context).count() == 1


def test_specs_are_checked(context):
    with pytest.raises(TypeError):
        transform_df(Output("/o"), one="/input1")(lambda one: one)
    with pytest.raises(TypeError):
        transform_df("/o", one=Input("/input1"))(lambda one: one)
    with pytest.raises(TypeError):
        transform(one="/input1")

    @transform_df(Output("/o"), one=Input("/input1"))
    def fails(one):
        raise KeyError("inner")

    with pytest.raises(KeyError) as info:
        fails.compute(context)
    assert getattr(info.value, "__transform_compute_error") is True
    with pytest.raises(errors.UninitializedInputError):
        Input("/input1").dataframe()


def test_a_transform_lists_and_writes_files(context, tmp_path):
    """Texts written by language: what a listing by glob and pattern gives, on the output and on the input."""
    context.output_folder = str(tmp_path)
    texts = {"de/001.md": "eins", "de/deep/002.md": "zwei", "fr/003.txt": "trois", "index.md": "all"}
    globs = {
        "*.md": ["index.md"],
        "**/*.md": ["de/001.md", "de/deep/002.md", "index.md"],
        "de/*": ["de/001.md"],
        "de/**": ["de/001.md", "de/deep/002.md"],
        "*/**": ["de/001.md", "de/deep/002.md", "fr/003.txt"],
        "**/00?.*": ["de/001.md", "de/deep/002.md", "fr/003.txt"],
    }

    @transform(pages=Output("/corpus/pages"), unused=Output("/corpus/unused"), rows=Input("/input1"))
    def by_language(rows, pages, unused):
        assert rows.path == "/input1" and rows.branch == "master" and pages.path == "/corpus/pages"
        files = pages.filesystem()
        for path, text in texts.items():
            with files.open(path, "w") as page:
                page.write(text)
        for glob, paths in globs.items():
            assert [f.path for f in files.ls(glob=glob)] == paths
        assert [f.path for f in files.ls(regex="(de|fr)/[^/]+$")] == ["de/001.md", "fr/003.txt"]
        assert {f.path: f.size for f in files.ls()} == {path: len(text) for path, text in texts.items()}
        assert [files.open(f.path).read() for f in files.ls(glob="fr/*")] == ["trois"]
        listed = [f.path for f in rows.filesystem().ls()]
        for glob in ("*", "**", "*/**", "spark/*.parquet", "**/*.csv"):
            same = rows.filesystem().files(glob=glob).select("path").collect()
            assert sorted(r["path"] for r in same) == [f.path for f in rows.filesystem().ls(glob=glob)]
        assert len(listed) == 1 and listed[0].startswith("spark/part-")
        pages.write_dataframe(rows.dataframe().select(F.length("a").alias("size")))

    result = by_language.compute(context)
    assert result["pages"].columns == ["size"] and result["unused"] is None
    assert {p: (tmp_path / "pages" / p).read_text() for p in texts} == texts and not (tmp_path / "unused").exists()


def test_build_commits_frames_and_files(spark, shared):
    @transform(out=Output("/built"), one=Input("/input1"))
    def work(one, out):
        out.write_dataframe(one.dataframe())
        with out.filesystem().open("_notes.txt", "w") as f:
            f.write("n")

    work.build(Context(shared))
    built = shared.dataset("/built")
    assert [r["a"] for r in built.dataframe().collect()] == ["1"]
    assert sorted(r["path"].split("/")[0] for r in built.files().collect()) == ["_notes.txt", "spark"]
    record = json.loads(built.last_transaction()["provenance"])["provenanceRecords"][0]
    assert record["datasetRid"] == shared.dataset("/input1").rid


def test_failed_build_commits_nothing(spark, shared):
    @transform_df(Output("/never"), one=Input("/input1"))
    def broken(one):
        return one.select(F.raise_error(F.lit("stop")).cast("string").alias("x"))

    with pytest.raises(Exception, match="stop"):
        broken.build(Context(shared))
    assert shared.dataset("/never").last_transaction() is None


def test_pandas_on_the_driver_is_bounded(context):
    @transform_pandas(Output("/o"), one=Input("/input1"), two=Input("/input2"))
    def stack(one, two):
        return pd.concat([one, two], ignore_index=True)

    assert stack.compute(context).a.tolist() == ["1", "2"]
    context.driver_limit_mb = -1
    with pytest.raises(errors.InputTooLargeError):
        stack.compute(context)

    @transform_pandas(Output("/o"), schema="a string, n bigint", merge={"n": "sum"}, one=Input("/input1"))
    def count(one):
        return one.groupby("a").size().rename("n").reset_index()

    assert [tuple(r) for r in count.compute(context).collect()] == [("1", 1)]

    @transform_pandas(Output("/o"), one=Input("/input1"))
    def wrong(one):
        return 1

    context.driver_limit_mb = 1
    with pytest.raises(TypeError):
        wrong.compute(context)


def test_lightweight(context):
    @lightweight
    @transform(out=Output("/o"), one=Input("/input1"))
    def work(one, out):
        assert one.pandas().a.tolist() == ["1"] and one.arrow().num_rows == 1
        with pytest.raises(NotImplementedError):
            one.dataframe()
        out.write_pandas(one.pandas())
        with pytest.raises(ValueError):
            out.write_table("/elsewhere")

    assert work.compute(context)["out"].a.tolist() == ["1"]

    @lightweight()
    @transform_pandas(Output("/o"), one=Input("/input1"))
    def plain(one):
        return one

    assert plain.compute(context).a.tolist() == ["1"]
    with pytest.raises(TypeError):
        lightweight(lambda one: one)
    with pytest.raises(ValueError):
        lightweight(transform_df(Output("/o"), one=Input("/input1"))(lambda one: one))
    with pytest.raises(ValueError):
        lightweight(memory_gb=1, memory_mb=1)
    with pytest.raises(NotImplementedError):
        lightweight(container_image="x")
    with pytest.warns(UserWarning, match="resources"):
        lightweight(cpu_cores=2)


def test_polars_needs_its_package(context):
    @transform_polars(Output("/o"), one=Input("/input1"))
    def same(one):
        return one

    try:
        import polars  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="polars"):
            same.compute(context)
    else:
        assert same.compute(context).height == 1


def test_files_without_a_schema(context):
    seen = Input("/binary").init_input(context)
    assert seen.dataframe() is None and not seen.has_schema()

    @transform(out=Output("/o"), raw=Input("/binary"))
    def read(raw, out):
        with raw.filesystem().open("bin", "rb") as f:
            assert f.read() == b"\x00\x01"
        with pytest.raises(FileNotFoundError):
            raw.filesystem().open("none")
        with pytest.raises(PermissionError):
            raw.filesystem().open("bin", "w")
        assert raw.filesystem().files(glob="b*").count() == 1

    read.compute(context)


def test_inputs_fall_back_to_another_branch(spark, shared):
    spec = Input("/input1", branch="feature").init_input(Context(shared))
    assert spec.branch == "master"
    with pytest.raises(errors.BranchNotFoundError):
        Input("/input1", branch="feature").init_input(Context(shared, fallbacks=()))
    shared.create_dataset("/empty")
    with pytest.raises(errors.DatasetHasNoTransactionsError):
        Input("/empty").init_input(Context(shared))


def test_preview_samples_large_inputs_and_builds_do_not(spark):
    store = Store(spark)
    store.create_dataset("/big").save_dataframe(spark.range(1000))

    @transform_df(Output("/o"), big=Input("/big"))
    def same(big):
        return big

    preview = Context(store, preview=True, sample_rows=10)
    with pytest.warns(UserWarning, match="stand for the whole input"):
        assert same.compute(preview).count() == 10
    preview.sample_random = True
    with pytest.warns(UserWarning, match="stand for the whole input"):
        assert same.compute(preview).distinct().count() == 10
    preview.force_full = True
    assert same.compute(preview).count() == 1000
    preview.force_full = False
    same.build(preview)
    assert store.dataset("/o").dataframe().count() == 1000


def test_incremental_modes(spark):
    store = Store(spark)
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int").coalesce(1)
    source = store.create_dataset("/src").save_dataframe(rows(1))
    modes = []

    def declare(**settings):
        @incremental(**settings)
        @transform_df(Output("/dst"), rows=Input("/src"))
        def copy(ctx, rows):
            modes.append(ctx.is_incremental)
            return rows

        return copy

    def result():
        return sorted(r["id"] for r in store.dataset("/dst").dataframe().collect())

    declare().build(Context(store))
    source.save_dataframe(rows(2), "APPEND")
    declare(require_incremental=True).build(Context(store))
    assert result() == [1, 2] and modes == [False, True]
    declare(semantic_version=2).build(Context(store))
    assert result() == [1, 2] and modes[-1] is False
    source.save_dataframe(rows(9), "SNAPSHOT")
    with pytest.raises(errors.TidemarkError, match="incrementally"):
        declare(semantic_version=2, require_incremental=True).build(Context(store))
    declare(semantic_version=2).build(Context(store))
    assert result() == [9] and modes[-1] is False


def test_markings_and_settings(spark, context):
    marks = Markings(["m"], on_branches=["master"])
    orgs = OrgMarkings("o")
    assert (marks.marking_ids, marks.branches, orgs.marking_ids, orgs.branches) == (["m"], ["master"], ["o"], [])

    @configure(spark__sql__shuffle__partitions="3")
    @transform_df(Output("/o"), one=Input("/input1", stop_propagating=marks, stop_requiring=orgs))
    def seen(ctx, one):
        assert ctx.spark_session.conf.get("spark.sql.shuffle.partitions") == "3"
        return one

    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen.compute(context)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert set(transforms.__all__) <= set(dir(transforms))


# -- cache -----------------------------------------------------------------------------------------------------


def key(rid, txn, path, **extra):
    return {"dataset_rid": rid, "last_transaction_rid": txn, "dataset_path": path, **extra}


def test_cache_as_a_mapping(spark):
    cache = VersionCache(spark)
    rows = spark.createDataFrame([(0, 1)], "a int, b int")
    cache[key("d1", "t1", "/d1")] = rows
    assert cache[key("d1", "t1", "/d1")].collect() == rows.collect() and len(cache) == 1
    assert key("d1", "t1", "/d1") in cache and key("d1", "t2", "/d1") not in cache
    assert cache.has_schema(key("d1", "t1", "/d1"))
    assert cache.identity("/d1")["dataset_rid"] == "d1"
    with pytest.raises(KeyError):
        cache.identity("/d2")
    with pytest.raises(KeyError):
        cache[key("d9", "t1", "/d9")]
    with pytest.raises(errors.InvalidCacheKeyError):
        cache[{"dataset_rid": "d1"}]
    del cache[key("d1", "t1", "/d1")]
    assert len(cache) == 0 and list(cache) == []
    with pytest.raises(KeyError):
        del cache[key("d1", "t1", "/d1")]


def test_cache_keeps_two_versions_per_branch(spark):
    cache = VersionCache(spark)
    rows = spark.range(1)
    for txn in ("t1", "t2", "t3"):
        cache[key("d", txn, "/d")] = rows
    cache[key("d", "t1", "/d", branch="dev")] = rows
    held = [txn for txn in ("t1", "t2", "t3") if key("d", txn, "/d") in cache]
    assert held == ["t2", "t3"] and key("d", "t1", "/d", branch="dev") in cache and len(cache) == 2
    with pytest.raises(errors.CacheOutOfSyncError):
        cache[key("d", "t0", "/d")] = rows
    with pytest.raises(KeyError):
        cache.identity("/d")  # on two branches
    assert cache.identity("/d", "dev")["last_transaction_rid"] == "t1"


def test_cached_csv_with_headers(spark, tmp_path):
    cache = VersionCache(spark, str(tmp_path))
    folder = tmp_path / "ds" / "master" / "t1.csv"
    folder.mkdir(parents=True)
    (folder / "1.csv").write_text("given,family\na,b\n")
    (folder / "2.csv").write_text("given,family\nc,d\n")
    fields = [{"name": n, "type": "STRING", "nullable": True, "customMetadata": {}} for n in ("given", "family")]
    doc = {
        "fieldSchemaList": fields,
        "dataFrameReaderClass": "x.TextDataFrameReader",
        "customMetadata": {"textParserParams": {"parser": "CSV_PARSER", "skipLines": 1}},
    }
    cache.register(key("ds", "t1", "/ds"), doc, "csv")
    assert sorted(tuple(r) for r in cache[key("ds", "t1", "/ds")].collect()) == [("a", "b"), ("c", "d")]


def test_frozen_context_reads_the_cache_alone(spark):
    store = Store(spark)
    source = store.create_dataset("/frozen").save_dataframe(spark.range(3))
    cache = VersionCache(spark)

    @transform_df(Output("/o"), rows=Input("/frozen"))
    def same(rows):
        return rows

    assert same.compute(Context(store, cache=cache)).count() == 3
    source.save_dataframe(spark.range(5))
    assert same.compute(Context(store, cache=cache, frozen=True)).count() == 3
    assert same.compute(Context(store, cache=cache)).count() == 5
    assert same.compute(Context(store, cache=cache, frozen=True)).count() == 5


def test_a_key_of_any_size_passes_in_ordered_batches(spark, store, monkeypatch):
    from tidemark.plans import transforms as module

    monkeypatch.setattr(module, "KEY_ROWS", 1000)
    rows = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'k' || id END AS key", "30000 - id AS at")
    store.create_dataset("/hot").save_dataframe(rows)
    options = {"schema": "key string, n long, ordered boolean", "keys": ["key"], "rows": Input("/hot")}

    @transform_pandas(Output("/counted"), batches=True, order_by=["at"], **options)
    def counted(rows, ctx):
        n, last, ordered = 0, -1, not ctx.is_incremental
        for batch in rows:
            ordered = ordered and batch["at"].is_monotonic_increasing and batch["at"].iat[0] > last
            n, last, key = n + len(batch), batch["at"].iat[-1], batch["key"].iat[0]
        yield pd.DataFrame({"key": [key], "n": [n], "ordered": [bool(ordered)]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = counted.compute(Context(store))
        assert got.where("key = 'hot'").collect() == [("hot", 10_000, True)] and got.where("ordered").count() == 20_001

        @transform_pandas(Output("/whole"), **options)
        def whole(rows):
            return pd.DataFrame({"key": rows["key"].head(1), "n": [len(rows)], "ordered": [True]})

        with pytest.raises(Exception, match="batches=True"):
            whole.compute(Context(store)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    with pytest.raises(ValueError, match="one by batches"):
        transform_pandas(Output("/two"), batches=True, schema="key string", keys=["key"], a=Input("/hot"), b=Input("/hot"))(lambda a, b: a).compute(Context(store))


def test_ctx_is_offered_where_tasks_run_the_function(spark, store):
    store.create_dataset("/small").save_dataframe(spark.range(5).selectExpr("id", "id % 2 AS k"))

    @transform_pandas(Output("/batch"), schema="id long, incremental boolean", rows=Input("/small"))
    def batch(rows, ctx):
        return pd.DataFrame({"id": rows["id"], "incremental": ctx.is_incremental})

    @transform_pandas(Output("/pairs"), schema="k long, n long, incremental boolean", keys=["k"], a=Input("/small"), b=Input("/small"))
    def pairs(a, b, ctx):
        return pd.DataFrame({"k": a["k"].head(1), "n": [len(a) * len(b)], "incremental": [ctx.is_incremental]})

    assert {tuple(r) for r in batch.compute(Context(store)).collect()} == {(i, False) for i in range(5)}
    assert {tuple(r) for r in pairs.compute(Context(store)).collect()} == {(0, 9, False), (1, 4, False)}


def test_small_keys_share_batches_and_keep_their_types(spark, store):
    """A key costs no stream of its own: far fewer batches than keys reach Python, and a null changes its own key only."""
    rows = spark.range(400).selectExpr(
        "CASE WHEN id < 4 THEN NULL ELSE id DIV 4 END AS k", "id", "IF(id = 7, NULL, 9007199254740993 + id) AS v", "IF(id = 9, NULL, id % 2 = 0) AS f"
    )
    store.create_dataset("/left").save_dataframe(rows)
    store.create_dataset("/right").save_dataframe(rows.where("id % 4 = 3 AND k % 2 = 0 OR id = 3").withColumnRenamed("v", "w"))
    store.create_dataset("/nested").save_dataframe(rows.selectExpr("k", "id", "struct(v AS v) AS s", "f"))

    @transform_pandas(Output("/one"), schema="k long, n long, v long, whole boolean, f string", keys=["k"], rows=Input("/left"))
    def one(rows):
        assert list(rows.index) == list(range(len(rows)))
        rows["f2"] = rows["f"]
        return pd.DataFrame({"k": rows["k"].head(1), "n": [len(rows)], "v": [rows["v"].max()], "whole": [rows["v"].dtype == int], "f": [str(rows["f2"].dtype)]})

    got = {r.k: tuple(r)[1:] for r in one.compute(Context(store)).collect()}
    assert len(got) == 100 and got[None] == (4, 9007199254740996, True, "bool")
    assert got[1][2:] == (False, "bool") and got[2] == (4, 9007199254741004, True, "object") and got[99] == (4, 9007199254741392, True, "bool")
    plan = one.compute(Context(store))._jdf.queryExecution().toString()
    assert "MapInPandas" in plan and "FlatMapGroupsInPandas" not in plan

    @transform_pandas(Output("/two"), schema="k long, n long, m long, w long", keys=["k"], a=Input("/left"), b=Input("/right"))
    def two(a, b):
        if b.empty:
            return pd.DataFrame({"k": [], "n": [], "m": [], "w": []}) if len(a) == 4 else None
        return pd.DataFrame({"k": a["k"].head(1), "n": [len(a)], "m": [len(b)], "w": [b["w"].iat[0]]})

    both = {r.k: tuple(r)[1:] for r in two.compute(Context(store)).collect()}
    assert len(both) == 50 and both[None] == (4, 1, 9007199254740996) and both[98] == (4, 1, 9007199254740993 + 395)
    assert "FlatMapCoGroupsInPandas" not in two.compute(Context(store))._jdf.queryExecution().toString()

    @transform_pandas(Output("/in"), schema="k long, v long", keys=["k"], a=Input("/nested"), b=Input("/left"))
    def nested(a, b):
        return pd.DataFrame({"k": a["k"].head(1), "v": [max(s["v"] or 0 for s in a["s"])]})

    assert {r.k: r.v for r in nested.compute(Context(store)).where("k = 50").collect()} == {50: 9007199254740993 + 203}
