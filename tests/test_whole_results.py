"""Cases in which rows, pages, versions or schemas were once lost or mixed up."""

import datetime
import json
import warnings
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import errors
from tidemark.operators import branches, catalog, lineage, stats
from tidemark.plans import sql
from tidemark.plans.cache import VersionCache
from tidemark.plans.store import Store
from tidemark.session import fresh_dir
from tidemark.sources import readers
from tidemark.sources import schema as docs
from tidemark.transforms import Context, Input, Output, configure, incremental, lightweight, transform, transform_df, transform_pandas


@pytest.fixture
def store(spark):
    return Store(spark)


def test_import_keeps_every_file_of_partition_folders(spark, store):
    folder = fresh_dir(spark, "partitioned")
    spark.range(1000).withColumn("p", F.col("id") % 4).repartition(1).write.partitionBy("p").parquet(folder)
    ds = store.create_dataset("/imported").import_files(folder)
    assert ds.files().count() == 4
    assert ds.dataframe().count() == 1000
    assert sorted(r["p"] for r in ds.dataframe().select("p").distinct().collect()) == [0, 1, 2, 3]


def test_local_frames_keep_every_partition(spark, store):
    ds = store.create_dataset("/local")
    frame = pd.DataFrame({"a": range(8), "p": [0, 0, 0, 0, 1, 1, 1, 1]})
    ds.save_dataframe(frame, partition_by=["p"])
    assert sorted(r["a"] for r in ds.dataframe().collect()) == list(range(8))
    ds.save_dataframe(frame.assign(a=frame.a + 10), "UPDATE", partition_by=["p"])
    assert sorted(r["a"] for r in ds.dataframe().collect()) == list(range(10, 18))


def test_schema_of_an_aborted_transaction_has_no_force(spark, store):
    ds = store.create_dataset("/s").save_dataframe(spark.createDataFrame([(1,)], "a int"))
    ds.start_transaction("SNAPSHOT")
    ds.save_dataframe(spark.createDataFrame([("x",)], "b string"), "SNAPSHOT")
    assert store.dataset("/s").dataframe().columns == ["a"]
    ds.abort_transaction()
    assert [tuple(r) for r in ds.dataframe().collect()] == [(1,)]
    assert ds.get_schema()["fieldSchemaList"][0]["name"] == "a"


def test_forks_and_lineage_of_any_depth(spark):
    known = spark.createDataFrame(
        [("d", f"b{i}", f"b{i - 1}" if i else None, 100 - i) for i in range(36)], "rid string, branch string, parent string, fork_seq bigint"
    )
    assert branches.branch_lineage(known).where("branch = 'b35'").count() == 36
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(24)], "child string, parent string")
    seeds = spark.createDataFrame([("n0",)], "node string")
    assert lineage.upstream(edges, seeds).count() == 25


def test_search_gives_everything_found(spark):
    rows = [(f"r{i:05d}", f"n{i % 700:04d}", ["t"]) for i in range(2000)]
    resources = spark.createDataFrame(rows, "rid string, name string, tags array<string>")
    assert catalog.search_resources(resources, page_size=1500).count() == 1500
    assert catalog.search_resources(resources, page_size=None).count() == 2000
    pages = list(catalog.search_pages(resources, query="n", page_size=900))
    assert [len(p) for p in pages] == [900, 900, 200]
    assert [r["rid"] for p in pages for r in p] == [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]


def test_csv_is_judged_by_all_records(spark):
    folder = fresh_dir(spark, "csv")
    lines = ["a,b", *[f"{i},{i}" for i in range(150)]]
    spark.createDataFrame([("\n".join([*lines, "1,2,3"]),)], "value string").coalesce(1).write.text(f"{folder}/late")
    with pytest.warns(UserWarning, match="ambiguous"):
        readers.infer_schema(spark, [f"{folder}/late"], "csv")
    quoted = ["a;b", *['"x\ny, z";1' for _ in range(150)]]
    spark.createDataFrame([("\n".join(quoted),)], "value string").coalesce(1).write.text(f"{folder}/quoted")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        doc = readers.infer_schema(spark, [f"{folder}/quoted"], "csv")
    assert doc["customMetadata"]["textParserParams"]["fieldDelimiter"] == ";"


def test_all_null_texts_hold(spark):
    folder = fresh_dir(spark, "nulls")
    spark.createDataFrame([("a,b",), ("NA,-",), ("x,NA",), ("-,y",)], "value string").coalesce(1).write.text(folder)
    parser = {"nullValues": ["", "NA"], "nullValuesPerColumn": {"a": ["-"]}}
    doc = docs.to_document(spark.createDataFrame([], "a string, b string").schema, "csv", text_parser=parser)
    got = {tuple(r) for r in readers.read_files(spark, [folder], doc).collect()} - {(None, None)}
    assert got == {(None, "-"), ("x", None), (None, "y")}
    with pytest.raises(ValueError, match="one date format"):
        docs.reader_options({"customMetadata": {"textParserParams": {"dateFormat": {"a": ["yyyy", "MM"]}}}})


def test_null_texts_hold_in_columns_of_all_types(spark):
    schema = spark.createDataFrame([], "i int, m decimal(8,2), d date, x bigint, s string").schema
    parser = {"nullValues": ["", "-999", "01/01/1900"], "nullValuesPerColumn": {"x": ["-1"]}, "dateFormat": {"d": ["dd/MM/yyyy"]}}
    lines = ["5;1.25;03/02/2020;-1;a", "-999;-999;01/01/1900;7;-999", ";-1.00;;-999;b", "-1;2.50;31/12/1999;-10;", "oops;3;2020;8;c"]
    date = datetime.date
    want = [
        (5, Decimal("1.25"), date(2020, 2, 3), None, "a"),
        (None, None, None, 7, None),
        (None, Decimal("-1.00"), None, None, "b"),
        (-1, Decimal("2.50"), date(1999, 12, 31), -10, None),
        (None, Decimal("3.00"), None, 8, "c"),
    ]
    for skip in (0, 2):
        folder = fresh_dir(spark, "typed-nulls")
        spark.createDataFrame([("\n".join(["# above"] * skip + lines),)], "value string").coalesce(1).write.text(folder)
        doc = docs.to_document(schema, "csv", text_parser={"fieldDelimiter": ";", "skipLines": skip, **parser})
        frame = readers.read_files(spark, [folder], doc)
        assert [f.dataType for f in frame.schema] == [f.dataType for f in schema]
        assert sorted(map(repr, map(tuple, frame.collect()))) == sorted(map(repr, want))


def test_jagged_rows_are_thrown_or_dropped(spark):
    folder = fresh_dir(spark, "jagged")
    spark.createDataFrame([("a,b",), ("1,2",), ("x,3",), ("4",), ("5,6,7",)], "value string").coalesce(1).write.text(folder)
    schema = spark.createDataFrame([], "a int, b int").schema
    read = lambda how: readers.read_files(spark, [folder], docs.to_document(schema, "csv", text_parser={"jaggedRowBehavior": how}))
    dropped = read("DROP_ROW")
    assert sorted(map(repr, map(tuple, dropped.collect()))) == ["(1, 2)", "(None, 3)"]
    assert dropped.select("a").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        read("THROW_EXCEPTION").collect()
    with pytest.raises(ValueError, match="jaggedRowBehavior"):
        read("IGNORE")


def test_null_texts_leave_partition_folders_alone(spark):
    folder = fresh_dir(spark, "folder-nulls")
    spark.createDataFrame([("v",), ("5",), ("-1",)], "value string").coalesce(1).write.text(f"{folder}/p=-1")
    schema = spark.createDataFrame([], "v int, p int").schema
    doc = docs.to_document(schema, "csv", text_parser={"nullValues": ["", "-1"]})
    got = readers.read_files(spark, [f"{folder}/p=-1"], doc, base_path=folder).select("v", "p").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(["(5, -1)", "(None, -1)"])


def test_all_skipped_lines_are_skipped(spark):
    folder = fresh_dir(spark, "skipped")
    text = "\n".join(["# one", "# two", "a,b", *[f"{i},x{i}" for i in range(50)]])
    spark.createDataFrame([(text,), (text,)], "value string").repartition(2).write.text(folder)
    doc = docs.to_document(spark.createDataFrame([], "a int, b string").schema, "csv", text_parser={"skipLines": 3})
    got = [tuple(r) for r in readers.read_files(spark, [folder], doc).collect()]
    assert sorted(got) == sorted([(i, f"x{i}") for i in range(50)] * 2)


def test_incremental_builds_read_each_row_once(spark, store):
    source = store.create_dataset("/src").save_dataframe(spark.range(10), "SNAPSHOT")

    @incremental()
    @lightweight
    @transform(out=Output("/copied"), src=Input("/src"))
    def copy(out, src):
        out.write_table(src.arrow())

    copy.build(Context(store))
    source.save_dataframe(spark.range(10, 15), "APPEND")
    copy.build(Context(store))
    assert sorted(r[0] for r in store.dataset("/copied").dataframe().collect()) == list(range(15))

    late = store.create_dataset("/late").save_dataframe(spark.range(10), "SNAPSHOT")

    @incremental()
    @transform_df(Output("/out"), src=Input("/late"))
    def busy(src):
        if late.dataframe().count() == 10:
            late.save_dataframe(spark.range(10, 15), "APPEND")  # a commit during the build
        return src

    busy.build(Context(store))
    assert store.dataset("/out").dataframe().count() == 10
    busy.build(Context(store))
    assert sorted(r[0] for r in store.dataset("/out").dataframe().collect()) == list(range(15))


def test_pandas_in_tasks_by_key_and_with_checked_merges(spark, store):
    store.create_dataset("/a").save_dataframe(spark.range(20).selectExpr("id % 4 AS k", "id AS v"))
    store.create_dataset("/b").save_dataframe(spark.range(4).selectExpr("id AS k", "id * 100 AS w"))

    @transform_pandas(Output("/o"), schema="k bigint, total bigint", keys=["k"], a=Input("/a"), b=Input("/b"))
    def total(a, b):
        return pd.DataFrame({"k": [a.k.iat[0]], "total": [a.v.sum() + b.w.sum()]})

    assert {tuple(r) for r in total.compute(Context(store)).collect()} == {(k, sum(range(k, 20, 4)) + 100 * k) for k in range(4)}

    @transform_pandas(Output("/o"), schema="k bigint, v double", merge={"v": "avg"}, a=Input("/a"))
    def mean(a):
        return a.groupby("k", as_index=False).v.mean()

    with pytest.raises(ValueError, match="merge takes"):
        mean.compute(Context(store))

    @transform_pandas(Output("/o"), schema="k bigint, incremental boolean", a=Input("/a"))
    def with_context(ctx, a):
        return pd.DataFrame({"k": a.k, "incremental": ctx.is_incremental})

    assert {tuple(r) for r in with_context.compute(Context(store)).collect()} == {(k, False) for k in range(4)}


def test_settings_hold_until_the_commit(spark, store):
    store.create_dataset("/many").save_dataframe(spark.range(1000))

    @configure(spark__sql__shuffle__partitions="3", spark__sql__adaptive__enabled="false")
    @transform_df(Output("/three"), src=Input("/many"))
    def spread(src):
        return src.repartition(F.col("id"))

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spread.build(Context(store))
    assert store.dataset("/three").files().count() == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_lightweight_keeps_what_it_wraps(store):
    @lightweight
    @incremental(semantic_version=4)
    @configure(a__b="c")
    @transform_pandas(Output("/o"), schema="k bigint", columns=["k"], merge={"k": "sum"}, a=Input("/a"))
    def plain(a):
        return a

    assert plain.options["schema"] == "k bigint" and plain.options["merge"] == {"k": "sum"}
    assert plain.incremental["semantic_version"] == 4 and plain.settings == {"a.b": "c"}


def test_a_version_counts_once_it_is_recorded(spark):
    cache = VersionCache(spark)
    key = {"dataset_rid": "ds1", "dataset_path": "/p", "last_transaction_rid": "t1", "branch": "master"}
    spark.range(3).write.parquet(f"{cache.location(key)}/spark")  # a write that did not end
    assert key not in cache
    cache[key] = spark.range(100)
    assert cache[key].count() == 100
    with pytest.raises(errors.CacheOutOfSyncError):
        cache[{**key, "last_transaction_rid": "t0"}] = spark.range(1)


def test_statistics_cover_every_column(spark):
    df = spark.sql("SELECT 1 AS a, array(1, 2) AS b, CAST('xyz' AS BINARY) AS c, named_struct('x', 1) AS d, map('k', 2) AS e UNION ALL SELECT 2, NULL, NULL, NULL, NULL")
    exact = {r["column"]: r for r in stats.column_stats(df).collect()}
    near = {r["column"]: r for r in stats.column_stats_approx(df).collect()}
    assert set(exact) == set(near) == set("abcde")
    assert all(exact[c]["null_count"] == near[c]["null_count"] == (c != "a") for c in exact)
    assert all(near[c]["unique_count"] == exact[c]["unique_count"] for c in exact)


def test_columns_qualified_by_the_dataset(spark, store):
    store.create_dataset("/in").save_dataframe(spark.range(3))
    store.create_dataset("/other").save_dataframe(spark.range(1, 5))
    run = lambda q: [tuple(r) for r in sql.run_sql(store, q, "spark").collect()]
    assert sorted(run("SELECT `/in`.id FROM `/in` WHERE `/in`.id > 0")) == [(1,), (2,)]
    assert sorted(run("SELECT `/in`.id FROM `/in` JOIN `/other` ON `/in`.id = `/other`.id")) == [(1,), (2,)]
    assert run("SELECT a.id FROM `/in` a, `/other` AS b WHERE a.id = b.id AND b.id = 2") == [(2,)]
    assert json.dumps(sql.references("SELECT 1 FROM `/in`, `/other`"))


def test_ranges_of_clustered_positions_stay_small(spark):
    from tidemark.operators.asof import quantile_bounds, range_number

    df = spark.range(20_000).selectExpr("IF(id = 0, 0, 1000000000 + id) AS at")
    bounds = quantile_bounds(df, "at", 100)
    sizes = [r["count"] for r in df.groupBy(range_number(F.col("at"), bounds).alias("r")).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 2 * 200 + 10
    rows = df.select("at", range_number(F.col("at"), bounds).alias("r")).collect()
    assert all(r["r"] == sum(b <= r["at"] for b in bounds) for r in rows[::997])


@pytest.mark.parametrize("size", [1000, 5000])
def test_large_pages_are_limited_before_the_shuffle(spark, sf_dir, size):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = orders.selectExpr("o_orderstatus AS rid", "o_orderpriority AS branch", "concat('p', o_orderkey) AS path")
    page = catalog.file_page(rows, page_size=size)
    assert "WindowGroupLimit" in page._jdf.queryExecution().executedPlan().toString()
    assert page.count() == rows.count()


def test_pages_above_the_threshold_of_the_session_are_spread(spark, sf_dir):
    from tidemark.operators.transactions import GROUP_LIMIT, top_per_key

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    before, page = spark.conf.get(GROUP_LIMIT), lambda: top_per_key(orders, ["o_orderstatus"], [F.col("o_orderkey").desc()], 300)
    want = sorted(map(tuple, page().select("o_orderkey", "rank").collect()))
    spark.conf.set(GROUP_LIMIT, "100")
    try:
        assert sorted(map(tuple, page().select("o_orderkey", "rank").collect())) == want
        assert spark.conf.get(GROUP_LIMIT) == "100"
    finally:
        spark.conf.set(GROUP_LIMIT, before)


def test_schema_rows_tell_nested_types_apart(spark):
    kinds = ["a struct<x: int, y: map<string, array<bigint>>>", "a struct<x: bigint, y: map<string, array<bigint>>>"]
    texts = [json.dumps(docs.to_document(spark.createDataFrame([], k).schema)) for k in kinds]
    rows = spark.createDataFrame([("d", "b", i, t) for i, t in enumerate([*texts, None, "no document"])], "rid string, branch string, seq long, doc string")
    fields = docs.flatten_documents(rows, "doc", ["rid", "branch", "seq"])
    assert {(r.seq, r.name, r.type) for r in fields.collect()} == {
        (0, "a", "STRUCT<x:INTEGER,y:MAP<STRING,ARRAY<LONG>>>"),
        (1, "a", "STRUCT<x:LONG,y:MAP<STRING,ARRAY<LONG>>>"),
    }
    assert [(r.seq, r.change) for r in docs.schema_changes(fields).collect()] == [(1, "CHANGED")]
