import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.sources import files as fsio
from tidemark.sources import jdbc, writers


def values(spark, column, *inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", column(F.col("v")).alias("out")).collect())]


def test_decamelize(spark):
    assert values(spark, fn.decamelize, "CamelCase", "aB", "ABC", "", "plain") == ["camel_case", "a_b", "a_b_c", "", "plain"]


def test_parse_iso(spark):
    texts = ("2024-08-12T12:38:21.702342115Z", "2024-08-12T12:38:21+00:00", "2024-08-12T12:38:21.000000+02:00")
    got = values(spark, lambda c: F.unix_micros(fn.parse_iso(c)), *texts)
    base = int(datetime.datetime(2024, 8, 12, 12, 38, 21, tzinfo=datetime.UTC).timestamp()) * 1_000_000
    assert got == [base + 702342, base, base - 7200 * 1_000_000]


def test_is_view(spark):
    records = ('{"view":true}', '{"view":"true"}', '{"view":false}', '{"view":1}', "{}", "no json", None)
    assert values(spark, fn.is_view, *records) == [True] + [False] * 6


def test_rids(spark):
    refs = ("ri.any.main.dataset.1", "ri.any..folder.2", "/a/ri.any.main.dataset.1", "ri.any", None)
    assert values(spark, fn.rid_kind, *refs) == ["dataset", "folder", None, None, None]
    assert values(spark, fn.is_dataset_rid, *refs) == [True, False, False, False, False]


def test_paths(spark):
    assert values(spark, fn.ancestors, "/a/b/c", "/", "/x/") == [["/a", "/a/b", "/a/b/c"], [], ["/x"]]
    assert values(spark, fn.parent, "/a/b", "/a", "x") == ["/a", "/", "x"]
    assert values(spark, fn.basename, "/a/b", "x") == ["b", "x"]
    assert values(spark, fn.is_hidden, "_log/x", "a/.b", "a_b/c.d", "a/_c") == [True, True, False, True]
    assert values(spark, lambda c: fn.under(c, "a"), "a/b", "ab/c", "a") == [True, False, False]
    assert values(spark, lambda c: fn.matches_regex(c, "a|b/"), "a1", "b/2", "b2", "xa") == [True, True, False, False]
    routed = values(spark, lambda c: F.array(*fn.route_key(c)), "ds/a/b.csv", "ds", "ds/")
    assert routed == [["ds", "a/b.csv"], ["ds", ""], ["ds", ""]]


def test_log_lines(spark):
    line = (
        '{"level":"WARN","origin":"a.b","message":"m","time":"2024-08-12T12:38:21Z","unsafeParams":'
        '{"param_1":"x","other":1,"param_0":2,"exception_message":"boom"},"stacktrace":"at \\\\u0041 {exception_message}"}'
    )
    lines = [line, line.replace("WARN", "HUH"), "plain {text", '{"level":"INFO"}']
    df = spark.createDataFrame(list(enumerate(lines)), "i int, v string").coalesce(1)
    structured, unknown, plain, partial = fn.parse_log_lines(df, "v", keep=["i"]).orderBy("i").collect()
    assert (structured.level, structured.origin, structured.message) == ("WARN", "a.b", "m")
    assert structured.args == ["x", "2"] and structured.stacktrace == "at A boom"
    assert unknown.level == "ERROR"
    assert (plain.level, plain.message, plain.args, plain.stacktrace) == ("INFO", "plain {text", [], None)
    assert (partial.level, partial.message) == ("INFO", '{"level":"INFO"}')


def test_lines_already_seen_are_skipped(spark):
    blob = spark.createDataFrame([("j", "a\nb\r\nc")], "job string, logs string")
    rows = fn.explode_lines(blob, "logs", keep=["job"], skip=1).collect()
    assert [(r["line_no"], r["line"]) for r in rows] == [(1, "b"), (2, "c")]


@pytest.mark.parametrize(
    ("glob", "path", "hit"),
    [
        ("**/*.json", "a.json", True),
        ("**/*.json", "x/y/a.json", True),
        ("*.json", "x/a.json", False),
        ("x/?.csv", "x/1.csv", True),
        ("x/?.csv", "x/12.csv", False),
        ("x/**", "x/y/z", True),
        ("a+b", "aab", False),
    ],
)
def test_globs(spark, glob, path, hit):
    assert values(spark, lambda c: c.rlike(fsio.glob_to_regex(glob)), path) == [hit]


@pytest.mark.parametrize(("header", "bom"), [(True, False), (True, True), (False, True), (False, False)])
def test_csv_export(spark, tmp_path, header, bom):
    df = spark.createDataFrame([(1, "x"), (2, "y,z")], "a int, b string").coalesce(1)
    writers.export_csv(df, str(tmp_path / "out"), header=header, bom=bom)
    (part,) = (tmp_path / "out").glob("part-*")
    body = ("a,b\n" if header else "") + '1,x\n2,"y,z"\n'
    assert part.read_text() == ("\ufeff" if bom else "") + body


def test_csv_lines(spark):
    df = spark.createDataFrame([(1, "x;y")], "a int, b string")
    assert [r["line"] for r in writers.csv_lines(df, sep=";").collect()] == ['1;"x;y"']


def test_timestamps_without_zone_become_text(spark):
    df = spark.sql("SELECT 1 AS i, TIMESTAMP_NTZ '2020-01-02 03:04:05.5' AS t")
    assert jdbc.plain_timestamps_as_text(df).collect() == [(1, "2020-01-02T03:04:05.500000")]


def test_external_tables_are_read_in_place(spark, sf_dir):
    jdbc.register_external(spark, "ext_nation", "parquet", f"{sf_dir}/nation.parquet")
    try:
        assert "ext_nation" in jdbc.list_external(spark)
        assert spark.table("ext_nation").count() == 25
    finally:
        spark.sql("DROP TABLE ext_nation")


def test_return_types(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert writers.deliver(df, "pandas").a.tolist() == [1]
    assert writers.deliver(df, "arrow").num_rows == 1
    assert writers.deliver(df, "raw")[1] == [[1, "x"]]
    assert writers.deliver(df, "spark") is df
    with pytest.raises(TypeError):
        writers.deliver(df, "csv")
