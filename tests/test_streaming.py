import json

from tidemark.session import fresh_dir
from tidemark.streaming import new_rows, route_objects, tail_log


def frame(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string").coalesce(1)


def test_only_committed_transactions_are_seen_and_each_once(spark, store):
    source = store.create_dataset("/s").save_dataframe(frame(spark, "a"))
    checkpoint, batches = fresh_dir(spark, "cp"), []
    sink = lambda df, n: batches.append(sorted(r["name"] for r in df.collect()))
    new_rows(source, sink, checkpoint)
    source.start_transaction("APPEND")
    source.save_dataframe(frame(spark, "open"), "APPEND")
    new_rows(source, sink, checkpoint)
    assert batches == [["a"]]
    source.commit_transaction()
    new_rows(source, sink, checkpoint)
    new_rows(source, sink, checkpoint)
    assert batches == [["a"], ["open"]]


def test_partition_columns_are_kept(spark, store):
    rows = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    source, seen = store.create_dataset("/p").save_dataframe(rows, partition_by=["k"]), []
    new_rows(source, lambda df, n: seen.extend((r["k"], r["v"]) for r in df.collect()), fresh_dir(spark, "cp"))
    assert sorted(seen) == [("x", 1), ("y", 2)]


def test_failed_batch_is_repeated(spark, store):
    source = store.create_dataset("/r").save_dataframe(frame(spark, "a", "b"))
    checkpoint, seen = fresh_dir(spark, "cp"), []

    def failing(df, number):
        raise RuntimeError("sink is down")

    try:
        new_rows(source, failing, checkpoint)
    except Exception as exc:
        assert "sink is down" in str(exc)
    new_rows(source, lambda df, n: seen.extend(r["name"] for r in df.collect()), checkpoint)
    assert sorted(seen) == ["a", "b"]


def test_tail_continues_where_it_stopped(spark, tmp_path):
    out, checkpoint = fresh_dir(spark, "out"), fresh_dir(spark, "cp")
    (tmp_path / "1.log").write_text("one\ntwo\n")
    tail_log(spark, str(tmp_path), out, checkpoint)
    (tmp_path / "2.log").write_text("three\n")
    tail_log(spark, str(tmp_path), out, checkpoint)
    tail_log(spark, str(tmp_path), out, checkpoint)
    assert sorted(r["message"] for r in spark.read.parquet(out).collect()) == ["one", "three", "two"]


def test_late_and_repeated_events_are_routed_once(spark, tmp_path):
    out, checkpoint = fresh_dir(spark, "out"), fresh_dir(spark, "cp")

    def event(key, time):
        return {"eventTime": time, "s3": {"object": {"key": key, "size": 1}}}

    first = {"Records": [event("ds1/a%2Fb.csv", "2024-01-02T00:00:00Z"), event("ds1/x", "2024-01-02T00:00:00Z")]}
    (tmp_path / "1.json").write_text(json.dumps(first))
    route_objects(spark, str(tmp_path), out, checkpoint)
    late = {"Records": [event("ds1/x", "2024-01-02T00:00:00Z"), event("ds2/old", "2020-01-01T00:00:00Z")]}
    (tmp_path / "2.json").write_text(json.dumps(late))
    route_objects(spark, str(tmp_path), out, checkpoint)
    rows = sorted((r["dataset"], r["path"]) for r in spark.read.parquet(out).collect())
    assert rows == [("ds1", "a/b.csv"), ("ds1", "x"), ("ds2", "old")]
