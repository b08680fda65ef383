import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import errors
from tidemark.plans.sql import references, run_sql, within
from tidemark.plans.store import Store
from tidemark.sources import files as fsio


def frame(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string").coalesce(1)


def names(df):
    return sorted(r["name"] for r in df.collect())


def test_snapshot_append_and_time_travel(spark, store):
    ds = store.create_dataset("/a/b").save_dataframe(frame(spark, "max"))
    first = ds.last_transaction()
    ds.save_dataframe(frame(spark, "moritz"), "APPEND")
    assert names(ds.dataframe()) == ["max", "moritz"]
    assert names(ds.dataframe(end=first["txn"])) == ["max"]
    second = ds.last_transaction()
    assert (second["type"], second["status"], second["file_count"]) == ("APPEND", "COMMITTED", 1)
    assert names(ds.dataframe(start=second["txn"])) == ["moritz"] and names(ds.lazy()) == ["moritz"]
    assert first["txn"] < second["txn"]
    again = Store(spark, store.root).dataset("/a/b")
    assert again.rid == ds.rid and names(again.dataframe()) == ["max", "moritz"]


def test_transaction_context_states(spark, store):
    ds = store.create_dataset("/ctx")
    with pytest.raises(errors.DatasetHasNoOpenTransactionError):
        ds.transaction
    with pytest.raises(RuntimeError):
        with ds.transaction_context("APPEND"):
            ds.put_file("x.txt", "1")
            raise RuntimeError
    assert ds.last_transaction(include_open=True) is None
    assert [r["status"] for r in store.transactions(ds.rid).collect()] == ["ABORTED"]
    with ds.transaction_context("UPDATE"):
        with pytest.raises(errors.TransactionTypeMismatchError):
            with ds.transaction_context("SNAPSHOT"):
                pass
        with ds.transaction_context("UPDATE"):
            ds.put_file("x.txt", "2")
        assert ds.open_transaction()["type"] == "UPDATE"
        with pytest.raises(errors.DatasetHasOpenTransactionError):
            ds.start_transaction()
    assert ds.open_transaction() is None and ds.last_transaction()["type"] == "UPDATE"
    assert ds.start_transaction().transaction["type"] == "APPEND"
    with pytest.raises(RuntimeError):
        with ds.transaction_context():
            raise RuntimeError
    assert ds.open_transaction() is not None  # the block did not open it, so it does not abort it
    ds.abort_transaction()


def test_files_of_the_open_transaction(spark, store):
    ds = store.create_dataset("/files")
    ds.start_transaction("UPDATE")
    ds.put_file("a.txt", "1").put_file("dir/b.txt", "2").put_file("dir/c.txt", "3")
    with pytest.raises(errors.FileAlreadyExistsError):
        ds.put_file("a.txt", "again")
    ds.put_file("a.txt", "again", overwrite=True)

    def visible(**kwargs):
        return sorted(r["path"] for r in ds.files(**kwargs).collect())

    assert visible() == [] and visible(include_open=True) == ["a.txt", "dir/b.txt", "dir/c.txt"]
    ds.remove_file("nothing").remove_file("dir")
    assert len(visible(include_open=True)) == 3
    ds.remove_file("dir", recursive=True)
    assert visible(include_open=True) == ["a.txt"]
    ds.commit_transaction()
    assert visible() == ["a.txt"]
    ds.delete_files(["a.txt"])
    assert visible() == [] and ds.last_transaction()["type"] == "DELETE"


def test_update_replaces_files_of_the_same_name(spark, store):
    ds = store.create_dataset("/upd").put_file("a", "1", kind="UPDATE").put_file("b", "2", kind="UPDATE")
    ds.put_file("a", "333", kind="UPDATE")
    assert sorted((r["path"], r["length"]) for r in ds.files().collect()) == [("a", 3), ("b", 1)]
    pdf = store.create_dataset("/upd/pandas").save_dataframe(pd.DataFrame({"x": [1, 2]}))
    pdf.save_dataframe(pd.DataFrame({"x": [7]}), "UPDATE")
    assert pdf.to_pandas().x.tolist() == [7]
    pdf.save_dataframe(pd.DataFrame({"x": [8]}), "APPEND")
    assert sorted(pdf.to_pandas().x) == [7, 8]


def test_update_of_a_frame_keeps_other_files(spark, store):
    rows = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    more = spark.createDataFrame([("x", 10)], "k string, v int")
    ds = store.create_dataset("/upd/frame").save_dataframe(rows.coalesce(1), partition_by=["k"])
    ds.save_dataframe(more, "UPDATE", partition_by=["k"])
    values = lambda: sorted((r["k"], r["v"]) for r in ds.dataframe().collect())
    assert values() == [("x", 1), ("x", 10), ("y", 2)]
    ds.save_dataframe(more, "UPDATE", partition_by=["k"], replace_partitions=True)
    assert values() == [("x", 10), ("y", 2)]


def test_partially_replaced_folders_list_single_files(spark, store):
    ds = store.create_dataset("/part").save_dataframe(spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("name")))
    assert len(ds._located()) == 1  # the whole folder
    gone = sorted(r["path"] for r in ds.files().collect())[0]
    ds.delete_files([gone])
    assert len(ds._located()) == 3
    assert ds.dataframe().count() == 75


def test_hidden_files_are_not_data(spark, store):
    ds = store.create_dataset("/hid")
    with ds.transaction_context("SNAPSHOT"):
        ds.save_dataframe(frame(spark, "a"), "SNAPSHOT")
        ds.put_file("_log/run.txt", "text")
    assert names(ds.dataframe()) == ["a"]
    assert [r["path"] for r in ds.files(logical_path="_log").collect()] == ["_log/run.txt"]
    assert ds.files(exclude_hidden=True).count() == 1
    stats = ds.stats().first()
    assert (stats["num_files"], stats["num_hidden_files"], stats["hidden_files_size_in_bytes"]) == (1, 1, 4)


def test_branches(spark, store):
    ds = store.create_dataset("/br").save_dataframe(frame(spark, "base"))
    ds.create_branch("dev", parent="master")
    assert names(ds.dataframe()) == ["base"]
    ds.save_dataframe(frame(spark, "dev"), "APPEND")
    master = store.dataset("/br")
    master.save_dataframe(frame(spark, "later"), "APPEND")
    assert names(ds.dataframe()) == ["base", "dev"] and names(master.dataframe()) == ["base", "later"]
    ds.fast_forward(master.last_transaction()["txn"])
    assert names(ds.dataframe()) == ["base", "dev", "later"]
    ds.save_dataframe(frame(spark, "only"), "SNAPSHOT")
    assert names(ds.dataframe()) == ["only"]
    with pytest.raises(errors.BranchAlreadyExistsError):
        ds.create_branch("dev")
    with pytest.raises(errors.BranchNotFoundError):
        store.dataset("/br", "nope")
    assert store.dataset("/br", "nope", ["master"]).branch == "master"
    root = ds.create_branch("empty")
    assert root.last_transaction() is None
    with pytest.raises(errors.DatasetHasNoTransactionsError):
        root.lazy()
    with pytest.raises(errors.DatasetHasNoSchemaError):
        root.dataframe()


def test_save_dataset_guards(spark, store):
    df = frame(spark, "a")
    rid, txn = store.save_dataset(df, "/guard")
    assert store.dataset(rid).last_transaction()["txn"] == txn
    with pytest.raises(ValueError, match="exists_ok"):
        store.save_dataset(df, "/guard")
    store.save_dataset(frame(spark, "b"), "/guard", exists_ok=True, mode="APPEND")
    assert names(store.dataset("/guard").dataframe()) == ["a", "b"]
    store.save_dataset(df, "/guard", branch="new")
    assert store.dataset("/guard", "new").branch_names() == ["master", "new"]
    with pytest.raises(ValueError):
        store.save_dataset(None, "/guard")
    store.set_trashed("/guard", True)
    with pytest.raises(errors.DatasetInTrashError), pytest.warns(UserWarning, match="trash"):
        store.save_dataset(df, "/guard", exists_ok=True)
    store.set_trashed("/guard", False)
    store.save_dataset(df, "/guard", exists_ok=True)
    with pytest.raises(errors.DatasetNotFoundError):
        store.dataset("/nowhere")
    with pytest.raises(errors.DatasetAlreadyExistsError):
        store.create_dataset("/guard")


def test_a_failed_write_leaves_the_version_before(spark, store):
    ds = store.create_dataset("/fail").save_dataframe(frame(spark, "ok"))
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("string").alias("name"))
    with pytest.raises(Exception, match="no"):
        ds.save_dataframe(broken, "SNAPSHOT")
    assert names(ds.dataframe()) == ["ok"] and ds.open_transaction() is None


def test_pages(spark, store):
    ds = store.create_dataset("/pages")
    with ds.transaction_context("APPEND"):
        for i in range(5):
            ds.put_file(f"f{i}", "x")
    page, token = ds.file_page(2)
    assert [r["path"] for r in page] == ["f0", "f1"] and token == "f2"
    assert [r["path"] for r in ds.list_files(page_size=2)] == [f"f{i}" for i in range(5)]
    assert len(ds.get_transactions(10)) == 1


def test_copy_in_and_out(spark, store, tmp_path):
    source = tmp_path / "in"
    (source / "sub").mkdir(parents=True)
    (source / "a.csv").write_text("col1,col2\n1,2\n")
    (source / "sub" / "b.csv").write_text("col1,col2\n3,4\n")
    ds = store.create_dataset("/copy").upload_folder(str(source))
    assert ds.last_transaction()["type"] == "UPDATE"
    out = tmp_path / "out"
    assert len(ds.download_files(str(out))) == 2
    assert (out / "sub" / "b.csv").read_text() == "col1,col2\n3,4\n"
    assert len(ds.download_files(str(tmp_path / "one"), ["a.csv"])) == 1
    with ds.download_files_temporary(["sub/b.csv"]) as folder:
        assert fsio.read_bytes(f"{folder}/sub/b.csv") == b"col1,col2\n3,4\n"
    assert not fsio.exists(folder)
    with pytest.raises(errors.DatasetHasNoFilesError):
        ds.download_files(str(out), ["none"])
    doc = ds.infer_schema()
    ds.put_schema(doc, ds.last_transaction()["seq"])
    assert [f["type"] for f in doc["fieldSchemaList"]] == ["INTEGER", "INTEGER"]
    assert sorted(tuple(r) for r in ds.dataframe().collect()) == [(1, 2), (3, 4)]
    assert {bytes(r["content"]) for r in ds.binary().select("content").collect()} == {b"col1,col2\n1,2\n", b"col1,col2\n3,4\n"}


def test_import_reads_files_where_they_lie(spark, store, sf_dir):
    ds = store.create_dataset("/imported").import_files(f"{sf_dir}/nation.parquet")
    assert [r["physical"] for r in ds.files().collect()] == [f"file:{sf_dir}/nation.parquet"]
    plan = ds.dataframe().where("n_regionkey = 1").select("n_name")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(n_regionkey,1)" in plan and "ReadSchema: struct<n_name:string,n_regionkey:int>" in plan


def test_one_scan_covers_all_transactions_of_a_layout(spark, store):
    rows = spark.createDataFrame([("a/b c%d", 1), ("y", 2)], "k string, v int")
    ds = store.create_dataset("/layout").save_dataframe(rows, partition_by=["k"])
    ds.save_dataframe(rows, "APPEND", partition_by=["k"]).save_dataframe(rows, "APPEND", partition_by=["k"])
    plan = ds.dataframe()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan
    assert sorted(tuple(r) for r in ds.dataframe().groupBy("k").sum("v").collect()) == [("a/b c%d", 3), ("y", 6)]
    gone = ds.files().where("path LIKE 'spark/%' AND path LIKE '%k=y%'")
    ds.delete_files(gone)
    assert sorted(tuple(r) for r in ds.dataframe().groupBy("k").sum("v").collect()) == [("a/b c%d", 3), ("y", 4)]
    ds.save_dataframe(rows.select("v", "k"), "APPEND")  # not partitioned
    assert ds.dataframe().count() == 7


def test_partition_filter_prunes_folders(spark, store):
    rows = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    ds = store.create_dataset("/prune").save_dataframe(rows, partition_by=["k"])
    plan = ds.dataframe().where("k = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


def test_memo_notices_new_transactions(spark, store):
    ds, other = store.create_dataset("/memo").save_dataframe(frame(spark, "a")), Store(spark, store.root)
    assert names(ds.dataframe()) == ["a"]
    other.dataset("/memo").save_dataframe(frame(spark, "b"), "SNAPSHOT")
    assert names(ds.dataframe()) == ["b"]


# -- SQL -------------------------------------------------------------------------------------------------------


def test_references_skip_text_and_comments():
    text = "SELECT 'from `x`', `c` FROM `/a/b` t, `1:2@m`.`/c` -- join `n`\n JOIN `/d` ON 1 = 1 /* from `e` */"
    assert references(text) == ["`/a/b`", "`1:2@m`.`/c`", "`/d`"]


def test_sql_forms(spark, store):
    ds = store.create_dataset("/sql/it").save_dataframe(frame(spark, "a", "b"))
    ds.create_branch("dev").save_dataframe(frame(spark, "c"))
    assert run_sql(store, "SELECT name FROM `/sql/it` ORDER BY name").name.tolist() == ["a", "b"]
    assert run_sql(store, "SELECT name FROM `dev`.`/sql/it`", "arrow").num_rows == 1
    assert run_sql(store, "SELECT name FROM `/sql/it`", "spark", branch="dev").count() == 1
    doc, rows = run_sql(store, f"SELECT name FROM `{ds.rid}` WHERE name = 'b'", "raw")
    assert rows == [["b"]] and doc["fieldSchemaList"][0]["type"] == "STRING"
    assert ds.query("SELECT *", "spark").count() == 1
    assert ds.query("SELECT count(*) AS n WHERE name = 'zzz'").n.tolist() == [0]
    assert run_sql(store, "SELECT name FROM `/sql/it`", "spark", branch="x", fallbacks=["dev"]).count() == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ref_")]


def test_sql_failures(spark, store):
    store.create_dataset("/sql/f").save_dataframe(frame(spark, "a"))
    with pytest.raises(errors.QueryFailedError):
        run_sql(store, "SELEC name FROM `/sql/f`")
    with pytest.raises(errors.QueryFailedError):
        run_sql(store, "SELECT nope FROM `/sql/f`")
    with pytest.raises(errors.DatasetNotFoundError):
        run_sql(store, "SELECT name FROM `/sql/none`")
    with pytest.raises(errors.BranchNotFoundError):
        run_sql(store, "SELECT name FROM `/sql/f`", branch="none")
    with pytest.raises(TypeError):
        run_sql(store, "SELECT 1", sql_dialect="T")
    with pytest.raises(TypeError):
        run_sql(store, "SELECT 1", "list")
    before = spark.conf.get("spark.sql.ansi.enabled")
    assert run_sql(store, "SELECT CAST(name AS INT) AS n FROM `/sql/f`", "raw")[1] == [[None]]
    with pytest.raises(errors.QueryFailedError):
        run_sql(store, "SELECT CAST(name AS INT) AS n FROM `/sql/f`", "raw", sql_dialect="ANSI")
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_slow_query_is_cancelled(spark):
    slow = spark.range(8, numPartitions=8).select(F.udf(lambda i: __import__("time").sleep(30) or i, "bigint")("id"))
    with pytest.raises(errors.QueryTimeoutError):
        within(spark, 2, slow.collect)


def test_long_logs_are_asked_instead_of_kept(spark, store, monkeypatch):
    from tidemark.plans import store as module

    ds = store.create_dataset("/long").save_dataframe(frame(spark, "a"))
    first = ds.last_transaction()
    for name in ("b", "c"):
        ds.save_dataframe(frame(spark, name), "APPEND")
    ds.create_branch("idle")
    monkeypatch.setattr(module, "RECENT", 1)
    store._memo.clear()
    assert names(ds.switch_branch("master").dataframe()) == ["a", "b", "c"]
    assert names(ds.dataframe(end=first["txn"])) == ["a"]
    assert ds.transaction_row(first["txn"])["seq"] == first["seq"]
    assert ds.open_transaction() is None
    assert ds.switch_branch("idle").last_transaction() is None


def test_provenance_is_json(spark, store):
    ds = store.create_dataset("/prov")
    ds.start_transaction("SNAPSHOT").commit_transaction(provenance={"provenanceRecords": []})
    assert json.loads(ds.last_transaction()["provenance"]) == {"provenanceRecords": []}


def test_a_commit_adds_few_log_files(spark, store):
    ds = store.create_dataset("/few").save_dataframe(frame(spark, "a"))
    folder = f"{store.log_path('transactions')}/rid={ds.rid}"
    before, _ = fsio.fingerprint(folder)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("log", "rows from the driver")
    with ds.transaction_context("APPEND"):
        ds._log_transaction("OPEN")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert fsio.fingerprint(folder)[0] == before + 3  # opened, once more, committed
    assert all(not name.startswith("_") for name in (p.split("/")[-1] for p in store.log("transactions", ds.rid).inputFiles()))
    row = ds.last_transaction()
    assert row["type"] == "APPEND" and row["status"] == "COMMITTED" and row["at"].year >= 2024
    assert len(jobs.getJobIdsForGroup("log")) < 10
