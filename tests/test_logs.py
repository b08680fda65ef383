import threading
from datetime import UTC, datetime, timedelta

import pytest

from tidemark import errors
from tidemark.plans.store import Store
from tidemark.plans.vacuum import vacuum, vacuum_candidates
from tidemark.session import fresh_dir
from tidemark.sources import files as fsio
from tidemark.streaming import stream_rows


def frame(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string").coalesce(1)


def names(df):
    return sorted(r["name"] for r in df.collect())


def test_a_checkpointed_log_answers_as_before(spark):
    store = Store(spark, checkpoint_every=4)
    ds = store.create_dataset("/long")
    seen = []
    for i in range(14):
        ds.save_dataframe(frame(spark, f"n{i:02d}"), "APPEND")
        seen.append(ds.last_transaction()["txn"])
        assert len(store.logs.state("transactions", ds.rid)) <= 8
    everything = [f"n{i:02d}" for i in range(14)]
    again = Store(spark, store.root).dataset("/long")
    for one in (ds, again):
        assert names(one.dataframe()) == everything
        assert names(one.dataframe(end=seen[4])) == everything[:5]
        assert names(one.dataframe(start=seen[12])) == everything[12:]
        assert [t["txn"] for t in one.get_transactions(20)] == seen[::-1]
        assert one.files().count() == 14 and len(list(one.list_files(page_size=5))) == 14
    merged = fsio.names(store.logs.segments("files", ds.rid))
    assert 1 <= len(merged) <= 10
    again.delete_files(again.files().where("path LIKE '%'").limit(3))
    assert len(names(ds.dataframe())) == 11
    assert store.transactions().count() == 15 and store.identities().count() == 1


def test_many_segments_become_one(spark, monkeypatch):
    from tidemark.plans import logs

    monkeypatch.setattr(logs, "SEGMENTS", 2)
    store = Store(spark, checkpoint_every=2)
    ds = store.create_dataset("/many")
    for i in range(6):
        ds.save_dataframe(frame(spark, str(i)), "APPEND")
    assert names(ds.dataframe()) == list("012345")
    assert len(store.logs._checkpoint("files", ds.rid)["segments"]) <= 2


def test_a_slot_is_taken_once(spark, store):
    ds = store.create_dataset("/slots")
    won = []

    def take(i):
        if store.logs.claim(ds.rid, 1, {"txn": str(i)}):
            won.append(i)

    threads = [threading.Thread(target=take, args=(i,)) for i in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and store.logs.slots(ds.rid, 1, 1) == [{"txn": str(won[0])}]
    assert store.logs.last_slot(ds.rid) == 1


def test_appends_rebase_and_conflicting_updates_are_refused(spark, store):
    base = store.create_dataset("/shared").save_dataframe(frame(spark, "a"), "SNAPSHOT")
    one, two = store.dataset("/shared"), Store(spark, store.root).dataset("/shared")
    one.start_transaction("APPEND", concurrent=True)
    two.start_transaction("APPEND", concurrent=True)
    one.save_dataframe(frame(spark, "b"), "APPEND")
    two.save_dataframe(frame(spark, "c"), "APPEND")
    two.commit_transaction()
    assert names(base.dataframe()) == ["a", "c"]
    one.commit_transaction()
    assert names(base.dataframe()) == ["a", "b", "c"]
    rows = base.get_transactions(10)
    assert [r["status"] for r in rows] == ["COMMITTED"] * 3 and rows[0]["txn"] != rows[1]["txn"]

    # both replace the same file
    one.start_transaction("UPDATE", concurrent=True)
    two.start_transaction("UPDATE", concurrent=True)
    for writer, text in ((one, "1"), (two, "2")):
        writer.put_file("notes/x.txt", text)
    one.commit_transaction()
    with pytest.raises(errors.CommitConflictError):
        two.commit_transaction()
    two.start_transaction("UPDATE", concurrent=True)  # it can start anew
    two.put_file("notes/y.txt", "2").commit_transaction()
    assert sorted(r["path"] for r in base.files(logical_path="notes").collect()) == ["notes/x.txt", "notes/y.txt"]

    # a delete decided on before a new snapshot
    one.start_transaction("DELETE", concurrent=True)
    one.stage_tombstones(base.files().select("path"))
    base.save_dataframe(frame(spark, "z"), "SNAPSHOT")
    with pytest.raises(errors.CommitConflictError):
        one.commit_transaction()
    assert names(base.dataframe()) == ["z"]


def test_one_exclusive_transaction_a_branch_still_holds(spark, store):
    ds = store.create_dataset("/one")
    ds.start_transaction("APPEND")
    with pytest.raises(errors.DatasetHasOpenTransactionError):
        store.dataset("/one").start_transaction("APPEND")
    store.dataset("/one").save_dataframe(frame(spark, "joined"), "APPEND")
    side = store.dataset("/one").start_transaction("APPEND", concurrent=True)
    side.save_dataframe(frame(spark, "side"), "APPEND", concurrent=True).commit_transaction()
    ds.commit_transaction()
    assert names(ds.dataframe()) == ["joined", "side"]


def test_a_stream_goes_on_after_its_entries_were_merged(spark):
    store = Store(spark, checkpoint_every=2)
    ds = store.create_dataset("/streamed").save_dataframe(frame(spark, "a", "b"))
    out, checkpoint = fresh_dir(spark, "out"), fresh_dir(spark, "cp")

    def run():
        sink = stream_rows(ds).writeStream.option("checkpointLocation", checkpoint).format("parquet").option("path", out)
        sink.trigger(availableNow=True).start().awaitTermination()
        return names(spark.read.parquet(out))

    assert run() == ["a", "b"]
    for i in range(6):  # the manifest entries of the first of these are gone by the end
        ds.save_dataframe(frame(spark, f"c{i}"), "APPEND")
    ds.start_transaction("APPEND")
    ds.save_dataframe(frame(spark, "never"), "APPEND").abort_transaction()
    assert run() == ["a", "b", *(f"c{i}" for i in range(6))]
    assert run() == ["a", "b", *(f"c{i}" for i in range(6))]


def test_streamed_rows_have_the_types_and_folders_of_the_dataset(spark, store):
    rows = spark.sql("SELECT 1.50BD AS m, TIMESTAMP_NTZ '2024-01-02 03:04:05' AS t, array(1, 2) AS l, 'x y' AS k, DATE '2024-01-01' AS d, 7 AS p")
    ds = store.create_dataset("/typed").save_dataframe(rows, partition_by=["k", "p"])
    table = stream_rows(ds).writeStream.format("memory").queryName("typed_rows").trigger(availableNow=True).start()
    table.awaitTermination()
    got = spark.table("typed_rows")
    assert got.collect() == ds.dataframe().collect() and got.dtypes == ds.dataframe().dtypes


def test_vacuum_takes_what_no_commit_shows(spark, store):
    ds = store.create_dataset("/v").save_dataframe(frame(spark, "kept"), "SNAPSHOT")
    ds.start_transaction("APPEND")
    ds.save_dataframe(frame(spark, "gone"), "APPEND").abort_transaction()
    ds.start_transaction("APPEND")
    ds.save_dataframe(frame(spark, "pending"), "APPEND")
    later = datetime.now(UTC) + timedelta(hours=30)
    assert vacuum_candidates(store).count() == 0  # within the time of grace
    assert vacuum_candidates(store, now=later).count() == 1
    assert vacuum(store, now=later) == 1 and vacuum(store, now=later) == 0
    ds.commit_transaction()
    assert names(ds.dataframe()) == ["kept", "pending"]
