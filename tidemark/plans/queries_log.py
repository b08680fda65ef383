"""Queries on the log of a store: checkpoints, writers side by side, what can be cleaned up."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from tidemark import errors
from tidemark.plans import derived as d
from tidemark.plans.registry import query
from tidemark.plans.store import Store
from tidemark.plans.vacuum import vacuum, vacuum_candidates

COUNTED = "count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys"


def _orders(spark, sf):
    return d.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")


def _counted(rows):
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query(f"SELECT o_orderstatus, {COUNTED}, true AS merged FROM orders GROUP BY o_orderstatus")
def log_checkpointed(spark, sf):
    """Nine appends under a log that is merged every three: the same rows, and few entries to read."""
    store, orders, key = Store(spark, checkpoint_every=6), _orders(spark, sf), F.col("o_orderkey")
    ds = store.create_dataset("/orders")
    for part in range(9):
        ds.save_dataframe(orders.where(key % 9 == part).coalesce(1), "APPEND")
    entries = {t: len(store.logs.state(t, ds.rid)) for t in ("transactions", "files", "schemas")}
    return _counted(ds.dataframe()).withColumn("merged", F.lit(entries["transactions"] <= 12 and entries["files"] <= 6 and entries["schemas"] <= 6))


@query(f"""SELECT o_orderstatus, {COUNTED}, 1 AS refused FROM
(SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT -o_orderkey, 'new' FROM orders WHERE o_orderkey % 5 < 2) x GROUP BY o_orderstatus""")
def concurrent_appends(spark, sf):
    """Two appends that run side by side are both kept; of two updates of a partition that do, the second is refused."""
    store, orders, key = Store(spark), _orders(spark, sf), F.col("o_orderkey")
    store.create_dataset("/orders").save_dataframe(orders, "SNAPSHOT", partition_by=["o_orderstatus"])
    writers = [store.dataset("/orders") for _ in range(4)]
    for writer, kind in zip(writers, ("APPEND", "APPEND", "UPDATE", "UPDATE"), strict=True):
        writer.start_transaction(kind, concurrent=True)
    for part, writer in enumerate(writers[:2]):
        fresh = orders.where(key % 5 == part).select((-key).alias("o_orderkey"), F.lit("new").alias("o_orderstatus"))
        writer.save_dataframe(fresh, "APPEND", partition_by=["o_orderstatus"])
    for writer in writers[2:]:
        writer.save_dataframe(orders.where("o_orderstatus = 'F'"), "UPDATE", partition_by=["o_orderstatus"], replace_partitions=True)
    refused = 0
    for writer in reversed(writers):
        try:
            writer.commit_transaction()
        except errors.CommitConflictError:
            refused += 1
    return _counted(store.dataset("/orders").dataframe()).withColumn("refused", F.lit(refused))


@query(f"SELECT o_orderstatus, {COUNTED}, count(*) = 0 AS found_later FROM orders WHERE o_orderstatus = 'P' GROUP BY o_orderstatus")
def vacuum_candidates_found(spark, sf):
    """The rows of an aborted transaction, read from the files that a vacuum would delete; afterwards there are none."""
    store, orders = Store(spark), _orders(spark, sf)
    ds = store.create_dataset("/orders").save_dataframe(orders.where("o_orderstatus <> 'P'"), "SNAPSHOT")
    ds.start_transaction("APPEND")
    ds.save_dataframe(orders.where("o_orderstatus = 'P'"), "APPEND").abort_transaction()
    soon = datetime.now(UTC) + timedelta(days=2)
    names = [r["physical"] for r in vacuum_candidates(store, now=soon).select("physical").collect()]
    rows = _counted(spark.read.schema(orders.schema).parquet(*names)).collect()
    vacuum(store, now=soon)
    left = vacuum_candidates(store, now=soon).count()
    assert ds.dataframe().count() == orders.where("o_orderstatus <> 'P'").count()
    return spark.createDataFrame([(*r, left > 0) for r in rows], "o_orderstatus string, n bigint, keys bigint, found_later boolean")
