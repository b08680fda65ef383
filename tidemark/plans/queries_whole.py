"""Registered queries on cases where rows could go missing: partition folders, aborts, deep chains, increments, keys."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import branches, catalog, lineage
from tidemark.plans import derived as d
from tidemark.plans import sql
from tidemark.plans.cache import VersionCache
from tidemark.plans.registry import query
from tidemark.plans.store import Store
from tidemark.session import fresh_dir
from tidemark.transforms import Context, Input, Output, configure, incremental, lightweight, transform, transform_df, transform_pandas


@query(
    """SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders GROUP BY o_orderstatus"""
)
def import_partitioned(spark, sf):
    folder = fresh_dir(spark, "orders-by-status")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    d.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), cents.alias("cents")).write.partitionBy("status").parquet(folder)
    rows = Store(spark).create_dataset("/orders").import_files(folder).dataframe()
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


@query("SELECT c_nationkey AS nation, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer GROUP BY c_nationkey")
def pandas_partitioned(spark, sf):
    frame = d.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("nation")).toPandas()
    rows = Store(spark).create_dataset("/customers").save_dataframe(frame, partition_by=["nation"]).dataframe()
    return rows.groupBy(F.col("nation").alias("nation")).agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@query("SELECT CAST(s_suppkey AS BIGINT) AS key FROM supplier")
def schema_after_abort(spark, sf):
    supplier = d.table(spark, sf, "supplier")
    ds = Store(spark).create_dataset("/suppliers").save_dataframe(supplier.select(F.col("s_suppkey").cast("long").alias("key")))
    ds.start_transaction("SNAPSHOT")
    ds.save_dataframe(supplier.select(F.col("s_name").alias("other")), "SNAPSHOT")
    ds.abort_transaction()
    return ds.dataframe()


@query(
    """WITH RECURSIVE chain AS (SELECT DISTINCT CAST(p_partkey % 40 AS BIGINT) AS n FROM part),
    up(branch, source) AS (SELECT n, n FROM chain UNION ALL SELECT branch, source - 1 FROM up WHERE source > 0)
    SELECT branch, count(*) AS sources FROM up GROUP BY branch"""
)
def deep_forks(spark, sf):
    number = d.table(spark, sf, "part").select((F.col("p_partkey") % 40).cast("long").alias("n")).distinct()
    name, parent = F.col("n").cast("string"), F.when(F.col("n") > 0, (F.col("n") - 1).cast("string"))
    known = number.select(F.lit("ds").alias("rid"), name.alias("branch"), parent.alias("parent"), (100 - F.col("n")).alias("fork_seq"))
    return branches.branch_lineage(known).groupBy(F.col("branch").cast("long").alias("branch")).agg(F.count(F.lit(1)).alias("sources"))


@query("SELECT CAST(p_partkey AS BIGINT) AS node FROM part WHERE p_partkey % 30 <= 29 - (p_partkey // 30) % 7 * 3")
def lineage_long_chain(spark, sf):
    """Chains of thirty parts each; what the last part of a chain, or one up to eighteen before it, was built from."""
    key = F.col("p_partkey").cast("long")
    parts = d.table(spark, sf, "part").select(key.alias("child"))
    edges = parts.where("child % 30 > 0").select("child", (F.col("child") - 1).alias("parent"))
    # the last chain may be cut short by the end of the table
    begin = 29 - F.expr("child div 30 % 7") * 3
    starts = parts.where(F.col("child") % 30 <= begin).groupBy(F.expr("child div 30")).agg(F.max("child").alias("node")).select("node")
    return lineage.upstream(edges, starts)


@query("SELECT CAST(c_custkey AS BIGINT) AS rid, c_name AS name FROM customer WHERE contains(lower(c_name), 'customer')")
def search_all_pages(spark, sf):
    customers = d.table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("rid"), F.col("c_name").alias("name"))
    return catalog.search_resources(customers, query="customer", page_size=None)


def _totals(rows):
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("keys"))


@query("SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders")
def incremental_lightweight(spark, sf):
    orders = d.table(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("key"))
    store = Store(spark)
    source = store.create_dataset("/orders").save_dataframe(orders.where("key % 3 = 0"))

    @incremental()
    @lightweight
    @transform(out=Output("/copy"), rows=Input("/orders"))
    def copy(out, rows):
        out.write_table(rows.arrow())

    copy.build(Context(store))
    source.save_dataframe(orders.where("key % 3 > 0"), "APPEND")
    copy.build(Context(store))
    return _totals(store.dataset("/copy").dataframe())


@query("SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders")
def incremental_concurrent_commit(spark, sf):
    orders = d.table(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("key"))
    store = Store(spark)
    source = store.create_dataset("/orders").save_dataframe(orders.where("key % 3 = 0"))
    pending = [orders.where("key % 3 > 0")]

    @incremental()
    @transform_df(Output("/copy"), rows=Input("/orders"))
    def copy(rows):
        if pending:  # rows that arrive while the build runs belong to the next one
            source.save_dataframe(pending.pop(), "APPEND")
        return rows

    copy.build(Context(store))
    copy.build(Context(store))
    return _totals(store.dataset("/copy").dataframe())


@query("SELECT c_custkey AS key, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1")
def sql_qualified(spark, sf):
    store = Store(spark)
    for name in ("customer", "nation"):
        store.create_dataset(f"/{name}").import_files(f"{sf}/{name}.parquet")
    text = """SELECT `/customer`.c_custkey AS key, `/nation`.n_name AS nation FROM `/customer`
    JOIN `/nation` ON `/customer`.c_nationkey = `/nation`.n_nationkey WHERE `/nation`.n_regionkey = 1"""
    return sql.run_sql(store, text, "spark")


@query(
    """SELECT o_custkey AS customer, count(DISTINCT o_orderkey) AS orders, CAST(max(c_nationkey) AS BIGINT) AS nation
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey"""
)
def transform_pandas_keyed(spark, sf):
    store = Store(spark)
    orders = d.table(spark, sf, "orders").select(F.col("o_custkey").alias("customer"), "o_orderkey")
    customers = d.table(spark, sf, "customer").select(F.col("c_custkey").alias("customer"), F.col("c_nationkey").cast("long").alias("nation"))
    store.create_dataset("/orders").save_dataframe(orders)
    store.create_dataset("/customers").save_dataframe(customers)
    key = orders.schema["customer"].dataType.simpleString()

    @transform_pandas(Output("/o"), schema=f"customer {key}, orders bigint, nation bigint", keys=["customer"], a=Input("/orders"), b=Input("/customers"))
    def per_customer(a, b):
        if a.empty or b.empty:
            return pd.DataFrame({"customer": [], "orders": [], "nation": []})
        return pd.DataFrame({"customer": [a.customer.iat[0]], "orders": [a.o_orderkey.nunique()], "nation": [b.nation.max()]})

    return per_customer.compute(Context(store))


@query(
    """WITH o AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS customer, o_orderkey AS key, o_orderdate AS day,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
    r AS (SELECT *, cents - lag(cents) OVER (PARTITION BY customer ORDER BY day, key) AS step FROM o)
    SELECT customer, count(*) AS orders, CAST(sum(cents) AS BIGINT) AS cents, count(*) FILTER (WHERE step > 0) AS rises FROM r GROUP BY customer"""
)
def transform_pandas_batches(spark, sf):
    """Prices that rose from one order of a customer to the next; a third of all orders belong to one customer."""
    store = Store(spark)
    orders = d.table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey")).cast("long").alias("customer"),
        F.col("o_orderkey").alias("key"),
        F.col("o_orderdate").alias("day"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )
    store.create_dataset("/orders").save_dataframe(orders)

    @transform_pandas(
        Output("/rises"), schema="customer bigint, orders bigint, cents bigint, rises bigint", keys=["customer"], batches=True,
        order_by=["day", "key"], rows=Input("/orders"),
    )
    def rises(rows, ctx):
        customer, orders, cents, up, last = None, 0, 0, 0, None
        for batch in rows:
            prices = batch.cents.to_numpy()
            customer, orders, cents = batch.customer.iat[0], orders + len(batch), cents + int(batch.cents.sum())
            up += int(np.count_nonzero(prices[1:] > prices[:-1])) + (last is not None and bool(prices[0] > last))
            last = prices[-1]
        yield pd.DataFrame({"customer": [customer], "orders": [orders], "cents": [cents], "rises": [up * (not ctx.is_incremental)]})

    return rises.compute(Context(store))


@query("SELECT CAST(5 AS BIGINT) AS files, count(*) AS n FROM orders")
def transform_configured(spark, sf):
    store = Store(spark)
    store.create_dataset("/orders").import_files(f"{sf}/orders.parquet")

    @configure(spark__sql__shuffle__partitions="5", spark__sql__adaptive__enabled="false")
    @transform_df(Output("/spread"), rows=Input("/orders"))
    def spread(rows):
        return rows.repartition(F.col("o_orderkey"))

    spread.build(Context(store))
    out = store.dataset("/spread")
    rows = out.dataframe().agg(F.count(F.lit(1)).alias("n"))
    return rows.select(out.files().agg(F.count(F.lit(1))).scalar().alias("files"), "n")


@query("SELECT o_orderkey AS key, o_orderstatus AS status, o_totalprice AS price FROM orders")
def cache_partial_write(spark, sf):
    orders = d.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    dataset = Store(spark).create_dataset("/orders").save_dataframe(orders)
    cache = VersionCache(spark)
    key = {**dataset.identity(), "branch": dataset.branch}
    orders.where("key % 3 = 0").write.parquet(f"{cache.location(key)}/spark")  # a write that was cut short
    return cache.load(dataset)
