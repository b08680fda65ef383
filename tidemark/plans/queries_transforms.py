"""Queries through decorated transforms, and the streaming jobs."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tidemark.plans import derived as d
from tidemark.plans.queries_functions import PARSED_LINES, flat_lines, log_lines
from tidemark.plans.registry import query
from tidemark.plans.store import Store
from tidemark.plans.transforms import (
    Context,
    Input,
    Output,
    incremental,
    lightweight,
    transform,
    transform_df,
    transform_pandas,
)
from tidemark.session import fresh_dir
from tidemark.streaming import route_objects, stream_rows, tail_log


def _context(spark, sf, *tables: str) -> Context:
    for name in tables:
        d.dataset(spark, sf, name)
    return Context(d.warehouse(spark, sf))


def _cents(column: str):
    return F.floor(F.col(column) * 100).cast("bigint")


@transform_df(Output("/out/pricing"), lines=Input("/tpch/lineitem"))
def pricing(lines):
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").cast("bigint").alias("quantity"),
        F.sum(_cents("l_extendedprice")).alias("cents"),
    )


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity,
  CAST(sum(CAST(floor(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def transform_df_agg(spark, sf):
    """Built, committed as a dataset, and read back from there."""
    context = _context(spark, sf, "lineitem")
    pricing.build(context)
    return context.store.dataset("/out/pricing").dataframe()


@transform_df(Output("/out/joined"), orders=Input("/tpch/orders"), customers=Input("/tpch/customer"))
def joined(orders, customers):
    customers = customers.withColumnRenamed("c_custkey", "o_custkey")
    return orders.join(customers, "o_custkey", how="inner").select("o_orderkey", "o_custkey", "c_name", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def transform_join(spark, sf):
    return joined.compute(_context(spark, sf, "orders", "customer"))


@transform_df(Output("/out/union"), first=Input("/tpch/customer"), second=Input("/tpch/supplier"))
def stacked(first, second):
    return first.select("c_custkey", "c_nationkey").union(second.select("s_suppkey", "s_nationkey"))


@query("SELECT c_custkey, c_nationkey FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier")
def transform_union(spark, sf):
    return stacked.compute(_context(spark, sf, "customer", "supplier"))


@transform_df(Output("/out/union_by_name"), first=Input("/tpch/customer"), second=Input("/tpch/supplier"))
def stacked_by_name(first, second):
    one = first.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    return one.unionByName(second.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("SELECT c_name AS name, c_custkey AS id FROM customer UNION ALL SELECT s_name, s_suppkey FROM supplier")
def transform_union_by_name(spark, sf):
    return stacked_by_name.compute(_context(spark, sf, "customer", "supplier"))


@transform(out_a=Output("/out/a"), out_b=Output("/out/b"), orders=Input("/tpch/orders"))
def split_orders(orders, out_a, out_b):
    frame = orders.dataframe()
    out_a.write_dataframe(frame.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))
    out_b.write_dataframe(frame.groupBy("o_orderpriority").agg(F.sum(_cents("o_totalprice")).alias("cents")))


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def transform_multi_out_a(spark, sf):
    return split_orders.compute(_context(spark, sf, "orders"))["out_a"]


@query("SELECT o_orderpriority, CAST(sum(CAST(floor(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY o_orderpriority")
def transform_multi_out_b(spark, sf):
    return split_orders.compute(_context(spark, sf, "orders"))["out_b"]


@transform_pandas(
    Output("/out/by_supplier"),
    schema="l_suppkey bigint, n bigint, quantity bigint, biggest double",
    columns=["l_suppkey", "l_quantity", "l_extendedprice"],
    merge={"n": "sum", "quantity": "sum", "biggest": "max"},
    lines=Input("/tpch/lineitem"),
)
def by_supplier(lines: pd.DataFrame) -> pd.DataFrame:
    grouped = lines.groupby("l_suppkey")
    out = grouped.agg(n=("l_quantity", "size"), quantity=("l_quantity", "sum"), biggest=("l_extendedprice", "max"))
    return out.astype({"quantity": "int64"}).reset_index()


@query("""SELECT l_suppkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity, max(l_extendedprice) AS biggest
FROM lineitem GROUP BY l_suppkey""")
def transform_pandas_grouped(spark, sf):
    """pandas per batch, merged per key by Spark."""
    return by_supplier.compute(_context(spark, sf, "lineitem"))


@lightweight
@transform(out=Output("/out/revenue"), lines=Input("/tpch/lineitem"))
def revenue(lines, out):
    def per_batch(batches):
        for batch in batches:
            amount = pc.multiply(batch["l_extendedprice"], pc.subtract(pa.scalar(1.0), batch["l_discount"]))
            cents = pc.cast(pc.floor(pc.multiply(amount, pa.scalar(100.0))), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["l_orderkey"], batch["l_linenumber"], cents], ["l_orderkey", "l_linenumber", "cents"]
            )

    out.write_table(lines.batches(per_batch, "l_orderkey bigint, l_linenumber int, cents bigint"))


@query("""SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice * (1.0::DOUBLE - l_discount) * 100.0::DOUBLE) AS BIGINT) AS cents
FROM lineitem""")
def transform_arrow_map(spark, sf):
    return revenue.compute(_context(spark, sf, "lineitem"))["out"]


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus")
def incremental_added(spark, sf):
    """The second build of an incremental transform reads, and appends, only what came after the first."""
    orders = d.table(spark, sf, "orders")
    store = Store(spark)
    source = store.create_dataset("/in/orders")
    source.save_dataframe(orders.where("o_orderstatus = 'F'"), "SNAPSHOT")

    @incremental()
    @transform_df(Output("/out/copy"), rows=Input("/in/orders"))
    def copy(rows):
        return rows.select("o_orderkey", "o_orderstatus")

    copy.build(Context(store))
    source.save_dataframe(orders.where("o_orderstatus <> 'F'"), "APPEND")
    added = copy.build(Context(store))["output"]
    rows = store.dataset("/out/copy").dataframe(start=added, end=added)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_type, CASE WHEN event_type IN ('click', 'error') THEN 0 ELSE 1 END AS run, count(*) AS n,
  CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type""")
def stream_incremental_rows(spark, sf):
    """Two runs of a stream over a dataset: each takes only the transactions committed since the last."""
    events = d.table(spark, sf, "events")
    first = F.col("event_type").isin("click", "error")
    source = Store(spark).create_dataset("/in/events").save_dataframe(events.where(first), "SNAPSHOT")
    target, checkpoint = fresh_dir(spark, "rows"), fresh_dir(spark, "offsets")

    def run(number: int) -> None:
        rows = stream_rows(source).withColumn("run", F.lit(number)).writeStream.option("checkpointLocation", checkpoint)
        rows.format("parquet").option("path", target).partitionBy("run").trigger(availableNow=True).start().awaitTermination()

    run(0)
    source.save_dataframe(events.where(~first), "APPEND")
    run(1)
    return spark.read.parquet(target).groupBy("event_type", "run").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query(PARSED_LINES.replace("SELECT event_id,", "SELECT", 1))
def stream_log_tail(spark, sf):
    """Log files that arrive in two goes, tailed after each."""
    events = d.table(spark, sf, "events")
    source, target, checkpoint = (fresh_dir(spark, n) for n in ("log", "lines", "offsets"))
    for part in (0, 1):
        lines = events.where(F.col("event_id") % 2 == part).select(log_lines(events).alias("value"))
        lines.write.mode("append").text(source)
        tail_log(spark, source, target, checkpoint)
    return flat_lines(spark.read.parquet(target))


@query("""SELECT DISTINCT split_part(url, '/', 3) AS dataset, substr(url, length(split_part(url, '/', 1)) + length(split_part(url, '/', 3)) + 4) AS path
FROM pages""")
def stream_route_keys(spark, sf):
    """Object events repeated in a message and again in a later one, routed once."""
    source, target, checkpoint = (fresh_dir(spark, n) for n in ("events", "routed", "offsets"))
    key = F.url_encode(F.regexp_replace("url", "^https?://", ""))
    record = F.struct(
        F.lit("2024-01-01T00:00:00Z").alias("eventTime"),
        F.struct(F.struct(key.alias("key"), F.length("html").cast("bigint").alias("size")).alias("object")).alias("s3"),
    )
    pages = d.table(spark, sf, "pages").select(F.array(record, record).alias("Records"))
    for _ in range(2):
        pages.write.mode("append").json(source)
        route_objects(spark, source, target, checkpoint)
    return spark.read.parquet(target).select("dataset", "path")
