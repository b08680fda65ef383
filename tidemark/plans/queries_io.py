"""Queries that write versions of whole tables and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import derived as d
from tidemark.plans.registry import query
from tidemark.plans.store import Store
from tidemark.session import fresh_dir
from tidemark.sources import readers, writers
from tidemark.sources import schema as docs

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
SUMMARY = """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
  min(o_orderdate) AS first_date FROM {} GROUP BY o_orderstatus"""


def summary(df):
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
        F.min("o_orderdate").alias("first_date"),
    )


def _new(spark, path="/demo/orders"):
    return Store(spark).create_dataset(path)


@query(f"SELECT {ORDERS} FROM orders")
def scan_csv_roundtrip(spark, sf):
    """Orders as CSV files with a header each, read by a document with text parser settings."""
    orders = d.table(spark, sf, "orders")
    doc = docs.to_document(orders.schema, "csv", text_parser={"fieldDelimiter": ";", "quoteCharacter": "'"})
    saved = _new(spark).save_dataframe(
        orders.repartition(3), doc=doc, fmt="csv", options={"header": "true", "sep": ";", "quote": "'"}
    )
    return saved.dataframe()


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_json_roundtrip(spark, sf):
    return _new(spark, "/demo/customer").save_dataframe(d.table(spark, sf, "customer"), fmt="json").dataframe()


@query(SUMMARY.format("orders WHERE o_orderstatus <> 'O'"))
def scan_hive_partitioned(spark, sf):
    """One transaction with partition folders, of which the filter leaves some unread."""
    saved = _new(spark).save_dataframe(d.table(spark, sf, "orders"), partition_by=["o_orderstatus"])
    return summary(saved.lazy().where("o_orderstatus <> 'O'"))


@query("""SELECT o_orderkey, o_orderstatus AS status, 2 AS names, o_orderpriority AS second, o_totalprice AS price FROM orders""")
def nested_roundtrip(spark, sf):
    """Struct, array of struct and map columns through a written version."""
    nested = d.table(spark, sf, "orders").select(
        "o_orderkey",
        F.struct("o_orderstatus", "o_custkey").alias("one"),
        F.array(F.struct(F.col("o_orderstatus").alias("v")), F.struct(F.col("o_orderpriority").alias("v"))).alias("many"),
        F.create_map(F.lit("price"), "o_totalprice").alias("rates"),
    )
    read = _new(spark).save_dataframe(nested).dataframe()
    return read.select(
        "o_orderkey",
        F.col("one.o_orderstatus").alias("status"),
        F.size("many").alias("names"),
        F.col("many")[1]["v"].alias("second"),
        F.col("rates")["price"].alias("price"),
    )


@query(SUMMARY.format("orders WHERE o_orderstatus <> 'F'"))
def write_snapshot(spark, sf):
    """A snapshot hides everything before it."""
    orders = d.table(spark, sf, "orders")
    saved = _new(spark).save_dataframe(orders, "SNAPSHOT").save_dataframe(orders.where("o_orderstatus <> 'F'"), "SNAPSHOT")
    return summary(saved.dataframe())


@query(SUMMARY.format("orders"))
def write_append(spark, sf):
    orders = d.table(spark, sf, "orders")
    saved = _new(spark).save_dataframe(orders.where("o_orderstatus = 'F'"), "SNAPSHOT")
    return summary(saved.save_dataframe(orders.where("o_orderstatus <> 'F'"), "APPEND").dataframe())


@query(SUMMARY.format("(SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1000 ELSE o_totalprice END AS o_totalprice) FROM orders) x"))
def write_update(spark, sf):
    """One partition rewritten in place, the others stay."""
    orders = d.table(spark, sf, "orders")
    saved = _new(spark).save_dataframe(orders, "SNAPSHOT", partition_by=["o_orderstatus"])
    raised = orders.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    saved.save_dataframe(raised, "UPDATE", partition_by=["o_orderstatus"], replace_partitions=True)
    return summary(saved.dataframe())


@query(SUMMARY.format("orders WHERE o_orderstatus <> 'P'"))
def delete_files(spark, sf):
    saved = _new(spark).save_dataframe(d.table(spark, sf, "orders"), partition_by=["o_orderstatus"])
    gone = saved.files().where(F.contains("path", F.lit("o_orderstatus=P/")))
    return summary(saved.delete_files(gone).dataframe())


@query("SELECT concat_ws(',', c_custkey, c_name, c_nationkey, c_mktsegment) AS line FROM customer")
def export_csv_lines(spark, sf):
    target = fresh_dir(spark, "export")
    rows = d.dataset(spark, sf, "customer").dataframe().select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    writers.export_csv(rows, target, header=False)
    return spark.read.text(target).select(F.col("value").alias("line"))


@query("SELECT c_custkey, c_name FROM customer")
def concat_files_prefer_parquet(spark, sf):
    """A dataset with parquet and CSV files gives its parquet rows."""
    store = Store(spark)
    saved = store.create_dataset("/demo/mixed")
    saved.save_dataframe(d.table(spark, sf, "customer").select("c_custkey", "c_name"), "SNAPSHOT")
    saved.save_dataframe(d.table(spark, sf, "supplier").select("s_suppkey", "s_name"), "APPEND", fmt="csv")
    return readers.read_preferring_parquet(spark, saved.files())


@query("""SELECT * FROM (VALUES (0, 'o_orderkey', 'INTEGER'), (1, 'o_custkey', 'INTEGER'), (2, 'o_orderstatus', 'STRING'),
  (3, 'o_totalprice', 'DOUBLE'), (4, 'o_orderday', 'DATE'), (5, 'o_orderpriority', 'STRING')) v(position, name, type)""")
def infer_csv_schema(spark, sf):
    """Schema document inferred from CSV text of all orders."""
    orders = d.table(spark, sf, "orders").withColumn("o_orderday", F.col("o_orderdate").cast("date"))
    target = fresh_dir(spark, "infer")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderday", "o_orderpriority"]
    writers.export_csv(orders.select(*columns), target, sep="|")
    doc = readers.infer_schema(spark, [target], "csv")
    rows = [(i, f["name"], f["type"]) for i, f in enumerate(doc["fieldSchemaList"])]
    return spark.createDataFrame(rows, "position int, name string, type string")
