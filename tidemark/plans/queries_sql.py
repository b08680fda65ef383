"""Queries through SQL text on datasets, scans, samples and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import stats
from tidemark.plans import derived as d
from tidemark.plans.registry import query
from tidemark.plans.sql import run_sql
from tidemark.sources import readers, writers
from tidemark.sources import schema as docs


def _sql(spark, sf, text: str, *tables: str, **kwargs):
    for name in tables:
        d.dataset(spark, sf, name)
    return run_sql(d.warehouse(spark, sf), text, "spark", **kwargs)


@query("""SELECT l_linenumber, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY l_linenumber""")
def scan_parquet(spark, sf):
    """All files of the current version, read by the stored schema."""
    return (
        d.dataset(spark, sf, "lineitem")
        .dataframe()
        .groupBy("l_linenumber")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("l_quantity").cast("bigint").alias("quantity"),
            F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000""")
def filter_pushdown(spark, sf):
    orders = d.dataset(spark, sf, "orders").dataframe()
    return orders.where("o_orderstatus = 'F' AND o_totalprice > 300000").select("o_orderkey", "o_totalprice")


@query("SELECT p_partkey, p_name, 'catalogue' AS origin, p_size * 10 AS millimetres FROM part")
def project_literal(spark, sf):
    parts = d.dataset(spark, sf, "part").dataframe()
    return parts.select("p_partkey", "p_name", F.lit("catalogue").alias("origin"), (F.col("p_size") * 10).alias("millimetres"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'")
def sql_select_where(spark, sf):
    text = "SELECT l_orderkey, l_linenumber, l_quantity FROM `/tpch/lineitem` WHERE l_quantity > 45 AND l_returnflag = 'R'"
    return _sql(spark, sf, text, "lineitem")


@query("SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS highest FROM orders WHERE o_orderstatus = 'O' GROUP BY o_orderpriority")
def sql_from_first(spark, sf):
    orders = d.dataset(spark, sf, "orders")
    text = "SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS highest WHERE o_orderstatus = 'O' GROUP BY o_orderpriority"
    return orders.query(text, "spark")


@query("""SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus""")
def sql_txn_range(spark, sf):
    """The two transactions appended after the snapshot."""
    orders = d.versioned_orders(spark, sf)
    last, first, _ = orders.get_transactions(3)
    ref = f"`{first['txn']}:{last['txn']}@master`.`/sales/orders`"
    text = f"SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key FROM {ref} GROUP BY o_orderstatus"
    return run_sql(orders.store, text, "spark", branch="elsewhere")


@query("""SELECT p_brand, count(*) AS n, count(TRY_CAST(p_type AS INT)) AS numbers, count(TRY_CAST(substr(p_brand, 7) AS INT)) AS brands
FROM part GROUP BY p_brand""")
def sql_dialect_spark(spark, sf):
    """Casts that fail give NULL in this dialect."""
    text = """SELECT p_brand, count(*) AS n, count(CAST(p_type AS INT)) AS numbers, count(CAST(substr(p_brand, 7) AS INT)) AS brands
        FROM `/tpch/part` GROUP BY p_brand"""
    return _sql(spark, sf, text, "part", sql_dialect="SPARK")


_GROUP = """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity,
  count(DISTINCT l_suppkey) AS suppliers FROM {} GROUP BY l_returnflag, l_linestatus"""


@query(_GROUP.format("lineitem"))
def sql_group_by(spark, sf):
    return _sql(spark, sf, _GROUP.format("`/tpch/lineitem`"), "lineitem")


_ROLLUP = """SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(grouping(o_orderstatus) + grouping(o_orderpriority) AS INT) AS level
FROM {} GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"""


@query(_ROLLUP.format("orders"))
def sql_rollup(spark, sf):
    return _sql(spark, sf, _ROLLUP.format("`/tpch/orders`"), "orders")


_WINDOW = """SELECT o_custkey, o_orderkey, o_totalprice, CAST(place AS INT) AS place FROM (SELECT o_custkey, o_orderkey, o_totalprice,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM {}) x WHERE place <= 3"""


@query(_WINDOW.format("orders"))
def sql_window(spark, sf):
    return _sql(spark, sf, _WINDOW.format("`/tpch/orders`"), "orders")


_TOPK = "SELECT o_orderkey, o_totalprice FROM {} ORDER BY o_totalprice DESC, o_orderkey LIMIT 25"


@query(_TOPK.format("orders"))
def sql_topk(spark, sf):
    return _sql(spark, sf, _TOPK.format("`/tpch/orders`"), "orders")


@query("""SELECT c_nationkey AS nation, count(*) AS customers, min(c_name) AS first_name, 'c_nationkey INTEGER, customers LONG, first_name STRING' AS fields
FROM customer GROUP BY c_nationkey""")
def sql_raw_rows(spark, sf):
    """Raw delivery, a schema document and a matrix of rows, of a result that is small whatever the scale."""
    text = "SELECT c_nationkey, count(*) AS customers, min(c_name) AS first_name FROM `/tpch/customer` GROUP BY c_nationkey"
    doc, rows = writers.deliver(_sql(spark, sf, text, "customer"), "raw")
    fields = ", ".join(f"{f['name']} {f['type']}" for f in doc["fieldSchemaList"])
    return spark.createDataFrame([(*row, fields) for row in rows], "nation int, customers bigint, first_name string, fields string")


@query("SELECT '[\"' || c_custkey || '\",\"' || c_name || '\",\"' || c_mktsegment || '\"]' AS row FROM customer")
def sql_json_rows(spark, sf):
    rows = _sql(spark, sf, "SELECT c_custkey, c_name, c_mktsegment FROM `/tpch/customer`", "customer")
    return rows.select(writers.json_row([F.col(c) for c in rows.columns]).alias("row"))


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_totalprice AS DECIMAL(17, 2)) AS exact_price,
  o_orderdate, CAST(o_orderdate AS DATE) AS order_day, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def typed_rows_cast(spark, sf):
    """Orders as text rows, typed again by their schema."""
    price = F.col("o_totalprice")
    as_text = d.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        "o_orderstatus",
        price.cast("string"),
        price.cast("decimal(17,2)").cast("string").alias("exact_price"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("o_orderdate"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    doc = {
        "fieldSchemaList": [
            {"name": "o_orderkey", "type": "LONG"},
            {"name": "o_custkey", "type": "LONG"},
            {"name": "o_orderstatus", "type": "STRING"},
            {"name": "o_totalprice", "type": "DOUBLE"},
            {"name": "exact_price", "type": "DECIMAL", "precision": 17, "scale": 2},
            {"name": "o_orderdate", "type": "TIMESTAMP"},
            {"name": "order_day", "type": "DATE"},
            {"name": "o_orderpriority", "type": "STRING"},
        ]
    }
    typed = readers.cast_text_rows(as_text, docs.to_struct_type(doc))
    return typed.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


_STATS = """SELECT '{0}' AS "column", count(*) AS row_count, count(*) - count({0}) AS null_count,
  count(DISTINCT {0}) AS unique_count, round(avg(length(CAST({0} AS VARCHAR))), 6) AS avg_length,
  CAST(max(length(CAST({0} AS VARCHAR))) AS INT) AS max_length FROM customer"""


@query(" UNION ALL ".join(_STATS.format(c) for c in ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]))
def column_stats(spark, sf):
    return stats.column_stats(d.table(spark, sf, "customer")).withColumn("avg_length", F.round("avg_length", 6))


@query("""WITH u AS (UNPIVOT (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority
  FROM orders) ON COLUMNS(*) INTO NAME "column" VALUE v)
SELECT "column", count(*) AS row_count, CAST(0 AS BIGINT) AS null_count, CAST(max(length(v)) AS INT) AS max_length, true AS within_bound FROM u GROUP BY "column\"""")
def column_stats_approx(spark, sf):
    """Sketched numbers of distinct values lie within three standard errors of the exact ones, the others are exact."""
    rows = d.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    exact = stats.column_stats(rows).select("column", F.col("unique_count").alias("exact"))
    near = F.abs(F.col("unique_count") - F.col("exact")) <= 3 * 0.05 * F.col("exact")
    found = stats.column_stats_approx(rows, 0.05).join(exact, "column")
    return found.select("column", "row_count", "null_count", "max_length", near.alias("within_bound"))


SAMPLED = """SELECT least(5000, count(*)) AS n, least(5000, count(*)) AS found, least(5000, count(*)) AS different FROM lineitem"""


def _judged(sample, rows):
    """Sampled rows, how many of them the table holds with all their values, and how many differ."""
    same = rows.select(*rows.columns).distinct().withColumn("there", F.lit(1))
    found = sample.join(same, rows.columns, "left")
    return found.agg(F.count(F.lit(1)).alias("n"), F.count("there").alias("found"), F.countDistinct(*rows.columns).alias("different"))


@query(SAMPLED)
def sample_limit_count(spark, sf):
    """The first 5000 rows are whole rows of the table, none twice."""
    rows = d.dataset(spark, sf, "lineitem").dataframe()
    return _judged(stats.sample_first(rows, 5000), rows)


@query(SAMPLED)
def sample_random_count(spark, sf):
    """5000 rows drawn at random are whole rows of the table, none twice."""
    rows = d.dataset(spark, sf, "lineitem").dataframe()
    return _judged(stats.sample_random(rows, 5000), rows)
