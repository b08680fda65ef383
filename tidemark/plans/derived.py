"""Frames the registered queries work on, derived from whole tables, with the same derivation as SQL.

``events`` serves as a transaction log: each event is one file operation and one transaction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.store import Dataset, Store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def max_event(events: DataFrame) -> Column:
    return events.agg(F.max("event_id")).scalar()


def fraction_of_log(events: DataFrame, share: float) -> Column:
    return F.floor(max_event(events) * F.lit(share)).cast("bigint")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rid, branch, seq, ts, type, status, path, length."""
    events = table(spark, sf_dir, "events")
    kind, number = F.col("event_type"), F.col("event_id")
    folder = F.when(number % 7 == 0, "_log/part-").otherwise("spark/part-")
    return events.select(
        text("ds", F.col("user_id") % 20).alias("rid"),
        F.when(F.col("user_id") % 3 == 0, "dev").otherwise("master").alias("branch"),
        number.alias("seq"),
        "ts",
        F.when((kind == "signup") & (number % 40 == 0), "SNAPSHOT")
        .when((kind == "click") & (number % 5 == 0), "DELETE")
        .when(kind.isin("purchase", "click"), "UPDATE")
        .otherwise("APPEND")
        .alias("type"),
        F.when(kind == "error", "ABORTED")
        .when(number >= max_event(events) - 15, "OPEN")
        .otherwise("COMMITTED")
        .alias("status"),
        text(folder, (number * 7919) % 13, ".parquet").alias("path"),
        F.floor("value").cast("bigint").alias("length"),
    )


LOG = """log AS (SELECT 'ds' || CAST(user_id % 20 AS STRING) AS rid,
  CASE WHEN user_id % 3 = 0 THEN 'dev' ELSE 'master' END AS branch, event_id AS seq, ts,
  CASE WHEN event_type = 'signup' AND event_id % 40 = 0 THEN 'SNAPSHOT'
       WHEN event_type = 'click' AND event_id % 5 = 0 THEN 'DELETE'
       WHEN event_type IN ('purchase', 'click') THEN 'UPDATE' ELSE 'APPEND' END AS type,
  CASE WHEN event_type = 'error' THEN 'ABORTED'
       WHEN event_id >= (SELECT max(event_id) FROM events) - 15 THEN 'OPEN'
       ELSE 'COMMITTED' END AS status,
  CASE WHEN event_id % 7 = 0 THEN '_log/part-' ELSE 'spark/part-' END
    || CAST((event_id * 7919) % 13 AS STRING) || '.parquet' AS path,
  CAST(floor(value) AS BIGINT) AS length FROM events)"""

COMMITTED = "status = 'COMMITTED'"
HIDDEN = r"regexp_matches(path, '(^|/)[._]')"


def share_sql(share: float) -> str:
    return f"(SELECT CAST(floor(max(event_id) * {share}) AS BIGINT) FROM events)"


def view_sql(condition: str = COMMITTED, source: str = "log") -> str:
    """CTEs up to ``vf``: the files visible among the rows of ``source`` that meet the condition."""
    return f"""live AS (SELECT *, max(CASE WHEN type = 'SNAPSHOT' THEN seq END)
           OVER (PARTITION BY rid, branch) AS snap FROM {source} WHERE {condition}),
vf AS (SELECT rid, branch, path, seq, length FROM (SELECT *, row_number() OVER
           (PARTITION BY rid, branch, path ORDER BY seq DESC) AS rn FROM live
           WHERE snap IS NULL OR seq >= snap) x WHERE rn = 1 AND type <> 'DELETE')"""


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog of customers under nation and region folders: rid, path, name, kind and what lists sort by."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            text("ri.catalog.main.dataset.", F.col("c_custkey")).alias("rid"),
            text("/", F.col("r_name"), "/", F.col("n_name"), "/", F.col("c_name")).alias("path"),
            F.col("c_name").alias("name"),
            F.lit("dataset").alias("kind"),
            F.array("c_mktsegment", F.col("r_name")).alias("tags"),
            (F.col("c_acctbal") < 0).alias("trashed"),
        )
    )


def folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region and nation folders: rid, path."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    regions = region.select(
        text("ri.catalog.main.folder.r", F.col("r_regionkey")).alias("rid"), text("/", F.col("r_name")).alias("path")
    )
    nations = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        text("ri.catalog.main.folder.n", F.col("n_nationkey")).alias("rid"),
        text("/", F.col("r_name"), "/", F.col("n_name")).alias("path"),
    )
    return regions.unionByName(nations)


RESOURCES = """res AS (SELECT 'ri.catalog.main.dataset.' || c_custkey AS rid,
  '/' || r_name || '/' || n_name || '/' || c_name AS path, c_name AS name,
  c_mktsegment, r_name, c_acctbal < 0 AS trashed
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
fold AS (SELECT 'ri.catalog.main.folder.r' || r_regionkey AS rid, '/' || r_name AS path FROM region
  UNION ALL SELECT 'ri.catalog.main.folder.n' || n_nationkey, '/' || r_name || '/' || n_name
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as imports of customers: every tenth one points at a rid nobody has."""
    shifted = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_custkey") + 1_000_000_000_000).otherwise(F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text("ri.catalog.main.dataset.", shifted).alias("rid"),
        F.when(F.col("o_orderkey") % 3 == 0, "EXTERNAL").otherwise("FILE_SYSTEM").alias("type"),
    )


IMPORTS = """imp AS (SELECT o_orderkey, 'ri.catalog.main.dataset.' ||
  CASE WHEN o_orderkey % 10 = 0 THEN o_custkey + 1000000000000 ELSE o_custkey END AS rid,
  CASE WHEN o_orderkey % 3 = 0 THEN 'EXTERNAL' ELSE 'FILE_SYSTEM' END AS type FROM orders)"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage over part keys: each is built from its half and its third."""
    key = F.col("p_partkey")
    return (
        table(spark, sf_dir, "part")
        .where(key > 1)
        .select(key.alias("child"), F.explode(F.array(F.floor(key / 2), F.floor(key / 3))).alias("parent"))
    )


EDGES = """edges AS (SELECT p_partkey AS child, CAST(floor(p_partkey / 2) AS BIGINT) AS parent FROM part WHERE p_partkey > 1
  UNION ALL SELECT p_partkey, CAST(floor(p_partkey / 3) AS BIGINT) FROM part WHERE p_partkey > 1)"""


_warehouses: dict[tuple[str, str], Store] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Store:
    """A store, one per session and table folder, whose datasets ``/tpch/<table>`` are the tables where they lie."""
    return _warehouses.setdefault((spark.sparkContext.applicationId, sf_dir), Store(spark))


def dataset(spark: SparkSession, sf_dir: str, name: str) -> Dataset:
    store, path = warehouse(spark, sf_dir), f"/tpch/{name}"
    if store.has_dataset(path):
        return store.dataset(path)
    return store.create_dataset(path).import_files(f"{sf_dir}/{name}.parquet")


def versioned_orders(spark: SparkSession, sf_dir: str) -> Dataset:
    """Orders in three transactions, one per status: SNAPSHOT of F, then APPENDs of O and P."""
    store = warehouse(spark, sf_dir)
    if store.has_dataset("/sales/orders"):
        return store.dataset("/sales/orders")
    orders = table(spark, sf_dir, "orders")
    out = store.create_dataset("/sales/orders")
    for status, kind in (("F", "SNAPSHOT"), ("O", "APPEND"), ("P", "APPEND")):
        out.save_dataframe(orders.where(F.col("o_orderstatus") == status), kind)
    return out
