"""Queries on lineage, builds and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import lineage
from tidemark.plans import derived as d
from tidemark.plans.registry import query

_IGNORED = "SELECT p_partkey AS node FROM part WHERE p_size = 7"


@query(f"""WITH RECURSIVE {d.EDGES}, ign AS ({_IGNORED}),
up(node) AS (SELECT p_partkey FROM part WHERE p_size >= 45 AND p_size <> 7
  UNION SELECT parent FROM edges JOIN up ON child = node WHERE parent NOT IN (SELECT node FROM ign))
SELECT node FROM up""")
def lineage_upstream(spark, sf):
    """Everything the parts of the largest sizes are built from, stopping at the parts of one size."""
    part = d.table(spark, sf, "part")
    targets = part.where("p_size >= 45").select(F.col("p_partkey").alias("node"))
    ignored = part.where("p_size = 7").select(F.col("p_partkey").alias("node"))
    return lineage.upstream(d.edges(spark, sf), targets, ignored)


@query(f"""WITH RECURSIVE {d.EDGES}, ign AS ({_IGNORED}),
top AS (SELECT p_partkey AS node FROM part WHERE p_partkey BETWEEN 2 AND 40 AND p_partkey NOT IN (SELECT node FROM ign)),
bottom AS (SELECT p_partkey AS node FROM part WHERE p_size = 9),
down(node) AS (SELECT node FROM top UNION SELECT child FROM edges JOIN down ON parent = node WHERE child NOT IN (SELECT node FROM ign)),
up(node) AS (SELECT node FROM bottom UNION SELECT parent FROM edges JOIN up ON child = node WHERE parent NOT IN (SELECT node FROM ign))
SELECT node FROM down WHERE node IN (SELECT node FROM up)""")
def lineage_connecting(spark, sf):
    """What lies between the low part keys and the parts of one size."""
    part = d.table(spark, sf, "part")
    node = F.col("p_partkey").alias("node")
    return lineage.connecting(
        d.edges(spark, sf),
        part.where("p_partkey BETWEEN 2 AND 40").select(node),
        part.where("p_size = 9").select(node),
        part.where("p_size = 7").select(node),
    )


@query("""WITH specs AS (SELECT 'job' || p_partkey AS job_rid, 'ds' || p_size AS rid FROM part),
wanted AS (SELECT DISTINCT 'ds' || (user_id % 60) AS rid, (user_id % 60) % 2 = 0 AS required FROM events WHERE user_id % 60 > 40)
SELECT rid, job_rid, 'SELECTED' AS state FROM specs WHERE rid IN (SELECT rid FROM wanted)
UNION ALL SELECT rid, NULL, 'MISSING' FROM wanted WHERE required AND rid NOT IN (SELECT rid FROM specs)""")
def job_selection(spark, sf):
    """Jobs of the wanted datasets, and the required datasets that have none."""
    specs = d.table(spark, sf, "part").select(
        d.text("job", F.col("p_partkey")).alias("job_rid"), d.text("ds", F.col("p_size")).alias("rid")
    )
    number = F.col("user_id") % 60
    wanted = d.table(spark, sf, "events").where(number > 40).select(d.text("ds", number).alias("rid"), (number % 2 == 0).alias("required"))
    chosen, missing = lineage.select_jobs(specs, wanted, "rid")
    return chosen.select("rid", "job_rid", F.lit("SELECTED").alias("state")).unionByName(
        missing.select("rid", F.lit(None).cast("string").alias("job_rid"), F.lit("MISSING").alias("state"))
    )


@query(f"""WITH {d.LOG}, last AS (SELECT rid, max(seq) AS seq FROM log WHERE {d.COMMITTED} GROUP BY rid),
e AS (SELECT DISTINCT 'ds' || (p_partkey % 23) AS child, 'ds' || (CAST(floor(p_partkey / 2) AS BIGINT) % 20) AS parent FROM part),
x AS (SELECT child, max(seq) AS newest_input FROM e JOIN last ON parent = rid WHERE child <> parent GROUP BY child)
SELECT child, seq AS output_seq, newest_input FROM x LEFT JOIN last ON child = rid WHERE seq IS NULL OR newest_input > seq""")
def stale_outputs(spark, sf):
    key = F.col("p_partkey")
    pairs = d.table(spark, sf, "part").select(
        d.text("ds", key % 23).alias("child"), d.text("ds", F.floor(key / 2) % 20).alias("parent")
    )
    edges = pairs.where("child <> parent").distinct()
    return lineage.stale_outputs(edges, d.event_log(spark, sf))


@query("""SELECT user_id AS check_rid, event_id AS seq, event_type AS status, CAST(row_number() OVER
  (PARTITION BY user_id ORDER BY event_id DESC) AS INT) AS position FROM events QUALIFY position <= 5""")
def latest_check_runs(spark, sf):
    """Users as checks, their events as runs."""
    runs = d.table(spark, sf, "events").select(
        F.col("user_id").alias("check_rid"), F.col("event_id").alias("seq"), F.col("event_type").alias("status")
    )
    return lineage.latest_runs(runs)


@query("""SELECT c_custkey AS schedule, CASE WHEN c_custkey % 3 = 0 THEN 'dev' ELSE 'master' END AS branch FROM customer
WHERE (c_custkey % 20 = 3 OR c_nationkey % 20 = 3) AND c_custkey % 3 <> 0""")
def schedules_for_dataset(spark, sf):
    """Customers as schedules over two datasets each."""
    schedules = d.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("schedule"),
        F.when(F.col("c_custkey") % 3 == 0, "dev").otherwise("master").alias("branch"),
        F.array(d.text("ds", F.col("c_custkey") % 20), d.text("ds", F.col("c_nationkey") % 20)).alias("dataset_rids"),
    )
    return lineage.schedules_for(schedules, "ds3", "master").select("schedule", "branch")
