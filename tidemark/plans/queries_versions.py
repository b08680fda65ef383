"""Queries on the transaction log: views, branches, transactions, retention, schemas over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import is_hidden, matches_regex
from tidemark.operators import branches, catalog, retention, stats, transactions, views
from tidemark.plans import derived as d
from tidemark.plans.registry import query
from tidemark.sources import schema as docs

FILES = "rid, branch, path, seq, length"


@query(f"WITH {d.LOG}, {d.view_sql()} SELECT {FILES} FROM vf")
def view_files(spark, sf):
    return views.view_files(d.event_log(spark, sf))


@query(f"WITH {d.LOG}, {d.view_sql(f'{d.COMMITTED} AND seq <= {d.share_sql(0.5)}')} SELECT {FILES} FROM vf")
def view_as_of(spark, sf):
    end = d.fraction_of_log(d.table(spark, sf, "events"), 0.5)
    return views.view_files(d.event_log(spark, sf), end=end)


@query(
    f"WITH {d.LOG}, "
    f"{d.view_sql(f'{d.COMMITTED} AND seq >= {d.share_sql(0.25)} AND seq <= {d.share_sql(0.75)}')} SELECT {FILES} FROM vf"
)
def view_range(spark, sf):
    events = d.table(spark, sf, "events")
    return views.view_files(
        d.event_log(spark, sf), start=d.fraction_of_log(events, 0.25), end=d.fraction_of_log(events, 0.75)
    )


@query(f"""WITH {d.LOG}, {d.view_sql("status IN ('COMMITTED', 'OPEN')")} SELECT {FILES} FROM vf""")
def view_with_open(spark, sf):
    return views.view_files(d.event_log(spark, sf), include_open=True)


@query(f"""WITH {d.LOG},
seen AS (SELECT rid, branch, seq, type, status, path, length FROM log
  UNION ALL SELECT rid, 'dev', seq, type, status, path, length FROM log
  WHERE branch = 'master' AND seq <= {d.share_sql(0.5)}),
{d.view_sql(source="seen")} SELECT {FILES} FROM vf""")
def branch_view(spark, sf):
    """Every dataset's dev branch forked off master halfway through the log."""
    log = d.event_log(spark, sf)
    fork = d.fraction_of_log(d.table(spark, sf, "events"), 0.5)
    names = log.select("rid").distinct()
    known = names.select(
        "rid", F.lit("master").alias("branch"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("bigint").alias("fork_seq")
    ).unionByName(
        names.select("rid", F.lit("dev").alias("branch"), F.lit("master").alias("parent"), fork.alias("fork_seq"))
    )
    ops = log.select("rid", "branch", "seq", "type", "status", "path", "length")
    return views.view_files(branches.inherited_ops(ops, branches.branch_lineage(known)))


@query(f"""WITH {d.LOG} SELECT rid, branch,
  min(CASE WHEN {d.COMMITTED} THEN seq END) AS first_seq, max(CASE WHEN {d.COMMITTED} THEN seq END) AS last_seq,
  CAST(sum(CASE WHEN {d.COMMITTED} THEN 1 ELSE 0 END) AS BIGINT) AS committed FROM log GROUP BY rid, branch""")
def list_branches(spark, sf):
    return branches.list_branches(d.event_log(spark, sf))


@query(f"""WITH {d.LOG}, known AS (SELECT DISTINCT rid, branch FROM log WHERE {d.COMMITTED}),
req AS (SELECT event_id, 'ds' || (user_id % 25) AS rid,
  CASE event_id % 3 WHEN 0 THEN 'dev' WHEN 1 THEN 'feature' ELSE 'master' END AS branch FROM events)
SELECT r.event_id, r.rid, r.branch, CASE
  WHEN EXISTS (SELECT 1 FROM known k WHERE k.rid = r.rid AND k.branch = r.branch) THEN r.branch
  WHEN EXISTS (SELECT 1 FROM known k WHERE k.rid = r.rid AND k.branch = 'master') THEN 'master'
  WHEN EXISTS (SELECT 1 FROM known k WHERE k.rid = r.rid AND k.branch = 'dev') THEN 'dev' END AS used_branch
FROM req r""")
def branch_fallback(spark, sf):
    known = d.event_log(spark, sf).where("status = 'COMMITTED'").select("rid", "branch").distinct()
    number = F.col("event_id") % 3
    requests = d.table(spark, sf, "events").select(
        "event_id",
        d.text("ds", F.col("user_id") % 25).alias("rid"),
        F.when(number == 0, "dev").when(number == 1, "feature").otherwise("master").alias("branch"),
    )
    return branches.resolve_branch(requests, known, ["master", "dev"])


@query(f"""WITH {d.LOG}, {d.view_sql()} SELECT rid, branch,
  CAST(sum(CASE WHEN NOT {d.HIDDEN} THEN length ELSE 0 END) AS BIGINT) AS size_in_bytes,
  CAST(sum(CASE WHEN NOT {d.HIDDEN} THEN 1 ELSE 0 END) AS BIGINT) AS num_files,
  CAST(sum(CASE WHEN {d.HIDDEN} THEN length ELSE 0 END) AS BIGINT) AS hidden_files_size_in_bytes,
  CAST(sum(CASE WHEN {d.HIDDEN} THEN 1 ELSE 0 END) AS BIGINT) AS num_hidden_files,
  count(DISTINCT seq) AS num_transactions FROM vf GROUP BY rid, branch""")
def dataset_stats(spark, sf):
    return stats.dataset_stats(views.view_files(d.event_log(spark, sf)))


@query(f"""WITH {d.LOG}, {d.view_sql()}, sized AS (SELECT rid, branch,
  CAST(sum(CASE WHEN NOT {d.HIDDEN} THEN length ELSE 0 END) AS BIGINT) * 1048576 AS size_in_bytes FROM vf GROUP BY rid, branch)
SELECT rid, branch, size_in_bytes, round(size_in_bytes / 1024.0 / 1024.0, 2) AS size_mb,
  CASE WHEN size_in_bytes / 1024.0 / 1024.0 < 500 THEN 'FULL' ELSE 'SAMPLE' END AS read_mode FROM sized""")
def size_gate(spark, sf):
    """Read modes of the views, their lengths taken as megabytes."""
    sized = stats.dataset_stats(views.view_files(d.event_log(spark, sf)))
    return stats.size_gate(sized.select("rid", "branch", (F.col("size_in_bytes") * 1048576).alias("size_in_bytes")))


@query(f"""WITH {d.LOG}, f AS (SELECT *, CAST(floor(seq / 16) AS BIGINT) AS txn FROM log) SELECT rid, branch, txn,
  count(*) AS file_count, CAST(sum(length) AS BIGINT) AS total_file_size,
  CAST(sum(CASE WHEN {d.HIDDEN} THEN 1 ELSE 0 END) AS BIGINT) AS hidden_file_count,
  CAST(sum(CASE WHEN {d.HIDDEN} THEN length ELSE 0 END) AS BIGINT) AS total_hidden_file_size
FROM f GROUP BY rid, branch, txn""")
def transaction_metadata(spark, sf):
    """Sixteen neighbouring events taken as one transaction."""
    files = d.event_log(spark, sf).withColumn("txn", F.floor(F.col("seq") / 16))
    return transactions.transaction_metadata(files, ["rid", "branch", "txn"])


@query(f"""WITH {d.LOG} SELECT rid, branch, seq, type, status FROM (SELECT *, row_number() OVER
  (PARTITION BY rid, branch ORDER BY seq DESC) AS rn FROM log WHERE {d.COMMITTED}) x WHERE rn = 1""")
def last_transaction(spark, sf):
    return transactions.last_transactions(d.event_log(spark, sf))


@query(f"""WITH {d.LOG} SELECT rid, branch, seq, type, status FROM (SELECT *, row_number() OVER
  (PARTITION BY rid, branch ORDER BY seq DESC) AS rn FROM log WHERE status IN ('COMMITTED', 'OPEN')) x
WHERE rn = 1 AND status = 'OPEN'""")
def open_transaction(spark, sf):
    return transactions.open_transactions(d.event_log(spark, sf))


@query(f"""WITH {d.LOG} SELECT rid, branch, seq, type, status, position FROM (SELECT *, CAST(row_number() OVER
  (PARTITION BY rid, branch ORDER BY seq DESC) AS INT) AS position FROM log
  WHERE {d.COMMITTED} AND seq >= {d.share_sql(0.5)}) x WHERE position <= 5""")
def reverse_transactions(spark, sf):
    end = d.fraction_of_log(d.table(spark, sf, "events"), 0.5)
    return transactions.reverse_transactions(d.event_log(spark, sf), 5, end=end)


@query(f"""WITH {d.LOG} SELECT rid, branch, open_count, open_count > 1 AS many_open,
  coalesce(first_open < last_committed, false) AS open_overtaken FROM (SELECT rid, branch,
  CAST(sum(CASE WHEN status = 'OPEN' THEN 1 ELSE 0 END) AS BIGINT) AS open_count,
  max(CASE WHEN {d.COMMITTED} THEN seq END) AS last_committed, min(CASE WHEN status = 'OPEN' THEN seq END) AS first_open
  FROM log GROUP BY rid, branch) x WHERE open_count > 1 OR coalesce(first_open < last_committed, false)""")
def txn_violations(spark, sf):
    return transactions.log_violations(d.event_log(spark, sf))


@query(f"""WITH {d.LOG} SELECT rid, branch, CAST(floor(seq / 128) AS BIGINT) AS txn, path, count(*) AS puts FROM log
GROUP BY ALL HAVING count(*) > 1""")
def duplicate_puts(spark, sf):
    """128 neighbouring events taken as one transaction."""
    files = d.event_log(spark, sf).withColumn("txn", F.floor(F.col("seq") / 128))
    return transactions.duplicate_puts(files, ["rid", "branch", "txn"])


@query(f"""WITH {d.LOG} SELECT rid, branch, seq, status, path FROM log
WHERE NOT (status = 'OPEN' AND (path = 'spark/part-3.parquet' OR path = '_log' OR path LIKE '\\_log/%' ESCAPE '\\'
  OR path = 'spark'))""")
def remove_open_files(spark, sf):
    """One file, one folder with its files, and one folder that is kept because the removal is not recursive."""
    files = d.event_log(spark, sf).select("rid", "branch", "seq", "status", "path")
    return transactions.remove_from_open(files, [("spark/part-3.parquet", False), ("_log", True), ("spark", False)])


@query(f"""WITH {d.LOG}, c AS (SELECT * FROM log WHERE {d.COMMITTED}),
p AS (SELECT *, lag(seq) OVER w AS prev_seq, lag(type) OVER w AS prev_type,
  max(CASE WHEN type = 'SNAPSHOT' THEN seq END) OVER (PARTITION BY rid, branch ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS snap
  FROM c WINDOW w AS (PARTITION BY rid, branch, path ORDER BY seq))
SELECT rid, branch, path, seq, prev_seq FROM p WHERE type = 'APPEND' AND prev_seq IS NOT NULL
  AND prev_type <> 'DELETE' AND (snap IS NULL OR snap <= prev_seq)""")
def append_conflicts(spark, sf):
    return views.append_conflicts(d.event_log(spark, sf))


@query(f"""WITH {d.LOG} SELECT seq, path, {d.HIDDEN} AS hidden FROM log""")
def hidden_files(spark, sf):
    return d.event_log(spark, sf).select("seq", "path", is_hidden(F.col("path")).alias("hidden"))


@query(rf"""WITH {d.LOG}, {d.view_sql()} SELECT {FILES} FROM vf
WHERE NOT {d.HIDDEN} AND regexp_matches(path, '^(?:spark/part-1)')""")
def files_ls_regex(spark, sf):
    files = views.view_files(d.event_log(spark, sf))
    return files.where(matches_regex(F.col("path"), "spark/part-1") & ~is_hidden(F.col("path")))


@query(f"""WITH {d.LOG}, {d.view_sql()} SELECT {FILES} FROM vf
WHERE path = '_log' OR starts_with(path, '_log/')""")
def list_files_prefix(spark, sf):
    return views.pick_logical_path(views.view_files(d.event_log(spark, sf)), "_log")


@query("""WITH f AS (SELECT 'ds' || o_custkey % 3 AS rid, 'master' AS branch, 'spark/part-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS path,
  o_orderkey AS seq, CAST(floor(o_totalprice) AS BIGINT) AS length FROM orders WHERE o_orderstatus <> 'P'),
p AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY path) AS n, lead(path, 1000) OVER (PARTITION BY rid ORDER BY path) AS ahead
  FROM f WHERE path >= 'spark/part-000000001000')
SELECT rid, branch, path, seq, length, CAST(n AS INT) AS position, max(CASE WHEN n = 1 THEN ahead END) OVER (PARTITION BY rid) AS next_page_token
FROM p QUALIFY n <= 1000""")
def list_files_page(spark, sf):
    """A page of a thousand of each view's files; every order is a file, and those pending were deleted again."""
    orders, key = d.table(spark, sf, "orders"), F.col("o_orderkey")
    put = orders.select(
        d.text("ds", F.col("o_custkey") % 3).alias("rid"),
        F.lit("master").alias("branch"),
        key.alias("seq"),
        F.lit("APPEND").alias("type"),
        F.lit("COMMITTED").alias("status"),
        F.concat(F.lit("spark/part-"), F.lpad(key.cast("string"), 12, "0")).alias("path"),
        F.floor("o_totalprice").cast("bigint").alias("length"),
    )
    gone = put.join(orders.where("o_orderstatus = 'P'").select(key.alias("seq")), "seq", "left_semi").select(*put.columns)
    log = put.unionByName(gone.withColumns({"type": F.lit("DELETE"), "seq": F.col("seq") + 1_000_000_000}))
    return catalog.file_page(views.view_files(log), page_size=1000, start_path="spark/part-000000001000")


@query(f"""WITH {d.LOG}, {d.view_sql()} SELECT {FILES} FROM vf WHERE path IN (SELECT 'spark/part-' || p_size || '.parquet' FROM part)""")
def select_files(spark, sf):
    wanted = d.table(spark, sf, "part").select(d.text("spark/part-", F.col("p_size"), ".parquet").alias("path")).distinct()
    return views.changed_paths(views.view_files(d.event_log(spark, sf)), wanted)


@query(f"""WITH {d.LOG}, {d.view_sql()}, named AS (SELECT rid, branch,
  CASE WHEN seq % 2 = 0 THEN replace(path, '.parquet', '.csv') ELSE path END AS path FROM vf),
firsts AS (SELECT rid, branch, min(path) AS first_file FROM named GROUP BY rid, branch)
SELECT rid, branch, first_file, CASE
  WHEN CAST(substr(rid, 3) AS INT) % 4 = 0 THEN 'csv' WHEN CAST(substr(rid, 3) AS INT) % 4 = 1 THEN 'parquet'
  WHEN contains(first_file, 'csv') THEN 'csv' WHEN contains(first_file, 'parquet') THEN 'parquet'
  ELSE 'unknown' END AS format FROM firsts""")
def infer_format(spark, sf):
    """Half of the files renamed to CSV; a quarter of the datasets each with a text and a parquet reader class."""
    files = views.view_files(d.event_log(spark, sf))
    named = F.when(F.col("seq") % 2 == 0, F.replace(F.col("path"), F.lit(".parquet"), F.lit(".csv"))).otherwise(F.col("path"))
    firsts = files.groupBy("rid", "branch").agg(F.min(named).alias("first_file"))
    number = F.substring("rid", 3, 9).cast("int") % 4
    reader = F.when(number == 0, "any.TextDataFrameReader").when(number == 1, "any.ParquetDataFrameReader")
    return firsts.withColumn("format", docs.infer_format(reader, F.col("first_file")))


# -- cached versions -----------------------------------------------------------------------------------------

_CACHED = "seq <= (SELECT max(event_id) - 500 FROM events)"


def _wanted_and_cached(spark, sf):
    log = d.event_log(spark, sf).where("status = 'COMMITTED'").select("rid", "branch", "seq")
    return log, log.where(F.col("seq") <= d.max_event(d.table(spark, sf, "events")) - 500)


@query(f"WITH {d.LOG} SELECT rid, branch, seq FROM log WHERE {d.COMMITTED} AND {_CACHED}")
def cache_hits(spark, sf):
    wanted, cached = _wanted_and_cached(spark, sf)
    return retention.cache_hits(wanted, cached, ["rid", "seq"])


@query(f"WITH {d.LOG} SELECT rid, branch, seq FROM log WHERE {d.COMMITTED} AND NOT {_CACHED}")
def cache_misses(spark, sf):
    wanted, cached = _wanted_and_cached(spark, sf)
    return retention.cache_misses(wanted, cached, ["rid", "seq"])


@query(f"""WITH {d.LOG} SELECT rid, branch, seq FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY seq DESC) AS rn
FROM log WHERE {d.COMMITTED}) x WHERE rn > 2""")
def cache_evictions(spark, sf):
    return retention.evictions(d.event_log(spark, sf).where("status = 'COMMITTED'").select("rid", "branch", "seq"), ["rid"])


@query(f"""WITH {d.LOG} SELECT rid, path, seq, length FROM (SELECT *, row_number() OVER
  (PARTITION BY rid, path ORDER BY seq DESC) AS rn FROM log) x WHERE rn = 1""")
def metadata_upsert(spark, sf):
    """The later half of the log written over the earlier one."""
    log = d.event_log(spark, sf).select("rid", "path", "seq", "length")
    half = d.fraction_of_log(d.table(spark, sf, "events"), 0.5)
    return retention.upsert(log.where(F.col("seq") <= half), log.where(F.col("seq") > half), ["rid", "path"])


# -- schemas over time -----------------------------------------------------------------------------------------


def _schema_docs(spark, sf):
    """A schema document put by every committed transaction that is no plain append."""
    seq = F.col("seq")
    kind = F.when(seq % 4 == 0, "STRING").when(seq % 4 == 1, "DATE").otherwise("DOUBLE")
    doc = d.text(
        '{"fieldSchemaList":[{"name":"id","type":"LONG","nullable":false,"customMetadata":{}},{"name":"f', seq % 3,
        '","type":"', kind, '","nullable":true},{"name":"price","type":"DECIMAL","precision":17,"scale":', seq % 5,
        '},{"name":"tags","type":"ARRAY","arraySubtype":{"type":"STRING"}}],"dataFrameReaderClass":"x.ParquetDataFrameReader"}',
    )
    log = d.event_log(spark, sf).where((F.col("status") == "COMMITTED") & (F.col("type") != "APPEND"))
    return log.select("rid", "branch", "seq", doc.alias("doc"))


_FIELDS = f"""{d.LOG}, s AS (SELECT rid, branch, seq FROM log WHERE {d.COMMITTED} AND type <> 'APPEND'),
fields AS (SELECT rid, branch, seq, 0 AS position, 'id' AS name, 'LONG' AS type, false AS nullable FROM s
  UNION ALL SELECT rid, branch, seq, 1, 'f' || (seq % 3),
    CASE seq % 4 WHEN 0 THEN 'STRING' WHEN 1 THEN 'DATE' ELSE 'DOUBLE' END, true FROM s
  UNION ALL SELECT rid, branch, seq, 2, 'price', 'DECIMAL(17,' || (seq % 5) || ')', true FROM s
  UNION ALL SELECT rid, branch, seq, 3, 'tags', 'ARRAY<STRING>', true FROM s)"""


@query(f"WITH {_FIELDS} SELECT rid, branch, seq, position, name, type, nullable FROM fields")
def schema_fields(spark, sf):
    return docs.flatten_documents(_schema_docs(spark, sf), "doc", ["rid", "branch", "seq"])


@query(f"""WITH {_FIELDS}, refs AS (SELECT rid, branch, seq AS ref_seq FROM log WHERE type = 'APPEND')
SELECT r.rid, r.branch, r.ref_seq, s.seq AS schema_seq,
  CASE WHEN s.seq IS NULL THEN NULL ELSE CAST(s.seq % 5 AS INT) END AS price_scale
FROM refs r ASOF LEFT JOIN s ON r.rid = s.rid AND r.branch = s.branch AND r.ref_seq >= s.seq""")
def schema_as_of(spark, sf):
    """The document in force at every append."""
    refs = d.event_log(spark, sf).where("type = 'APPEND'").select("rid", "branch", F.col("seq").alias("ref_seq"))
    found = docs.schema_as_of(_schema_docs(spark, sf), refs)
    scale = F.get_json_object("doc", "$.fieldSchemaList[2].scale").cast("int")
    return found.select("rid", "branch", "ref_seq", "schema_seq", scale.alias("price_scale"))


@query(f"""WITH {_FIELDS}, v AS (SELECT rid, branch, seq, lag(seq) OVER (PARTITION BY rid, branch ORDER BY seq) AS prev_seq FROM s),
n AS (SELECT v.rid, v.branch, v.seq, f.name, f.type FROM v JOIN fields f USING (rid, branch, seq) WHERE prev_seq IS NOT NULL),
o AS (SELECT v.rid, v.branch, v.seq, f.name, f.type FROM v JOIN fields f
  ON v.rid = f.rid AND v.branch = f.branch AND v.prev_seq = f.seq)
SELECT rid, branch, seq, name, o.type AS old_type, n.type AS new_type,
  CASE WHEN o.type IS NULL THEN 'ADDED' WHEN n.type IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change
FROM n FULL JOIN o USING (rid, branch, seq, name) WHERE o.type IS DISTINCT FROM n.type""")
def schema_diff(spark, sf):
    fields = docs.flatten_documents(_schema_docs(spark, sf), "doc", ["rid", "branch", "seq"])
    return docs.schema_changes(fields.select("rid", "branch", "seq", "name", "type"))


@query(f"""WITH {d.LOG}, c AS (SELECT rid, seq FROM log WHERE {d.COMMITTED})
SELECT rid, seq, 'ds' || (seq % 20) AS input_rid, CAST(floor(seq / 2) AS BIGINT) AS input_start, seq AS input_end FROM c
UNION ALL SELECT rid, seq, 'ds' || (seq % 7), NULL, seq - 1 FROM c""")
def provenance_edges(spark, sf):
    seq = F.col("seq")
    record = d.text(
        '{"provenanceRecords":[{"datasetRid":"ds', seq % 20, '","transactionRange":{"start":', F.floor(seq / 2),
        ',"end":', seq, '}},{"datasetRid":"ds', seq % 7, '","transactionRange":{"end":', seq - 1, "}}]}",
    )
    log = d.event_log(spark, sf).where("status = 'COMMITTED'").select("rid", "seq", record.alias("provenance"))
    return transactions.provenance_edges(log)
