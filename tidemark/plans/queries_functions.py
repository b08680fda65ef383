"""Queries on scalar functions and nested types."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.plans import derived as d
from tidemark.plans.registry import query


@query("""SELECT p_partkey, p_type || 'Name' || replace(p_brand, '#', 'No') AS camel,
  lower(left(p_type, 1) || regexp_replace(substr(p_type || 'Name' || replace(p_brand, '#', 'No'), 2), '([A-Z])', '_\\1', 'g'))
  AS snake FROM part""")
def decamelize(spark, sf):
    camel = d.text(F.col("p_type"), "Name", F.replace(F.col("p_brand"), F.lit("#"), F.lit("No")))
    return d.table(spark, sf, "part").select("p_partkey", camel.alias("camel"), fn.decamelize(camel).alias("snake"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 1 THEN ts - INTERVAL 2 HOUR
  WHEN event_id % 3 = 2 THEN date_trunc('second', ts) ELSE ts END AS parsed FROM events""")
def parse_iso(spark, sf):
    """Instants with nanoseconds and Z, with an offset, and without a fraction."""
    number, micros = F.col("event_id") % 3, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    iso = (
        F.when(number == 0, d.text(F.date_format("ts", micros), "789Z"))
        .when(number == 1, d.text(F.date_format("ts", micros), "+02:00"))
        .otherwise(d.text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "Z"))
    )
    parsed = F.convert_timezone(F.current_timezone(), F.lit("UTC"), fn.parse_iso(iso).cast("timestamp_ntz"))
    return d.table(spark, sf, "events").select("event_id", parsed.alias("parsed"))


@query("""SELECT event_id, event_id % 5 = 0 AS is_view FROM events""")
def is_view(spark, sf):
    """Records with the flag true, false, absent, as a string, and no JSON at all."""
    number = F.col("event_id") % 5
    record = (
        F.when(number == 0, d.text('{"view":true,"props":', F.col("props"), "}"))
        .when(number == 1, '{"view":false}')
        .when(number == 2, F.col("props"))
        .when(number == 3, '{"view":"true"}')
        .otherwise(F.col("event_type"))
    )
    return d.table(spark, sf, "events").select("event_id", fn.is_view(record).alias("is_view"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'dataset' WHEN 1 THEN 'folder' WHEN 2 THEN 'transaction' END AS kind,
  event_id % 4 = 0 AS is_dataset FROM events""")
def rid_kind(spark, sf):
    number = F.col("event_id") % 4
    ref = (
        F.when(number == 0, d.text("ri.catalog.main.dataset.", F.col("event_id")))
        .when(number == 1, d.text("ri.names..folder.", F.col("event_id")))
        .when(number == 2, d.text("ri.catalog.main.transaction.", F.col("event_id")))
        .otherwise(d.text("/path/ri.main/", F.col("event_id")))
    )
    return d.table(spark, sf, "events").select("event_id", fn.rid_kind(ref).alias("kind"), fn.is_dataset_rid(ref).alias("is_dataset"))


@query("""SELECT page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS dataset,
  CASE WHEN contains(regexp_replace(url, '^https?://', ''), '/') THEN
    substr(regexp_replace(url, '^https?://', ''), strpos(regexp_replace(url, '^https?://', ''), '/') + 1) ELSE '' END AS path,
  list_extract(string_split(url, '/'), -1) AS base FROM pages""")
def route_object_keys(spark, sf):
    dataset, path = fn.route_key(F.regexp_replace("url", "^https?://", ""))
    return d.table(spark, sf, "pages").select(
        "page_id", dataset.alias("dataset"), path.alias("path"), fn.basename(F.col("url")).alias("base")
    )


@query("""SELECT event_id, greatest(1, least(500, CAST(floor(value * 20) AS BIGINT) - 40)) AS page_size FROM events""")
def page_clamp(spark, sf):
    size = F.floor(F.col("value") * 20).cast("bigint") - 40
    return d.table(spark, sf, "events").select("event_id", fn.clamp(size, 1, 500).alias("page_size"))


def log_lines(events):
    """Lines of four kinds: structured, structured with a stack trace, JSON without the keys, and plain text."""
    number = F.col("event_id")
    head = d.text(
        '{"level":"', F.when(number % 8 == 1, "INFO").when(number % 8 == 5, "ODD").otherwise("WARN"), '","origin":"job.',
        F.col("user_id"), '","message":"took %s of \\"%s\\"","time":"', F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        'Z","unsafeParams":{"param_0":', number, ',"other":1,"param_1":"', F.col("event_type"), '","exception_message":"boom ', number, '"}',
    )
    trace = ',"stacktrace":"first {exception_message}\\\\n\\\\u0041t \\\\x42"'
    return (
        F.when(number % 4 == 0, d.text("plain line ", F.col("props")))
        .when(number % 4 == 3, F.col("props"))
        .when(number % 4 == 2, d.text(head, trace, "}"))
        .otherwise(d.text(head, "}"))
    )


PARSED_LINES = """SELECT event_id, CASE WHEN event_id % 4 IN (0, 3) THEN 'INFO' WHEN event_id % 8 = 1 THEN 'INFO'
    WHEN event_id % 8 = 5 THEN 'ERROR' ELSE 'WARN' END AS level,
  CASE WHEN event_id % 4 IN (0, 3) THEN '' ELSE 'job.' || user_id END AS origin,
  CASE WHEN event_id % 4 IN (0, 3) THEN NULL ELSE ts END AS time,
  CASE WHEN event_id % 4 = 0 THEN 'plain line ' || props WHEN event_id % 4 = 3 THEN props
    ELSE 'took %s of "%s"' END AS message,
  CASE WHEN event_id % 4 IN (0, 3) THEN '' ELSE event_id || '|' || event_type END AS args,
  CASE WHEN event_id % 4 = 2 THEN 'first boom ' || event_id || chr(10) || 'At B' END AS stacktrace FROM events"""


def flat_lines(df):
    """Parsed lines as plain columns, times without a zone."""
    time = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("time").cast("timestamp_ntz"))
    return df.withColumn("time", time).withColumn("args", F.array_join("args", "|"))


@query(PARSED_LINES)
def parse_log_lines(spark, sf):
    events = d.table(spark, sf, "events")
    return flat_lines(fn.parse_log_lines(events.select("event_id", log_lines(events).alias("line")), "line", keep=["event_id"]))


@query("""SELECT conv_id, turn, CAST(unnest(range(len(l))) AS INT) AS line_no, unnest(l) AS line FROM
  (SELECT conv_id, turn, regexp_split_to_array(text, '\\r\\n|[\\n\\r]') AS l FROM conversations) x""")
def explode_log_lines(spark, sf):
    return fn.explode_lines(d.table(spark, sf, "conversations"), "text", keep=["conv_id", "turn"])


@query("""SELECT l_orderkey, l_linenumber, u.name, u.cents, m.v AS tax FROM (SELECT *, unnest([
    {'name': 'price', 'cents': CAST(floor(l_extendedprice * 100) AS BIGINT)},
    {'name': 'quantity', 'cents': CAST(floor(l_quantity * 100) AS BIGINT)}]) AS u FROM lineitem) x,
  LATERAL (SELECT l_tax AS v) m""")
def nested_explode(spark, sf):
    """An array of structs per line, exploded, next to a map looked up by key."""
    cents = lambda name: F.floor(F.col(name) * 100).cast("bigint")
    measures = F.array(
        F.struct(F.lit("price").alias("name"), cents("l_extendedprice").alias("cents")),
        F.struct(F.lit("quantity").alias("name"), cents("l_quantity").alias("cents")),
    )
    nested = d.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", measures.alias("measures"), F.create_map(F.lit("tax"), "l_tax").alias("rates")
    )
    return nested.select(
        "l_orderkey", "l_linenumber", F.inline("measures"), F.element_at("rates", "tax").alias("tax")
    )
