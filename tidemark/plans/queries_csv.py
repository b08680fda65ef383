"""Queries on CSV files that are hard to read: line breaks in quotes, lines above the records, many null texts, late surprises."""

from __future__ import annotations

import warnings

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.plans import derived as d
from tidemark.plans.registry import query
from tidemark.session import fresh_dir
from tidemark.sources import readers, writers
from tidemark.sources import schema as docs

DOCUMENTS = "SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), ' ') AS text, lang, source, n_chars FROM documents"


def _documents(spark, sf):
    text = F.regexp_replace(F.regexp_replace("text", "\r\n", "\n"), "\r", " ")
    return d.table(spark, sf, "documents").select("doc_id", text.alias("text"), "lang", "source", "n_chars")


def _above(lines: list[str]):
    """Puts lines above the rows of each part, so above the rows of each file written."""

    def run(batches):
        top = True
        for batch in batches:
            if top:
                yield pa.RecordBatch.from_arrays([pa.array(lines, batch.schema.field(0).type)], schema=batch.schema)
            top = False
            yield batch

    return run


@query(DOCUMENTS)
def csv_quoted_lines(spark, sf):
    """Texts with line breaks, quotes and delimiters as CSV; the document that reads them is inferred from the files."""
    rows = _documents(spark, sf)
    target = fresh_dir(spark, "quoted-lines")
    rows.write.options(header="true", sep=";", quoteAll="true").csv(target)
    doc = readers.infer_schema(spark, [target], "csv")
    return readers.read_files(spark, [target], doc).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in rows.schema])


@query(DOCUMENTS)
def csv_skipped_lines(spark, sf):
    """The same in another charset, below three lines of which one has a quote that is never closed."""
    rows = _documents(spark, sf)
    options = {"sep": ";", "quoteAll": "true"}
    line = rows.select(F.to_csv(F.struct(*rows.columns), options).alias("value"))
    above = line.mapInArrow(_above(["# exported", '# "open', ";".join(rows.columns)]), "value string")
    target = fresh_dir(spark, "skipped-lines")
    above.select(F.encode("value", "ISO-8859-1").cast("string").alias("value")).write.text(target)
    parser = {"parser": docs.MULTILINE_PARSER, "skipLines": 3, "fieldDelimiter": ";", "quoteCharacter": '"', "charsetName": "ISO-8859-1"}
    return readers.read_files(spark, [target], docs.to_document(rows.schema, "csv", text_parser=parser))


NULLS = ["", "n/a", "-1", "1-URGENT"]


@query("""SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS customer,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price, nullif(o_orderpriority, '1-URGENT') AS priority FROM orders""")
def csv_many_nulls(spark, sf):
    """Four texts that mean null in all columns, of all types, and one more in a single column."""
    orders, key = d.table(spark, sf, "orders"), F.col("o_orderkey")
    rows = orders.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.when(key % 7 != 0, F.col("o_custkey").cast("string")).otherwise("n/a").alias("customer"),
        F.when(key % 5 != 0, F.col("o_totalprice").cast("string")).otherwise("-1").alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )
    target = fresh_dir(spark, "many-nulls")
    writers.export_csv(rows, target, sep="|")
    kinds = orders.select("o_orderkey", *[F.col(f"o_{was}").alias(c) for c, was in (("status", "orderstatus"), ("customer", "custkey"), ("price", "totalprice"), ("priority", "orderpriority"))]).schema
    parser = {"fieldDelimiter": "|", "nullValues": NULLS, "nullValuesPerColumn": {"status": ["P"]}}
    return readers.read_files(spark, [target], docs.to_document(kinds, "csv", text_parser=parser))


@query("""SELECT * FROM (VALUES (0, 'o_orderkey', 'INTEGER', true), (1, 'o_custkey', 'INTEGER', true), (2, 'o_orderstatus', 'STRING', true))
v(position, name, type, ambiguous) WHERE (SELECT count(*) FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)) = 1""")
def csv_ambiguous_late(spark, sf):
    """All records have three fields but the last one, which has four: the inference has to see them all to warn."""
    orders = d.table(spark, sf, "orders")
    last = F.col("o_orderkey") == orders.agg(F.max("o_orderkey")).scalar()
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", F.when(last, "more"))
    target = fresh_dir(spark, "late")
    header = ["o_orderkey,o_custkey,o_orderstatus"]
    orders.select(line.alias("value")).mapInArrow(_above(header), "value string").write.text(target)
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        doc = readers.infer_schema(spark, [target], "csv")
    warned = any("ambiguous" in str(w.message) for w in seen)
    rows = [(i, f["name"], f["type"], warned) for i, f in enumerate(doc["fieldSchemaList"])]
    return spark.createDataFrame(rows, "position int, name string, type string, ambiguous boolean")
