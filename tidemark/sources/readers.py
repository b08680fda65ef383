"""Readers driven by schema documents, and typing of rows that arrive as text."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import DatasetHasNoFilesError
from tidemark.session import fresh_dir
from tidemark.sources import schema as docs
from tidemark.sources.records import csv_records

# Folder names of a written version: as partitions they let one scan cover many transactions.
TRANSACTION_FOLDER, TOP_FOLDER = "__txn", "__folder"
INTERNAL_FOLDERS = (TRANSACTION_FOLDER, TOP_FOLDER)


def read_files(
    spark: SparkSession,
    paths: list[str],
    doc: dict | None = None,
    *,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    base_path: str | None = None,
) -> DataFrame:
    """Scan files or folders; with a document its schema, format and options are used and nothing is inferred.

    ``base_path`` keeps hive partition folders below it as columns. Partition columns named in the document keep
    its types; filters and column choices go down to the scan as for any Spark file source.
    """
    if not paths:
        raise DatasetHasNoFilesError("there are no files to read")
    reader = spark.read
    if doc is not None:
        fmt = docs.reader_format(doc)
        options = {**docs.reader_options(doc), **(options or {})}
        schema = docs.to_struct_type(doc)
        jagged = docs.jagged_mode(doc) if fmt == "csv" else None
        late = _typed_late(spark, paths, schema, doc, base_path, jagged is not None) if fmt == "csv" else []
        fields = options
        if late and options.get("mode", "").upper() == "DROPMALFORMED":
            raise ValueError(f"mode DROPMALFORMED does not go with null texts of the columns {late}")
        if jagged:  # as all fields are read as text, the mode is about their number alone
            if jagged == "DROPMALFORMED" and docs.skipped_lines(doc) > 1:
                raise ValueError("jagged rows cannot be dropped below several skipped lines")
            options = {**options, "mode": jagged, "columnPruning": "false"}
        read_as = T.StructType([T.StructField(f.name, T.StringType()) if f.name in late else f for f in schema])
        reader = reader.schema(read_as)
    elif fmt == "csv":
        options = {"inferSchema": "true", "header": "true", **(options or {})}
    if base_path:
        reader = reader.option("basePath", base_path)
    spanning = doc is not None and fmt == "csv" and options.get("multiline") == "true" and options.get("mode", "").upper() != "DROPMALFORMED"
    if spanning or doc is not None and fmt == "csv" and docs.skipped_lines(doc) > 1:
        frame = _by_records(spark, paths, docs.skipped_lines(doc), read_as, options, base_path)
    else:
        frame = reader.format(fmt).options(**(options or {})).load(paths)
    if doc is None:
        return frame
    frame = _with_nulls(frame, docs.null_values(doc))
    return frame.withColumns({n: _parsed(F.col(f"`{n}`"), schema[n].dataType, fields) for n in late}) if late else frame


def _typed_late(spark: SparkSession, paths: list[str], schema: T.StructType, doc: dict, base_path: str | None, every: bool) -> list[str]:
    """Columns of CSV files, other than strings, with further null texts (or ``every`` one): these are replaced before the text is parsed.

    Not those that partition folders give.
    """
    nulls = docs.null_values(doc)
    found = [f.name for f in schema if not isinstance(f.dataType, T.StringType) and (every or None in nulls or f.name in nulls)]
    if not found:
        return []
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    folders = set(reader.text(paths).columns[1:])
    return [n for n in found if n not in folders]


def _parsed(column: Column, kind: T.DataType, options: dict) -> Column:
    """A field's text as a value of ``kind``, by the rules of Spark's CSV reader and its options."""
    unfit = ("header", "lineSep", "encoding", "sep", "delimiter", "quote", "escape", "comment", "multiline")
    parse = {k: v for k, v in options.items() if k not in unfit} | {"sep": "\x01", "quote": ""}
    value = F.from_csv(column, f"v {kind.simpleString()}", parse).getField("v")
    return F.when(~column.rlike("[\x01\r\n]"), value)


def _by_records(spark: SparkSession, paths: list[str], skip: int, schema: T.StructType, options: dict, base_path: str | None) -> DataFrame:
    """CSV records as Spark parses them, for files that its own reader reads by one task each (records with line breaks) or not at
    all: it skips one line at most. A single skipped line is a header, which may be a record of several lines.

    In files of plain lines the lines of a file's first split are numbered in order, so the least number per file tells which
    to leave out.
    """
    charset, spanning = options.get("encoding", "UTF-8"), options.get("multiline") == "true"
    if spanning or charset.upper() not in ("UTF-8", "UTF8", "US-ASCII"):
        quote, escape = options.get("quote", '"'), options.get("escape", "\\")
        kept = csv_records(
            spark, paths, delimiter=options.get("sep", ","), quote=quote, escape=escape, charset=charset, base_path=base_path,
            line_end=options.get("lineSep", "\n"), skip=skip if skip > 1 else 0, spanning=spanning,
        )
        folders = [n for n in kept.columns if n in schema.names and n != "value" and not n.startswith("__")]
        if skip == 1:
            kept = kept.where("NOT __leading")
    else:
        reader = spark.read.option("basePath", base_path) if base_path else spark.read
        reader = reader.option("lineSep", options["lineSep"]) if "lineSep" in options else reader
        lines = reader.text(paths).withColumns(
            {"__file": F.col("_metadata.file_path"), "__start": F.col("_metadata.file_block_start"), "__line": F.monotonically_increasing_id()}
        )
        folders = [n for n in lines.columns if n in schema.names and n != "value"]
        heads = lines.where("__start = 0").groupBy("__file").agg((F.min("__line") + skip).alias("__first"))
        kept = lines.join(heads, "__file").where((F.col("__start") > 0) | (F.col("__line") >= F.col("__first")))
        kept = kept.where(F.trim("value") != "")
    place = {f.name: f"c{i}" for i, f in enumerate(f for f in schema if f.name not in folders)}
    own = ", ".join(f"{at} {schema[n].dataType.simpleString()}" for n, at in place.items())
    parse = {k: v for k, v in options.items() if k not in ("header", "lineSep", "encoding", "columnPruning")}
    parsed = kept.select(F.from_csv("value", own, parse).alias("r"), *[F.col(f"`{n}`").cast(schema[n].dataType) for n in folders])
    return parsed.select(*[F.col(f"`{n}`") if n in folders else F.col("r").getField(place[n]).alias(n) for n in schema.names])


def _with_nulls(frame: DataFrame, nulls: dict[str | None, list[str]]) -> DataFrame:
    """Further texts that stand for null: of all columns (under None) and of single ones. Spark's reader knows one."""
    if not nulls:
        return frame
    changed = {}
    for field in frame.schema:
        texts = [*nulls.get(None, []), *nulls.get(field.name, [])]
        if texts and isinstance(field.dataType, T.StringType):
            column = F.col(f"`{field.name}`")
            changed[field.name] = F.when(~column.isin(texts), column)
    return frame.withColumns(changed)


def partition_layout(uri: Column) -> tuple[Column, Column]:
    """(base, names) of a file's hive partition folders, both empty when it lies in none.

    The run of ``name=value`` folders nearest to the file counts, plain folders between it and the file aside;
    files with equal base and names can be read by one scan.
    """
    run, plain = r"((?:/[^/=]+=[^/]*)+)", r"(?:/[^/=]+)*/[^/]+$"
    base = F.regexp_extract(uri, rf"^(.*?){run}{plain}", 1)
    names = F.regexp_replace(F.regexp_extract(uri, rf"{run}{plain}", 1), "=[^/]*", "")
    return base, names


def scan_located(spark: SparkSession, located: list[tuple[str, str, str]], doc: dict | None = None, **kwargs) -> DataFrame:
    """One frame of files given as (base, names, location): a scan per partition layout, put together by name."""
    layouts: dict[tuple[str, str], list[str]] = {}
    for base, names, location in located:
        layouts.setdefault((base, names), []).append(location)
    if not layouts:
        raise DatasetHasNoFilesError("there are no files to read")
    frames = [read_files(spark, paths, doc, base_path=base or None, **kwargs) for (base, _), paths in layouts.items()]
    if doc is not None:
        frames = [f.select(*[F.col(f"`{c['name']}`") for c in doc["fieldSchemaList"]]) for f in frames]
    else:
        frames = [f.drop(*INTERNAL_FOLDERS) for f in frames]
    return reduce(DataFrame.unionByName, frames)


def read_preferring_parquet(
    spark: SparkSession, files: DataFrame, *, path: str = "path", uri: str = "physical", csv_options: dict | None = None
) -> DataFrame:
    """All parquet files of a manifest as one frame, or its CSV files when it has no parquet file."""
    listed = files.where(F.col(path).endswith(".parquet") | F.col(path).endswith(".csv")).select(path, uri)
    # a file list goes through the driver for any Spark file source; no file content does
    base, names = partition_layout(F.col(uri))
    rows = listed.select(path, base, names, uri).collect()
    parquet = [tuple(r)[1:] for r in rows if r[path].endswith(".parquet")]
    if parquet:
        return scan_located(spark, parquet)
    return scan_located(spark, [tuple(r)[1:] for r in rows], fmt="csv", options=csv_options)


def read_binary(spark: SparkSession, paths: list[str], glob: str | None = None) -> DataFrame:
    """Files as rows (path, modificationTime, length, content); content is only read when selected."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths)


def _typed(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.to_timestamp(column)
    if isinstance(kind, T.DateType):
        return F.to_date(column)
    return column if isinstance(kind, T.StringType) else column.cast(kind)


def cast_text_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give text columns the types of ``schema`` (by position): instants, dates, decimals, NaN and all.

    Columns that are not text, such as nested ones, are passed on.
    """
    return df.select(
        *[
            (_typed(F.col(f"`{have.name}`"), want.dataType) if isinstance(have.dataType, T.StringType) else F.col(f"`{have.name}`")).alias(want.name)
            for have, want in zip(df.schema, schema, strict=True)
        ]
    )


def from_rows(spark: SparkSession, rows: list[list], schema: T.StructType) -> DataFrame:
    """Frame of a JSON row matrix whose instants, dates and decimals are text."""
    nested = [isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in schema]
    staged = T.StructType(
        [f if keep else T.StructField(f.name, T.StringType(), True) for f, keep in zip(schema, nested, strict=True)]
    )
    as_text = [[v if keep or v is None else _text(v) for v, keep in zip(row, nested, strict=True)] for row in rows]
    return cast_text_rows(spark.createDataFrame(as_text, staged), schema)


def _text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def from_arrow(spark: SparkSession, table) -> DataFrame:
    """Frame of an Arrow table, record batch reader or stream (bytes)."""
    import pyarrow as pa

    if isinstance(table, (bytes, bytearray)):
        table = pa.ipc.open_stream(table)
    if isinstance(table, pa.RecordBatchReader):
        table = table.read_all()
    return spark.createDataFrame(table)


SEPARATORS = ",;\t|"


def _separator_counts(records: DataFrame) -> tuple[list[dict], bool, bool]:
    """Per candidate separator the least, largest and total number in a record, over all records; whether there is any
    record, and whether quotes match up. One aggregate; what stands in quotes does not count."""
    plain = F.replace(F.regexp_replace("value", r"(?s)\\.", ""), F.lit('""'), F.lit(""))
    bare = F.regexp_replace(plain, '"[^"]*"', "")
    counts = [F.length(bare) - F.length(F.replace(bare, F.lit(s), F.lit(""))) for s in SEPARATORS]
    columns = [f(c).alias(f"{n}{i}") for i, c in enumerate(counts) for n, f in (("low", F.min), ("high", F.max), ("total", F.sum))]
    row = records.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.contains(bare, F.lit('"'))).alias("odd"), *columns).first()
    found = [{"separator": s, **{n: row[f"{n}{i}"] for n in ("low", "high", "total")}} for i, s in enumerate(SEPARATORS)]
    return found, row["n"] > 0, not row["odd"]


def infer_schema(spark: SparkSession, paths: list[str], fmt: str) -> dict:
    """Schema document of existing files.

    Parquet states its schema. JSON and CSV are inferred by Spark over all records. For CSV the delimiter is the
    most frequent one, those first that every record holds equally often; a warning is given when records differ in their
    number of fields, and ValueError is raised when nothing can be inferred.
    """
    if fmt == "parquet":
        return docs.to_document(spark.read.parquet(*paths).drop(*INTERNAL_FOLDERS).schema)
    if fmt == "json":
        return docs.to_document(spark.read.json(paths).schema, "json")
    if fmt != "csv":
        raise ValueError(f"cannot infer a schema for {fmt} files")
    lines = spark.read.text(paths).where(F.trim("value") != "")
    counts, filled, matched = _separator_counts(lines)
    if not filled:
        raise ValueError("cannot infer a schema: the files are empty")
    spanning = not matched
    if spanning:  # a quote stays open at the end of some line: look at records that may hold line breaks
        counts, _, matched = _separator_counts(csv_records(spark, paths, delimiter=list(SEPARATORS)))
    best = max(counts, key=lambda c: (c["low"] == c["high"] > 0, c["total"], -SEPARATORS.index(c["separator"])))
    separator = best["separator"]
    if best["low"] < best["high"] or not matched:
        warnings.warn(f"ambiguous CSV: records have {best['low'] + 1} to {best['high'] + 1} fields with separator {separator!r}", stacklevel=2)
    if spanning and matched:
        schema = _types_of_records(spark, csv_records(spark, paths, delimiter=separator), separator)
    else:
        schema, spanning = spark.read.options(header="true", inferSchema="true", sep=separator).csv(paths).schema, False
    if not schema:
        raise ValueError("cannot infer a schema: no columns found")
    parser = {"parser": docs.MULTILINE_PARSER} if spanning else {}
    return docs.to_document(schema, "csv", text_parser={"fieldDelimiter": separator, "quoteCharacter": '"', **parser})


def _types_of_records(spark: SparkSession, records: DataFrame, separator: str) -> T.StructType:
    """The types Spark infers from all records, in as many tasks as there are parts, under the names of the first header.

    Records are written a line each, which changes no type: a value with a line break is a string, and one with a space
    in its place is too.
    """
    folder = fresh_dir(spark, "records")
    records.where("NOT __leading").select(F.regexp_replace("value", "[\r\n]+", " ").alias("value")).write.text(folder)
    kinds = spark.read.options(inferSchema="true", sep=separator).csv(folder).schema
    header = records.where("__leading").orderBy("__file").first()["value"]
    names = spark.range(1).select(F.from_csv(F.lit(header), ", ".join(f"c{i} string" for i in range(len(kinds) or 1)), {"sep": separator, "multiLine": "true"}).alias("h"))
    names = list(names.select("h.*").first())
    return T.StructType([T.StructField(name or f"_c{i}", f.dataType) for i, (name, f) in enumerate(zip(names, kinds, strict=True))])
