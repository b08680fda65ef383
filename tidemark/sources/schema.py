"""Schema documents: conversion to and from Spark schemas, reader formats and options, comparison.

A document lists fields as dictionaries:

    {"fieldSchemaList": [{"name", "type", "nullable", "customMetadata", ...}],
     "dataFrameReaderClass": "...ParquetDataFrameReader", "customMetadata": {"format": "parquet", ...}}

DECIMAL adds precision and scale, STRUCT adds subSchemas, ARRAY adds arraySubtype, MAP adds mapKeyType and
mapValueType. The package in front of a reader class is not looked at.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.asof import latest_before
from tidemark.session import materialize

# Document type names and their Spark types.
PLAIN_TYPES = {
    "BOOLEAN": T.BooleanType(),
    "BINARY": T.BinaryType(),
    "BYTE": T.ByteType(),
    "SHORT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}

# Reader class endings, and the format of each ("data source" readers name theirs in the document).
PARQUET_READER = "ParquetDataFrameReader"
TEXT_READER = "TextDataFrameReader"
AVRO_READER = "AvroDataFrameReader"
DATA_SOURCE_READER = "DataSourceDataFrameReader"

# Fixed value: the parser name of CSV files whose records span lines.
MULTILINE_PARSER = "MULTILINE_CSV_PARSER"


def to_struct_type(doc: dict) -> T.StructType:
    """Spark schema of a document."""
    return _struct(doc["fieldSchemaList"])


def _struct(fields: list[dict]) -> T.StructType:
    return T.StructType(
        [
            T.StructField(f.get("name") or "", _data_type(f), _nullable(f), dict(f.get("customMetadata") or {}))
            for f in fields
        ]
    )


def _nullable(field: dict) -> bool:
    return True if field.get("nullable") is None else field["nullable"]


def _data_type(field: dict) -> T.DataType:
    kind = field["type"].upper()
    if kind == "DECIMAL":
        return T.DecimalType(field["precision"], field["scale"])
    if kind == "STRUCT":
        return _struct(field["subSchemas"])
    if kind == "ARRAY":
        return T.ArrayType(_data_type(field["arraySubtype"]), _nullable(field["arraySubtype"]))
    if kind == "MAP":
        value = field["mapValueType"]
        return T.MapType(_data_type(field["mapKeyType"]), _data_type(value), _nullable(value))
    return PLAIN_TYPES[kind]


def to_document(
    schema: T.StructType, file_format: str = "parquet", *, text_parser: dict | None = None, reader_package: str = ""
) -> dict:
    """Document of a Spark schema for files of the given format.

    ``text_parser`` adds textParserParams for csv; ``reader_package`` goes in front of the reader class.
    """
    prefix = f"{reader_package}." if reader_package else ""
    if file_format == "parquet":
        reader, custom = PARQUET_READER, {"format": "parquet"}
    elif file_format == "csv":
        reader, custom = TEXT_READER, {"textParserParams": {"parser": "CSV_PARSER", "skipLines": 1, **(text_parser or {})}}
    elif file_format in ("json", "avro"):
        reader, custom = DATA_SOURCE_READER, {"format": file_format}
    else:
        raise NotImplementedError(f"no reader class for {file_format}")
    return {
        "fieldSchemaList": [_field(f.name, f.dataType, f.nullable, f.metadata) for f in schema],
        "dataFrameReaderClass": prefix + reader,
        "customMetadata": custom,
    }


def _field(name: str | None, kind: T.DataType, nullable: bool, metadata: dict | None = None) -> dict:
    field: dict = {"nullable": nullable, "customMetadata": dict(metadata or {})}
    if name is not None:
        field["name"] = name
    if isinstance(kind, T.DecimalType):
        return {"type": "DECIMAL", "precision": kind.precision, "scale": kind.scale, **field}
    if isinstance(kind, T.StructType):
        subs = [_field(f.name, f.dataType, f.nullable, f.metadata) for f in kind]
        return {"type": "STRUCT", "subSchemas": subs, **field}
    if isinstance(kind, T.ArrayType):
        return {"type": "ARRAY", "arraySubtype": _field(None, kind.elementType, kind.containsNull), **field}
    if isinstance(kind, T.MapType):
        return {
            "type": "MAP",
            "mapKeyType": _field(None, kind.keyType, False),
            "mapValueType": _field(None, kind.valueType, kind.valueContainsNull),
            **field,
        }
    for type_name, spark_type in PLAIN_TYPES.items():
        if kind == spark_type or (type_name == "STRING" and isinstance(kind, T.StringType)):
            return {"type": type_name, **field}
    raise ValueError(f"column {name}: no document type for {kind.simpleString()}")


def reader_format(doc: dict) -> str:
    """parquet, csv, avro or json."""
    reader = doc["dataFrameReaderClass"]
    if PARQUET_READER in reader:
        return "parquet"
    if TEXT_READER in reader:
        return "csv"
    if AVRO_READER in reader:
        return "avro"
    if DATA_SOURCE_READER in reader and (doc.get("customMetadata") or {}).get("format") in ("avro", "json"):
        return doc["customMetadata"]["format"]
    raise ValueError(f"no reader format for {reader!r} with {doc.get('customMetadata')!r}")


def reader_options(doc: dict) -> dict[str, str]:
    """Spark reader options from the text parser settings of a document."""
    params = (doc.get("customMetadata") or {}).get("textParserParams") or {}
    options = {}
    if params.get("parser") == MULTILINE_PARSER:
        options["multiline"] = "true"
    if skipped_lines(doc) == 1:
        options["header"] = "true"
    if params.get("recordDelimiter"):
        options["lineSep"] = params["recordDelimiter"]
    for key, option in (("fieldDelimiter", "sep"), ("quoteCharacter", "quote"), ("charsetName", "encoding")):
        if params.get(key):
            options[option] = params[key]
    if params.get("nullValues"):
        options["nullValue"] = params["nullValues"][0]
    formats = {f for per_column in (params.get("dateFormat") or {}).values() for f in per_column}
    if len(formats) > 1:
        raise ValueError(f"a Spark reader takes one date format, not {sorted(formats)}")
    if formats:
        options["dateFormat"] = formats.pop()
    return options


def skipped_lines(doc: dict) -> int:
    """Lines at the start of each file that are no records."""
    params = (doc.get("customMetadata") or {}).get("textParserParams") or {}
    return max(0, params.get("skipLines") or 0)


def null_values(doc: dict) -> dict[str | None, list[str]]:
    """Texts that stand for null: under None those of all columns, but for the first, which is a reader option."""
    params = (doc.get("customMetadata") or {}).get("textParserParams") or {}
    found: dict[str | None, list[str]] = {None: list(params.get("nullValues") or [])[1:]}
    for column, texts in (params.get("nullValuesPerColumn") or {}).items():
        found[column] = list(texts)
    return {k: v for k, v in found.items() if v}


def jagged_mode(doc: dict) -> str | None:
    """The mode of Spark's CSV reader for records with more or fewer fields than the document; None where it says nothing."""
    params = (doc.get("customMetadata") or {}).get("textParserParams") or {}
    modes = {None: None, "THROW_EXCEPTION": "FAILFAST", "DROP_ROW": "DROPMALFORMED"}
    behavior = params.get("jaggedRowBehavior") or None
    if behavior not in modes:
        raise ValueError(f"unknown jaggedRowBehavior {behavior!r}")
    return modes[behavior]


def load_sidecar(text: str) -> tuple[T.StructType, dict[str, str]]:
    """(schema, options) of a schema file: a document, or a bare Spark schema whose CSV files have a header."""
    parsed = json.loads(text)
    if "fieldSchemaList" in parsed:
        return to_struct_type(parsed), reader_options(parsed)
    return T.StructType.fromJson(parsed), {"header": "true"}


def infer_format(reader_class: Column, first_file: Column) -> Column:
    """Per dataset: the reader class decides, else the name of its first file, else unknown."""
    return (
        F.when(F.contains(reader_class, F.lit(PARQUET_READER)), "parquet")
        .when(F.contains(reader_class, F.lit(TEXT_READER)), "csv")
        .when(F.contains(first_file, F.lit("csv")), "csv")
        .when(F.contains(first_file, F.lit("parquet")), "parquet")
        .otherwise("unknown")
    )


def spelled_type(field: dict) -> str:
    """The type of a document's field in one text, e.g. DECIMAL(17,2), ARRAY<STRING> or STRUCT<a:MAP<STRING,LONG>>."""
    kind = field["type"]
    match kind.upper():
        case "DECIMAL":
            return f"DECIMAL({field['precision']},{field['scale']})"
        case "ARRAY":
            return f"ARRAY<{spelled_type(field['arraySubtype'])}>"
        case "MAP":
            return f"MAP<{spelled_type(field['mapKeyType'])},{spelled_type(field['mapValueType'])}>"
        case "STRUCT":
            return f"STRUCT<{','.join(f'{sub["name"]}:{spelled_type(sub)}' for sub in field['subSchemas'])}>"
    return kind


def _document_fields(text: str | None) -> list[dict] | None:
    try:
        fields = json.loads(text)["fieldSchemaList"]
    except (TypeError, ValueError, KeyError):
        return None  # no document: no fields
    return [{"name": f["name"], "type": spelled_type(f), "nullable": _nullable(f)} for f in fields]


def flatten_documents(docs: DataFrame, doc: str, keys: list[str]) -> DataFrame:
    """One row per top-level field of each stored JSON document: keys, position, name, type, nullable.

    ``type`` is spelled out to any depth, see :func:`spelled_type`.
    """

    @F.pandas_udf("array<struct<name: string, type: string, nullable: boolean>>")
    def fields_of(texts: pd.Series) -> pd.Series:
        return texts.map(_document_fields, na_action=None)

    f = F.col("field")
    return docs.select(*keys, F.posexplode(fields_of(F.col(doc))).alias("position", "field")).select(
        *keys, "position", f["name"].alias("name"), f["type"].alias("type"), f["nullable"].alias("nullable")
    )


def schema_as_of(schemas: DataFrame, refs: DataFrame, doc: str = "doc") -> DataFrame:
    """For refs(rid, branch, ref_seq): the newest document put at or before ref_seq, or NULLs."""
    key = ["rid", "branch"]
    found = latest_before(refs, schemas, key, at="ref_seq", name="schema_seq")
    stored = schemas.select(*key, F.col("seq").alias("schema_seq"), doc)
    return found.join(stored, [*key, "schema_seq"], "left")


def schema_changes(fields: DataFrame) -> DataFrame:
    """Fields that differ between consecutive documents of a dataset: ADDED, REMOVED or CHANGED.

    ``fields`` has rid, branch, seq, name, type (see :func:`flatten_documents`). Every document is matched to its
    predecessor by number, so equi-joins on (rid, branch, seq, name) replace any pairing of documents.
    """
    key = ["rid", "branch"]
    fields, _ = materialize(fields.select(*key, "seq", "name", "type"), "fields")
    numbers = fields.select(*key, "seq").distinct()
    found = latest_before(numbers, numbers, key, at="seq", strict=True, name="prev_seq")
    versions, _ = materialize(found.where(F.col("prev_seq").isNotNull()), "versions")
    now = fields.join(versions, [*key, "seq"]).select(*key, "seq", "name", F.col("type").alias("new_type"))
    before = (
        fields.withColumnRenamed("seq", "prev_seq")
        .join(versions, [*key, "prev_seq"])
        .select(*key, "seq", "name", F.col("type").alias("old_type"))
    )
    kind = (
        F.when(F.col("old_type").isNull(), "ADDED").when(F.col("new_type").isNull(), "REMOVED").otherwise("CHANGED")
    )
    both = now.join(before, [*key, "seq", "name"], "full")
    return both.where(~F.col("new_type").eqNullSafe(F.col("old_type"))).withColumn("change", kind)
