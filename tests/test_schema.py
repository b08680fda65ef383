import json

import pytest
from pyspark.sql import types as T

from tidemark.sources import readers, schema


def field(name, kind, **extra):
    return {"name": name, "type": kind, "nullable": True, "customMetadata": {}, **extra}


NESTED = {
    "fieldSchemaList": [
        field("url", "STRUCT", subSchemas=[field("value", "STRING")]),
        field("key", "STRING"),
        field("attributes", "MAP", mapKeyType=field(None, "STRING", nullable=False), mapValueType=field(None, "INTEGER", nullable=False)),
        field("items", "ARRAY", arraySubtype=field(None, "STRUCT", subSchemas=[field("link", "STRING")])),
        field("price", "DECIMAL", precision=17, scale=2),
    ],
    "dataFrameReaderClass": "any.package.ParquetDataFrameReader",
    "customMetadata": {"format": "parquet", "options": {}},
}

NESTED_TYPE = T.StructType(
    [
        T.StructField("url", T.StructType([T.StructField("value", T.StringType())])),
        T.StructField("key", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.IntegerType(), False)),
        T.StructField("items", T.ArrayType(T.StructType([T.StructField("link", T.StringType())]))),
        T.StructField("price", T.DecimalType(17, 2)),
    ]
)


def test_nested_document_both_ways():
    assert schema.to_struct_type(NESTED) == NESTED_TYPE
    assert schema.to_struct_type(schema.to_document(NESTED_TYPE)) == NESTED_TYPE


@pytest.mark.parametrize("name", list(schema.PLAIN_TYPES))
def test_plain_types_both_ways(name):
    struct = schema.to_struct_type({"fieldSchemaList": [field("c", name)]})
    assert struct["c"].dataType == schema.PLAIN_TYPES[name]
    assert schema.to_document(struct)["fieldSchemaList"][0]["type"] == name


def test_nullability_defaults_to_true():
    fields = [
        {"name": "a", "type": "STRING", "nullable": None},
        {"name": "b", "type": "STRING"},
        {"name": "c", "type": "STRING", "nullable": False, "customMetadata": {"k": "v"}},
        {"name": "d", "type": "STRING", "nullable": True},
    ]
    struct = schema.to_struct_type({"fieldSchemaList": fields})
    assert [f.nullable for f in struct] == [True, True, False, True]
    assert struct["c"].metadata == {"k": "v"}


def test_array_document():
    doc = schema.to_document(T.StructType([T.StructField("names", T.ArrayType(T.StringType()))]), reader_package="my.readers")
    assert doc == {
        "fieldSchemaList": [
            {
                "type": "ARRAY",
                "name": "names",
                "nullable": True,
                "customMetadata": {},
                "arraySubtype": {"type": "STRING", "nullable": True, "customMetadata": {}},
            }
        ],
        "dataFrameReaderClass": "my.readers.ParquetDataFrameReader",
        "customMetadata": {"format": "parquet"},
    }


def test_reader_formats():
    def doc(reader, **custom):
        return {"dataFrameReaderClass": f"x.{reader}", "customMetadata": custom}

    assert schema.reader_format(doc("ParquetDataFrameReader")) == "parquet"
    assert schema.reader_format(doc("TextDataFrameReader")) == "csv"
    assert schema.reader_format(doc("AvroDataFrameReader")) == "avro"
    assert schema.reader_format(doc("DataSourceDataFrameReader", format="avro")) == "avro"
    assert schema.reader_format(doc("DataSourceDataFrameReader", format="json")) == "json"
    with pytest.raises(ValueError):
        schema.reader_format(doc("DataSourceDataFrameReader", format="orc"))


def test_reader_options():
    def options(**params):
        return schema.reader_options({"customMetadata": {"textParserParams": params}})

    assert options(parser="CSV_PARSER", skipLines=0) == {}
    assert options(parser="MULTILINE_CSV_PARSER", skipLines=1) == {"multiline": "true", "header": "true"}
    assert options(fieldDelimiter=";", nullValues=["NA"], dateFormat={"d": ["yyyy-MM-dd"]}) == {
        "sep": ";",
        "nullValue": "NA",
        "dateFormat": "yyyy-MM-dd",
    }
    assert schema.reader_options({"customMetadata": {}}) == {}


def test_unknown_formats_and_types_are_refused():
    with pytest.raises(NotImplementedError):
        schema.to_document(T.StructType([]), "orc")
    with pytest.raises(ValueError):
        schema.to_document(T.StructType([T.StructField("i", T.DayTimeIntervalType())]))


def test_sidecar_of_a_bare_schema_has_a_header():
    bare = T.StructType([T.StructField("a", T.LongType())])
    assert schema.load_sidecar(json.dumps(bare.jsonValue())) == (bare, {"header": "true"})
    assert schema.load_sidecar(json.dumps(NESTED))[0] == NESTED_TYPE


def test_rows_of_text_are_typed(spark):
    struct = T.StructType(
        [
            T.StructField("x", T.DoubleType()),
            T.StructField("d", T.DateType()),
            T.StructField("t", T.TimestampType()),
            T.StructField("p", T.DecimalType(5, 2)),
            T.StructField("b", T.BooleanType()),
            T.StructField("l", T.ArrayType(T.StringType())),
        ]
    )
    rows = [["NaN", "2020-01-28", "2020-01-28T10:00:00Z", "1.25", True, ["a"]], [1.0, None, None, None, None, None]]
    df = readers.from_rows(spark, rows, struct)
    first, second = df.collect()
    assert [f.dataType for f in df.schema] == [f.dataType for f in struct]
    assert first["x"] != first["x"] and str(first["d"]) == "2020-01-28" and str(first["p"]) == "1.25"
    assert first["b"] is True and first["l"] == ["a"] and second["x"] == 1.0


def test_multiline_csv_by_document(spark, tmp_path):
    text = ',Name,"Status\n(now)",Report_date\n0,"a, b","line one\n line two",2020-01-28\n'
    (tmp_path / "manual.csv").write_text(text)
    doc = {
        "fieldSchemaList": [field("n", "INTEGER"), field("Name", "STRING"), field("Status", "STRING"), field("Report_date", "DATE")],
        "dataFrameReaderClass": "x.TextDataFrameReader",
        "customMetadata": {"textParserParams": {"parser": "MULTILINE_CSV_PARSER", "skipLines": 2, "quoteCharacter": '"'}},
    }
    (row,) = readers.read_files(spark, [str(tmp_path)], doc).collect()
    assert (row["n"], row["Name"], row["Status"], str(row["Report_date"])) == (0, "a, b", "line one\n line two", "2020-01-28")


def test_inference_warns_about_ambiguous_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('col1,co"""l2\n1,2,3\n')
    with pytest.warns(UserWarning, match="ambiguous"):
        readers.infer_schema(spark, [str(tmp_path / "a.csv")], "csv")
    (tmp_path / "b.csv").write_text("")
    with pytest.raises(ValueError):
        readers.infer_schema(spark, [str(tmp_path / "b.csv")], "csv")


def test_arrow_stream(spark):
    import pyarrow as pa

    table = pa.table({"a": [1, 2], "b": ["x", None]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    assert readers.from_arrow(spark, sink.getvalue().to_pybytes()).collect() == readers.from_arrow(spark, table).collect()
