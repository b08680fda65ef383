import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.session import fresh_dir
from tidemark.sources import readers
from tidemark.sources import schema as docs
from tidemark.sources.records import QuoteScanner, csv_records


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of 401 bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "401")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(spark, *texts, charset="utf-8", label="csv"):
    """One file for each text, byte for byte."""
    folder = fresh_dir(spark, label)
    for i, text in enumerate(texts):
        raw = spark.createDataFrame([(text.encode(charset),)], "value binary").select(F.col("value").cast("string"))
        raw.coalesce(1).write.option("lineSep", "\0").mode("append").text(f"{folder}/part{i}")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "content").collect()
    out = []
    for row in found:  # the writer ends every file with a separator
        path = re.sub("^file:/+", "/", row["path"])
        with open(path, "wb") as target:
            target.write(bytes(row["content"]).removesuffix(b"\0"))
        out.append(path)
    for path in out:
        crc = path.rsplit("/", 1)
        from pathlib import Path

        Path(f"{crc[0]}/.{crc[1]}.crc").unlink(missing_ok=True)
    return folder, out


def field(rng, end):
    kind = rng.random()
    plain = "".join(rng.choice("ab;x\\ é") for _ in range(rng.randint(0, 6))).replace(";", "")
    if kind < 0.5:
        return plain.rstrip("\\")
    inner = "".join(rng.choice(["a", "b", ";", end, " ", '\\"', "\\\\", "é", end + end]) for _ in range(rng.randint(0, 30)))
    return f'"{inner}"'


def table(rng, rows, columns=3, end="\n"):
    return "".join(";".join(["k", *(field(rng, end) for _ in range(columns - 1))]) + end for _ in range(rows))


def test_a_line_follows_the_quotes_of_the_parser():
    scan = QuoteScanner([";"], '"', "\\").inside_after
    doubled = QuoteScanner([";"], '"', '"').inside_after
    assert [scan(x, False) for x in ['a;"b', '"a"', 'a"b', ' "a', '"a""b', '"a\\"b', '"a\\\\"', '"a";"b', '"a"x;"b', "", '"']] == [
        True, False, False, False, False, True, False, True, True, False, True,
    ]
    assert [scan(x, True) for x in ["", "a;b", '"', 'a";"b', '\\"', 'a"x"y;"']] == [True, True, False, True, True, True]
    assert [doubled(x, False) for x in ['"a""b', '"a""', '"a"""', '"a";"']] == [True, True, False, True]


@pytest.mark.parametrize("seed", [1, 2])
def test_records_of_small_splits_are_those_of_sparks_reader(spark, small_splits, seed):
    rng = random.Random(seed)
    folder, paths = written(spark, *(table(rng, 40, end=end) for end in ("\n", "\r\n", "\n")))
    schema = "a string, b string, c string"
    options = {"sep": ";", "multiLine": "true"}
    records = csv_records(spark, paths, delimiter=";")
    got = records.select(F.from_csv("value", schema, options).alias("r")).select("r.*").collect()
    want = spark.read.schema(schema).options(**options).option("recursiveFileLookup", "true").csv(folder).collect()
    assert len(got) == 120
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))
    lines = {(r["__file"], r["__line"]) for r in records.collect()}
    assert len(lines) == 120 and records.where("__leading").count() == 3


def test_one_file_is_read_by_many_tasks(spark, small_splits):
    _, paths = written(spark, table(random.Random(3), 400))
    assert csv_records(spark, paths, delimiter=";").rdd.getNumPartitions() > 20


def test_lines_above_longer_than_a_split_are_skipped(spark, small_splits):
    above = "".join(f'# line {i} "\n' for i in range(60))
    _, paths = written(spark, above + 'a;"x\ny"\nb;z', "# short\n" * 60 + "c;d\n", "# less\n")
    got = csv_records(spark, paths, delimiter=";", skip=60).select("value", "__line").collect()
    assert sorted(map(tuple, got)) == [('a;"x\ny"', 60), ("b;z", 62), ("c;d", 60)]


def test_long_fields_and_open_quotes(spark):
    long = "x, y\n" * 300_000
    _, paths = written(spark, f'1,"{long}"\n2,"open\nto the, end\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        got = sorted(r["value"] for r in csv_records(spark, paths).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted([f'1,"{long}"', '2,"open\nto the, end'])


@pytest.mark.parametrize("charset", ["ISO-8859-1", "windows-1252", "UTF-16", "UTF-8"])
@pytest.mark.parametrize("parser", ["CSV_PARSER", "MULTILINE_CSV_PARSER"])
def test_charset_and_escapes_hold_below_skipped_lines(spark, charset, parser):
    _, paths = written(spark, '# "one\n# two\nMüller,"a \\"b\\" €"\nÉcole,c\n'.replace("€", "" if charset == "ISO-8859-1" else "€"), charset=charset)
    schema = spark.createDataFrame([], "name string, note string").schema
    settings = {"parser": parser, "skipLines": 2, "charsetName": charset}
    rows = readers.read_files(spark, paths, docs.to_document(schema, "csv", text_parser=settings)).collect()
    euro = "" if charset == "ISO-8859-1" else "€"
    assert sorted(map(tuple, rows)) == sorted([("Müller", f'a "b" {euro}'), ("École", "c")])


def test_what_is_inferred_reads_the_files_back(spark):
    text = 'id,"long\nname",day\n1,"x\ny, z",2024-01-02\n2,"a ""quoted"" one",2024-01-03\n3,plain,2024-01-04\n'
    folder, paths = written(spark, text.replace('a ""quoted"" one', 'a \\"quoted\\" one'), 'id,"long\nname",day\n4,"\n",2024-01-05\n')
    doc = readers.infer_schema(spark, paths, "csv")
    assert [(f["name"], f["type"]) for f in doc["fieldSchemaList"]] == [("id", "INTEGER"), ("long\nname", "STRING"), ("day", "DATE")]
    assert doc["customMetadata"]["textParserParams"]["parser"] == "MULTILINE_CSV_PARSER"
    rows = readers.read_files(spark, paths, doc).collect()
    assert sorted((r[0], r[1]) for r in rows) == [(1, "x\ny, z"), (2, 'a "quoted" one'), (3, "plain"), (4, "\n")]


def test_fields_of_a_megabyte_are_inferred_and_read(spark):
    text = "id,body\n" + "".join(f'{i},"{"word, " * 200_000}\n{i}"\n' for i in range(3))
    _, paths = written(spark, text)
    doc = readers.infer_schema(spark, paths, "csv")
    rows = readers.read_files(spark, paths, doc).selectExpr("id", "length(body) AS n").collect()
    assert sorted(map(tuple, rows)) == [(i, 1_200_002) for i in range(3)]


def test_partition_folders_and_odd_files(spark):
    folder = fresh_dir(spark, "folders")
    rows = spark.createDataFrame([("x\ny", 1), ("z", 2)], "v string, p int")
    rows.write.partitionBy("p").options(header="true", quoteAll="true").csv(folder)
    doc = docs.to_document(rows.schema, "csv", text_parser={"parser": "MULTILINE_CSV_PARSER"})
    assert sorted(map(tuple, readers.read_files(spark, [folder], doc, base_path=folder).collect())) == [("x\ny", 1), ("z", 2)]
    _, paths = written(spark, "\n\n", "only")
    assert [r["value"] for r in csv_records(spark, paths).collect()] == ["only"]
