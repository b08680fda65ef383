import random
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, no_documents, words
from tidemark.llm import base, exact, mixing, sharding, simhash


def test_rows_that_can_change_places_are_settled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.text for r in docs.select("text").collect()}
    plain = docs.where("doc_id >= 0").withColumn("more", F.lit(1))
    assert base.settled(plain, "s") is plain
    for moved in (docs.repartition(7), docs.orderBy(F.rand(3)), docs.limit(150)):
        assert base.settled(moved, "s") is not moved
    shuffled = docs.repartition(7)
    assert {r.text for r in exact.distinct_rows(shuffled).collect()} == texts
    kept = simhash.distinct_rows(shuffled).select("doc_id").collect()
    expected = simhash.distinct_rows(docs).select("doc_id").collect()
    assert sorted(kept) == sorted(expected)
    assert mixing.mixed_rows(shuffled).select("doc_id").distinct().count() == mixing.mixed_rows(docs).select("doc_id").distinct().count()
    assert exact.distinct_rows(no_documents(spark)).count() == 0


def test_a_third_of_the_rows_under_one_id_spread_over_cells(spark):
    rng = random.Random(1)
    rows = [(None if i % 3 == 0 else i, words(rng, 3), "en", "s", 1) for i in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    narrow = df.select("doc_id", "source", F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.length("text").alias("size"))
    got = sharding.shard(narrow).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("last"), F.countDistinct("slot").alias("slots")).collect()
    assert {(r.n, r.last + 1, r.slots) for r in got} == {(1250, 1250, 1250)}
    units = {
        "shard": narrow.select(base.unit_hash(F.col("doc_id"), F.lit(20), F.xxhash64(*narrow.columns)).alias("u")),
        "mix": df.select(base.unit_hash(F.col("doc_id"), F.xxhash64("text"), F.lit(20)).alias("u")),
    }
    for name, unit in units.items():
        cells = Counter(int(r.u * 142) for r in unit.collect())
        assert max(cells.values()) < 3 * sorted(cells.values())[len(cells) // 2], name
