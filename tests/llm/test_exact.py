import hashlib
import random
from pathlib import Path
from collections import defaultdict

from tests.llm.helpers import no_documents, odd_documents, words
from tidemark.llm import base, exact


def test_classes_spill_recursively_and_compare_content():
    rng = random.Random(1)
    texts = [words(rng, 30).encode() for _ in range(400)]
    records = [(rng.choice(texts), (i,)) for i in range(3000)]
    expected = defaultdict(set)
    for text, (i,) in records:
        expected[text].add(i)
    for limit in (500, 20_000, 10**9):
        # a hash of few values: equal hashes of different contents must not merge
        for hash_of in (exact.content_hash, lambda c: len(c) % 3):
            found = {c: {r[0] for r in rows} for c, rows in exact.classes(iter(records), limit, hash_of)}
            assert found == expected


def test_groups_against_plain_grouping(spark):
    rng = random.Random(2)
    texts = [words(rng, 12) for _ in range(60)]
    rows = [(i, rng.choice(texts) if i % 3 else texts[0], "en", "s", 1) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    by_text = defaultdict(list)
    for i, t, *_ in rows:
        by_text[t].append(i)
    for local_rows in (exact.LOCAL_ROWS, 10, 1):
        got = exact.groups(df, fit_bytes=300, local_rows=local_rows).collect()
        assert len(got) == 900
        for r in got:
            group = by_text[rows[r.doc_id][1]]
            assert (r.keep_id, r.group_size, r.kept) == (max(group), len(group), r.doc_id == max(group))
            assert r.text_sha256 == hashlib.sha256(rows[r.doc_id][1].encode()).hexdigest()


def test_spill_files_lie_with_those_of_spark(tmp_path, monkeypatch):
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path / "a"))
    found = exact.classes(((b"%d" % i, (i,)) for i in range(50)), 1000)
    next(found)
    assert any(p.is_file() for p in (tmp_path / "a").rglob("*"))
    assert len(list(found)) == 49 and not list(Path(tmp_path / "a").iterdir())


def test_odd_rows(spark):
    df = odd_documents(spark)
    got = exact.groups(df).collect()
    assert len(got) == df.count()
    assert [r.kept for r in got if r.text_sha256 == hashlib.sha256(b"").hexdigest()] .count(True) == 1
    a = [r for r in got if r.text_sha256 == hashlib.sha256(b"a").hexdigest()]
    assert len(a) == 4 and sum(r.kept for r in a) == 1 and {r.keep_id for r in a} == {4}
    assert [(r.keep_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    kept = exact.distinct_rows(df)
    assert kept.columns == df.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({r.text or "" for r in df.collect()})
    assert exact.groups(no_documents(spark)).count() == 0


def test_places_stay_when_cores_come_and_go(spark, tmp_path):
    spark.range(20_000).selectExpr("id AS doc_id", "repeat(sha2(string(id), 256), 20) AS text").repartition(3).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get(base.SPLITS, None)
    docs = spark.read.parquet(str(tmp_path / "t"))
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        places = {r.doc_id: r.p for r in base.placed(docs, "p").select("doc_id", "p").collect()}
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
        assert {r.doc_id: r.p for r in base.placed(docs, "p").select("doc_id", "p", "text").collect()} == places
        assert max(places.values()) >> 33 > 2  # files were split
    finally:
        for key in ("spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism", *([] if before else [base.SPLITS])):
            spark.conf.unset(key)
