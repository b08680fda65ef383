import re
from collections import Counter, defaultdict

import corpus_pipeline
import __spark_entry__
from pyspark.sql import functions as F

from tests.llm.helpers import no_documents, odd_documents
from tests.llm.test_simhash import plain_components, plain_simhash
from tidemark.llm import mixing
from tidemark.llm.base import stored

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "packing"]
    before, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, SF), "t")
        assert after.columns == docs.columns
        kept[name] = (before.collect(), after.collect())
        before = after
    rows, good = kept["quality classifier"]
    ids = {r.doc_id for r in good}
    assert all((r.doc_id in ids) == (labels[r.doc_id] == 1) for r in rows if r.doc_id in labels)
    rows, unique = kept["exact dedup"]
    best = {}
    for r in rows:
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert {r.doc_id for r in unique} == set(best.values()) and len(unique) == len(best)
    rows, apart = kept["SimHash near-dedup"]
    prints = {r.doc_id: plain_simhash(r.text) for r in rows}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {r.doc_id for r in apart} == {d for d, c in plain_components(pairs, prints).items() if d == c}
    rows, mixed = kept["mixing sources to target weights"]
    sizes, taken, whole = defaultdict(int), defaultdict(int), {r.doc_id: r for r in rows}
    used = defaultdict(Counter)
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text))
    for r in mixed:
        assert r.n_chars == len(r.text) and r.source == whole[r.doc_id].source
        taken[r.source] += len(WORD.findall(r.text))
        used[r.doc_id].update(WORD.findall(r.text))
    for d, words in used.items():
        have = Counter(WORD.findall(whole[d].text))
        assert all(n <= 2 * have[w] for w, n in words.items())
    order = sorted(sizes)
    for s, t in zip(order, mixing.targets([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))]), strict=True):
        assert abs(taken[s] - t) <= 0.02 * t
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    assert Counter(r.doc_id for r in mixed).keys() == {r.doc_id for r in packed}
    assert __spark_entry__.queries()["pipeline"](spark, SF).count() == len(packed)


def test_taken_text():
    text = " a b\tc\n d  e "
    assert mixing.taken_text(text, [(0, 5)]) == text
    assert mixing.taken_text(text, [(3, 1), (0, 1), (1, 1)]) == "a b\nd"


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 0), (4, 1), (5, 1), (7, 1)], "doc_id long, quality int")
    import tempfile

    with tempfile.TemporaryDirectory() as folder:
        labels.write.parquet(f"{folder}/labels.parquet")
        for df in (odd_documents(spark), no_documents(spark)):
            for name, stage in corpus_pipeline.STAGES[:-1]:
                after = stage(spark, stored(df, "t"), folder)
                assert after.columns == df.columns, name
                after.collect()
            assert corpus_pipeline.STAGES[1][1](spark, stored(df, "t"), folder).count() == df.select(F.coalesce("text", F.lit(""))).distinct().count()
            corpus_pipeline.STAGES[-1][1](spark, stored(df, "t"), folder).collect()
