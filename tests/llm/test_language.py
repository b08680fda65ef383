import math
import random
from collections import Counter, defaultdict

from tests.llm.helpers import crc_remainder, no_documents, odd_documents, words
from tidemark.llm import language


def test_scores_are_those_of_plain_naive_bayes(spark, monkeypatch):
    monkeypatch.setattr(language, "SLICE", 50)  # many slices, texts across several
    rng = random.Random(1)
    texts = [words(rng, rng.randint(0, 60), "abcé ñß") for _ in range(40)] + ["", "", "a", "b"]
    codes, starts = language._codes(texts)
    plain = defaultdict(Counter)
    for k, t in enumerate(texts):
        own = language._codes([t])[0]
        for order in language.ORDERS:
            plain[k].update(language._buckets(own, order).tolist())
    import pandas as pd

    counts = pd.DataFrame([(("x", "y")[k % 2], b, n) for k, c in plain.items() for b, n in c.items() if b < language.BUCKETS], columns=["lang", "bucket", "count"])
    counts = pd.concat([counts.groupby(["lang", "bucket"], as_index=False).sum(), pd.DataFrame([("x", -1, 30), ("y", -1, 10)], columns=counts.columns)])
    model = language.Model(counts)
    got = model.scores(texts)
    for k in range(len(texts)):
        for at, share in enumerate((0.75, 0.25)):
            want = math.log(share) + sum(n * float(model.logs[b, at]) for b, n in plain[k].items())
            assert abs(got[k, at] - want) < 1e-3 * (1 + abs(want)), (k, texts[k])


def test_held_out_accuracy(spark, sf_dir):
    truth = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = language.op5_language(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.held_out == (crc_remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and truth[r.doc_id].lang]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) / len(held) > 0.97


def test_odd_rows(spark):
    df = odd_documents(spark)
    model = language.fit(df)
    got = language.identify(df, model).collect()
    assert len(got) == df.count()
    for r in got:
        if r.doc_id in (0, 1, 2):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred == "en" and r.score == 1.0
    nothing = language.fit(no_documents(spark))
    assert {r.lang_pred for r in language.identify(df, nothing).collect()} == {"und"}
    assert language.identify(no_documents(spark), model).count() == 0
