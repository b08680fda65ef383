import random

import numpy as np

from tests.llm.helpers import crc_remainder, no_documents, odd_documents, words
from tidemark.llm import quality


def encoded(texts):
    raw = [t.encode() for t in texts]
    return quality.encode(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64))


def test_a_text_is_encoded_alike_in_any_company():
    rng = random.Random(1)
    texts = ["", "a", words(rng, 96), words(rng, 97), "A b! A\nb", " \n", "x", words(rng, 500, "aBé!1\n"), "", "tail"]
    x, begins = encoded(texts)
    assert np.diff(begins).tolist() == [max(1, -(-len(t.split()) // quality.PASSAGE)) for t in texts]
    for k, t in enumerate(texts):
        alone, _ = encoded([t])
        assert np.allclose(x[begins[k] : begins[k + 1]], alone, atol=1e-6), t
    assert not x[begins[0]].any() and not x[begins[5]].any()


def test_words_shares():
    x, _ = encoded(["a a b A a C\nd"])
    at = quality.SHAPES + quality.WORDS
    assert np.allclose(x[0, at : at + 5], [4 / 7, 2 / 7, 0, 0.1, 2 / 7])  # capitals need two letters; the end is a line end


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    model = quality.AttentionModel()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, begins = rng.standard_normal((9, quality.FEATURES)), np.array([0, 1, 4, 9])
    label, weight = np.array([1.0, 0, 1]), np.array([1.0, 2, 0.5])

    def loss():
        s = model._forward(x, begins)["score"]
        return -(weight * (label * np.log(s) + (1 - label) * np.log(1 - s))).sum() / weight.sum()

    grads = model.gradients(x, begins, label, weight)
    for name, value in model.p.items():
        flat = value.reshape(-1)
        for at in rng.integers(0, len(flat), 4):
            old = flat[at]
            flat[at] = old + 1e-5
            up = loss()
            flat[at] = old - 1e-5
            down = loss()
            flat[at] = old
            assert abs((up - down) / 2e-5 - grads[name].reshape(-1)[at]) < 1e-4, name


def test_attention_finds_the_bad_passage():
    rng = random.Random(4)
    good = [words(rng, 400) for _ in range(80)]
    bad = [" ".join([words(rng, 200), " ".join(["BAD!!"] * 96), words(rng, 100)]) for _ in range(80)]
    bags = [encoded([t])[0] for t in good + bad]
    model = quality.AttentionModel().fit(bags, np.array([1] * 80 + [0] * 80))
    x, begins = encoded([bad[0], good[0]])
    s = model.score(x, begins)
    assert s[0] < 0.1 and s[1] > 0.9
    assert model.attention(x, begins)[2:4].max() == model.attention(x, begins)[: begins[1]].max()


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = quality.op1_attention_quality(spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (crc_remainder(r.doc_id, 3) == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_odd_rows(spark):
    df = odd_documents(spark)
    labels = spark.createDataFrame([(0, 0), (1, 0), (4, 1), (5, 1), (6, 0), (6, 1), (None, 1), (7, None), (3, 7)], "doc_id long, quality int")
    model = quality.train(df, labels)
    got = quality.score(df.drop("score", "predicted"), model).collect()
    assert len(got) == df.count()
    assert len({r.score for r in got if r.doc_id in (0, 1, 2)}) == 1
    assert quality.score(no_documents(spark), model).count() == 0
    nothing = quality.train(no_documents(spark), labels)
    assert {round(r.score, 6) for r in quality.score(df, nothing).collect()} == {0.5}
