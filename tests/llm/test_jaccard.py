import random

import numpy as np

from tests.llm.helpers import no_documents, odd_documents, words
from tests.llm.test_simhash import plain_components
from tidemark.llm import jaccard


def plain_set(text, shingle=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())


def plain_groups(texts, percent=90, shingle=3):
    sets = {d: plain_set(t, shingle) for d, t in texts.items()}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    least = plain_components(pairs, sets)
    return {d: (len(s), least[d]) for d, s in sets.items()}


def edited(rng, text, share):
    w = text.split(" ")
    for _ in range(max(1, int(len(w) * share / 3))):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


def corpus(rng):
    """Near copies of several bases, at distances on both sides of the limit, and texts that share long passages."""
    passage, texts = words(rng, 120), []
    for _ in range(6):
        base = words(rng, rng.randint(40, 160))
        texts += [base, *(edited(rng, base, rng.choice([0.02, 0.05, 0.08, 0.1, 0.2])) for _ in range(12))]
    texts += [f"{words(rng, rng.randint(5, 60))} {passage}" for _ in range(40)]
    texts += [words(rng, rng.randint(0, 4)) for _ in range(20)] + texts[:10]
    chain = words(rng, 100)
    for _ in range(15):  # each near the next only
        texts.append(chain)
        chain = edited(rng, chain, 0.05)
    rng.shuffle(texts)
    return texts


def groups(spark, texts, **more):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    return {r.id: (r.n, r.component_id) for r in jaccard.similar_groups(df, **more).collect()}


def test_sets_against_plain_shingles():
    rng = random.Random(1)
    texts = ["", " \n", "A", "a b", "a  B\tc", "x y z x y z x y z", words(rng, 300), "Ä ä\x0bB\x1cc D"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    for shingle in (1, 3, 5):
        got = jaccard.token_sets(data, offsets, shingle)
        assert [len(s) for s in got] == [len(plain_set(t, shingle)) for t in texts]
        assert all((np.diff(s.astype(object)) > 0).all() for s in got if len(s) > 1)
    assert jaccard.token_sets(data, offsets, 3)[3].tolist() != jaccard.token_sets(data, offsets, 3)[2].tolist()


def test_groups_against_all_pairs(spark):
    for seed in (1, 2):
        texts = dict(enumerate(corpus(random.Random(seed))))
        assert groups(spark, texts) == plain_groups(texts)


def test_frequent_tokens_small_groups_and_other_limits(spark):
    texts = dict(enumerate(corpus(random.Random(3))))
    assert groups(spark, texts, hot=2, group=2) == plain_groups(texts)
    assert groups(spark, texts, percent=70, shingle=2) == plain_groups(texts, 70, 2)


def test_real_documents_against_all_pairs(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op12_similar_groups(spark, sf_dir).collect()}
    assert got == plain_groups(texts)


def test_odd_rows(spark):
    df = odd_documents(spark)
    got = jaccard.similar_groups(df).collect()
    assert len(got) == df.count()
    assert {(r.id, r.n, r.component_id) for r in got if r.id in (0, 1, 2)} == {(0, 0, 0), (1, 0, 1), (2, 0, 2)}
    assert {r.component_id for r in got if r.id in (3, 4)} == {3}
    assert [(r.n, r.component_id) for r in got if r.id is None] == [(1, None)]
    assert {r.n for r in got if r.id == 6} == {1}
    assert jaccard.similar_groups(no_documents(spark)).count() == 0


def test_prefixes_begin_with_the_rarest_tokens_of_whole_sets(spark):
    rng = random.Random(5)
    base = words(rng, 300)
    # each differs from the base in words of its own, so that no two share one of their first tokens
    texts = {i: edited(rng, base, 0.45) for i in range(30)} | {100 + i: words(rng, 80) for i in range(5)} | {200: None, 201: ""}
    sets = {i: plain_set(t) for i, t in texts.items()}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    content = df.select(jaccard.utf8().alias("content"))
    rated = content.unionAll(content).mapInArrow(jaccard._dealt(3, 5), jaccard._PIECES).repartition(5, "part").mapInArrow(jaccard._rated(64, 5), jaccard._RATED)
    got = rated.repartition(5, "bucket").mapInArrow(jaccard._prefixes(90), "token long, d1 long, n long, place long, singles long").collect()
    times = {}
    for s in sets.values():
        for t in s:
            times[t] = times.get(t, 0) + 1
    room = {i: len(s) - jaccard.least_overlap(len(s), 90) + 1 for i, s in sets.items()}
    single = {i: sum(times[t] == 1 for t in s) for i, s in sets.items()}
    assert len(got) == sum(min(max(0, room[i] - single[i]), len(s) - single[i]) for i, s in sets.items())
    assert all(r.place >= r.singles for r in got)
    assert groups(spark, texts) == plain_groups(texts)


def test_bitmaps_of_any_size_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    for n, m in ((3, 3), (100, 130), (127, 129), (1000, 1100), (5000, 40)):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: len(a) * 9 // 10], rng.integers(0, 1 << 63, m, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        x, y = jaccard._folded(jaccard._bitmap(a), jaccard._bitmap(b))
        assert int(np.bitwise_count(x ^ y).sum()) <= len(a) + len(b) - 2 * both
        assert int(np.bitwise_count(x & ~y).sum()) <= len(a) - both
