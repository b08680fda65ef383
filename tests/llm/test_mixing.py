import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import no_documents, odd_documents
from tidemark.llm import mixing
from tidemark.llm.base import stored
from pyspark.sql import functions as F


@given(st.lists(st.integers(0, 1000), max_size=8))
@settings(max_examples=200, deadline=None)
def test_targets(sizes):
    got = mixing.targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))])
    assert abs(sum(got) - 1.5 * sum(sizes)) < 1e-6 * (1 + sum(sizes))
    assert all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes, strict=True))
    units = {round(t / (3, 1, 2)[i % 3], 6) for i, (t, s) in enumerate(zip(got, sizes, strict=True)) if t < 2 * s - 1e-9}
    assert len(units) <= 1


def test_permutations_and_counts():
    for n in (1, 2, 3, 17, 1000, 4097):
        for key in (0, 12345, 2**63):
            got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(got.tolist()) == list(range(n))
    counts = mixing.draw_counts([100, 0, 3000, 7], 16, 5)
    assert counts.sum(axis=0).tolist() == [100, 0, 3000, 7] and counts.min() >= 0
    assert counts.sum(axis=1).max() - counts.sum(axis=1).min() <= 1
    huge = mixing.draw_counts([3_000_000_000, 1_000_000_000], 4, 5)
    assert huge.sum(axis=0).tolist() == [3_000_000_000, 1_000_000_000] and huge.min() > 0


def test_mixture_of_the_documents(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = mixing.op10_mixture(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    taken, sizes, goal = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        goal[r.source] = r.target
    order = sorted(sizes, key=lambda s: (s is None, s))
    expected = mixing.targets([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))])
    for s, t in zip(order, expected, strict=True):
        assert abs(goal[s] - t) < 1e-6 * t and abs(taken[s] - t) <= 0.02 * t
    assert {tuple(r) for r in mixing.op10_mixture(spark, sf_dir).collect()} == {tuple(r) for r in rows}


def test_pieces_are_whole_blocks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = stored(mixing.sizes_of(docs).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", "size"), "t")
    _, pieces = mixing.mix(sized)
    size = {r.rid: r.size for r in sized.collect()}
    blocks, used = defaultdict(int), defaultdict(list)
    for p in pieces.collect():
        assert p.length > 0 and 0 <= p.first and p["first"] + p.length <= size[p.rid]
        blocks[p.g, p.j] += p.length
        used[p.rid, p.epoch].append((p["first"], p.length))
    assert max(blocks.values()) <= mixing.BLOCK
    for spans in used.values():  # within an epoch no word is taken twice
        spans.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))


def test_odd_rows(spark):
    for df in (odd_documents(spark).drop("rid", "size"), no_documents(spark)):
        sized = stored(mixing.sizes_of(df).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", "size"), "t")
        sources, pieces = mixing.mix(sized)
        assert sources.count() == df.select("source").distinct().count()
        size = {r.rid: r.size for r in sized.collect()}
        taken = defaultdict(int)
        for p in pieces.collect():
            taken[p.rid] += p.length
        assert all(t <= 2 * size[r] for r, t in taken.items())
