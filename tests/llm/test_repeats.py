import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import SCHEMA, no_documents, odd_documents, words
from tidemark.llm import repeats


def plain_spans(texts, length):
    """Removed (first, end) of each text, by counting all passages."""
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                covered[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.r_[0, covered.astype(np.int8), 0]))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)))
    return out


def messy_texts(rng, n):
    passages = [words(rng, rng.randint(30, 200), "abcé") for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [words(rng, rng.randint(0, 80)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages) if rng.random() < 0.6 else "")
        texts.append(" ".join(parts))
    line = words(rng, 30)[:110]  # a common line shorter than a passage
    texts += [words(rng, 60) + line + words(rng, 60) for _ in range(40)]
    texts += ["x" * 199, "y" * 200, "z" * 201, "ab" * 300, "abc " * 50 + "q", passages[0], passages[0], "", "tail"]
    copy = texts[3]
    texts += [copy, copy[:150] + "#" + copy[151:], copy + " more"]
    return texts


def test_index_against_plain_suffixes():
    rng = random.Random(1)
    for _ in range(20):
        pieces = [words(rng, rng.randint(0, 12), "ab").encode() for _ in range(rng.randint(1, 8))]
        pieces += [pieces[0], b"\0\0\1\xff\xff", b"aaaaaaaaaaaa"]
        index = repeats.RunLengthIndex(pieces)
        text, end = b"".join(pieces), np.repeat(index.starts[1:], np.diff(index.starts))
        suffix = [text[i : end[i]] for i in range(len(text))]
        order = sorted(range(len(text)), key=lambda i: (suffix[i], i))
        assert index.order.tolist() == order

        def shared(i, j):
            k = 0
            while k < min(len(suffix[i]), len(suffix[j])) and suffix[i][k] == suffix[j][k]:
                k += 1
            return k

        want = [0] * len(text)
        for a, b in zip(order, order[1:], strict=False):
            k = shared(a, b)
            want[a], want[b] = max(want[a], k), max(want[b], k)
        assert index.matching().tolist() == want
        assert len(index.heads) <= len(text)


def test_equal_passages_have_equal_anchors():
    rng = random.Random(2)
    passage = words(rng, 100).encode()
    a, b = b"abc" + passage + b"tail of one", words(rng, 20).encode() + passage
    anchors = []
    for t in (a, b):
        first, count, anchor = repeats.stretches(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert count.sum() == len(t) - 199 and (first[1:] == first[:-1] + count[:-1]).all() and count.max() <= 137
        base = t.index(passage)
        per_start = np.repeat(anchor, count)
        anchors.append(per_start[base : base + len(passage) - 199].tolist())
    assert anchors[0] == anchors[1]


@pytest.mark.parametrize(("hot", "slices"), [(4096, 1 << 20), (2, 300)])
def test_against_counting_all_passages(spark, monkeypatch, hot, slices):
    monkeypatch.setattr(repeats, "SLICE", slices)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 5000)
    rng = random.Random(3)
    texts = messy_texts(rng, 120)
    raw = [t.encode() for t in texts]
    want = plain_spans(raw, 200)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    docs = repeats.numbered(df)
    ids = {r.rid: r.doc_id for r in docs.select("rid", "doc_id").collect()}
    got = {ids[r.rid]: ([(s["first"], s["end"]) for s in r.spans], bytes(r.kept)) for r in repeats.repeated_passages(docs, hot=hot).collect()}
    assert set(got) == {i for i, w in enumerate(want) if w}
    for i, (spans, kept) in got.items():
        assert spans == want[i], i
        assert kept == b"".join(raw[i][a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(raw[i])], strict=True))


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    raw = [(r.text or "").encode() for r in docs]
    want = dict(zip([r.doc_id for r in docs], plain_spans(raw, 200), strict=True))
    texts = {r.doc_id: t for r, t in zip(docs, raw, strict=True)}
    got = repeats.op9_repeated_passages(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    for r in got:
        spans, t = want[r.doc_id], texts[r.doc_id]
        kept = b"".join(t[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(t)], strict=True))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())


def test_odd_rows(spark):
    for df in (odd_documents(spark), no_documents(spark)):
        raw = [(r.text or "").encode() for r in df.collect()]
        got = repeats.repeated_passages(repeats.numbered(df)).collect()
        assert len(got) == sum(bool(w) for w in plain_spans(raw, 200))


def test_edges_of_a_common_line_are_counted_not_indexed(spark, monkeypatch):
    rng = random.Random(7)
    seen = []
    split = repeats.split_crowded

    def spy(pieces, hot):
        seen.append((pieces, *split(pieces, hot)))
        return seen[-1][1:]

    monkeypatch.setattr(repeats, "split_crowded", spy)
    line = "".join(rng.choice("abcdefgh ") for _ in range(230))
    texts = ["".join(rng.choice("stuvwxyz") for _ in range(60)) + line + "".join(rng.choice("stuvwxyz") for _ in range(60)) for _ in range(80)]
    texts += [t[:30] + "#" + t[31:] for t in texts[:3]]  # these share passages over the line's edges
    raw = [t.encode() for t in texts]
    want = plain_spans(raw, 200)
    assert all(w and w[0][1] - w[0][0] >= 230 for w in want)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    docs = repeats.numbered(df)
    ids = {r.rid: r.doc_id for r in docs.select("rid", "doc_id").collect()}
    got = {ids[r.rid]: [(s["first"], s["end"]) for s in r.spans] for r in repeats.repeated_passages(docs, hot=20).collect()}
    assert got == {i: w for i, w in enumerate(want) if w}
    pieces, few, crowded = seen[0]
    most = lambda p: max((r["count"] for r in p.groupBy("key").count().collect()), default=0)
    assert most(pieces.filter("piece IS NOT NULL")) > 20 >= most(few) and crowded.count() > 20
