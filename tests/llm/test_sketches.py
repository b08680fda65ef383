import hashlib
import random
from collections import Counter

import numpy as np

from tests.llm.helpers import SCHEMA, no_documents, odd_documents, words
from tidemark.llm import sketches


def keys_of(text):
    return sketches.paragraph_keys([text.encode()])[0].tolist()


def plain_likeness(a, b):
    x, y = set(keys_of(a)), set(keys_of(b))
    return len(x & y) / len(x | y) if x | y else 1.0


def test_keys_are_alike_in_any_company_and_distinct_for_repeats():
    rng = random.Random(1)
    texts = ["", "a", "a\na\na", words(rng, 200), " \n ", words(rng, 50, "é\nb"), "x", ""]
    keys, owner = sketches.paragraph_keys([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert Counter(keys[owner == k].tolist()) == Counter(keys_of(t))
    assert len(set(keys_of("a\na\na"))) == 3 and set(keys_of("a\na")) < set(keys_of("a\na\na"))


def test_peeling_recovers_the_differing_keys():
    rng = np.random.default_rng(2)
    shared, left, right = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (500, 6, 5))
    zero = lambda x: np.zeros(len(x), np.int64)
    a, b = np.r_[shared, left], np.r_[shared, right]
    difference = sketches.Sketches(a, zero(a), 1, 60).minus(sketches.Sketches(b, zero(b), 1, 60))
    keys, _, signs, whole = difference.peel()
    assert whole.tolist() == [True]
    assert {k for k, s in zip(keys.tolist(), signs.tolist(), strict=True) if s > 0} == set(left.tolist())
    assert {k for k, s in zip(keys.tolist(), signs.tolist(), strict=True) if s < 0} == set(right.tolist())
    small = sketches.Sketches(a, zero(a), 1, 15).minus(sketches.Sketches(b[:0], zero(b[:0]), 1, 15))
    assert small.peel()[3].tolist() == [False]


def test_differences_against_sets():
    rng = random.Random(3)
    pairs = [(words(rng, rng.randint(0, 300)), None) for _ in range(60)]
    pairs = [(a, sketches.edited(a, words(rng, rng.randint(0, 200)))) for a, _ in pairs] + [("", ""), ("a b", "a b")]
    a = sketches.paragraph_keys([x.encode() for x, _ in pairs])
    b = sketches.paragraph_keys([y.encode() for _, y in pairs])
    got = sketches.likeness(a, b, len(pairs))
    assert np.allclose(got, [plain_likeness(x, y) for x, y in pairs])


def check(rows, got):
    order = sorted(rows, key=lambda r: r[0])
    assert [r.doc_id for r in got] == [r[0] for r in order]
    prints = {}
    for at, r in enumerate(got):
        text, following = order[at][1] or "", order[(at + 1) % len(order)][1] or ""
        changed = sketches.edited(text, following)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(r.near_edited - plain_likeness(text, changed)) < 1e-12
        assert abs(r.near_next - plain_likeness(text, following)) < 1e-12
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(changed, r.edited_fingerprint) == r.edited_fingerprint


def test_neighbours_across_ranges(spark):
    rng = random.Random(4)
    rows = [(i * 5 % 1001, words(rng, rng.randint(0, 60), "abcé\n") if i % 5 else "same text\nagain", "en", "s", 1) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    for size in (2000, 10_000, 1 << 30):
        check(rows, sorted(sketches.version_sketches(df, range_bytes=size).collect(), key=lambda r: r.doc_id))


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(rows, sorted(sketches.op6_paragraph_sketches(spark, sf_dir).collect(), key=lambda r: r.doc_id))


def test_odd_rows(spark):
    df = odd_documents(spark)
    for size in (100, 1 << 30):
        got = sketches.version_sketches(df, range_bytes=size).collect()
        assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((r.doc_id is not None, r.doc_id or 0) for r in df.collect())
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert sketches.version_sketches(no_documents(spark)).count() == 0
    one = sketches.version_sketches(df.filter("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_every_byte_of_a_long_word_counts_with_its_place():
    prefix = "https://example.org/a/rather/long/path/to/some/page/of/the/archive/list?id="
    assert len(prefix) > 70
    assert len({tuple(keys_of(prefix + tail)) for tail in ("13", "22", "31")}) == 3
    line = "".join(chr(0x4E00 + 37 * i % 5000) for i in range(60))
    moved = line[:24] + line[24:28][::-1] + line[28:]
    assert sorted(line) == sorted(moved) and set(keys_of(line)) != set(keys_of(moved))
    run = "a" * 300  # nowhere cut, or everywhere
    assert len({tuple(sorted(keys_of(run[:i] + "b" + run[i + 1 :]))) for i in range(60, 300, 40)}) == 6


def test_texts_without_white_space_are_cut_where_their_bytes_say():
    rng = random.Random(5)
    line = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(4000))
    changed = line[:2000] + "x" + line[2001:]
    assert 60 < len(keys_of(line)) < 400
    assert 0.9 < plain_likeness(line, changed) < 1
    assert plain_likeness(line, "y" + line[7:]) > 0.9
    assert plain_likeness(line, line[:2000] + " " + line[2000:]) < 1


def test_a_piece_of_a_word_is_no_word():
    rng = random.Random(6)
    word = words(rng, 60).replace(" ", "")
    data = np.frombuffer(word.encode() + b"\n", np.uint8)
    cuts = [0, *sketches._inner_starts(data, data == 10, np.array([0])).tolist(), len(word)]
    assert len(cuts) > 10
    apart = " ".join(word[i:j] for i, j in zip(cuts, cuts[1:], strict=False))
    assert set(keys_of(word)).isdisjoint(keys_of(apart))
