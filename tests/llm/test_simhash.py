import random

import numpy as np
import xxhash

from tests.llm.helpers import no_documents, odd_documents, words
from tidemark.llm import simhash
from tidemark.llm.components import components


def plain_simhash(text):
    tokens = text.encode().lower().split()
    shingles = [b" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] or ([b" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, nodes):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def near_values(rng, n):
    values = [rng.getrandbits(64) for _ in range(n)] + [0, 1, (1 << 64) - 1]
    for v in list(values):
        for _ in range(rng.randint(0, 4)):
            w = v
            for _ in range(rng.randint(1, 3)):
                w ^= 1 << rng.randrange(64)
            values.append(w)
            values.append(w ^ (1 << rng.randrange(64)))
    return sorted(set(values))


def test_spark_hash_is_the_same_as_ours(spark):
    assert spark.sql("SELECT xxhash64('one two three')").first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(b"one two three", 42)


def test_fingerprints():
    rng = random.Random(3)
    for text in ["", " ", "A", "a b", "a b c", "A b C d", words(rng, 300), "Ä ä\x0bB\x1cc"]:
        assert simhash.simhash(text.encode()) == plain_simhash(text)


def test_trie_pairs_against_all_pairs():
    rng = random.Random(4)
    for budget in (0, 1, 2, 3):
        values = np.array(near_values(rng, 150), np.uint64)
        pairs = set()
        for i, j in simhash.trie_pairs(values, np.array([0]), np.array([len(values)]), 0, budget):
            assert not pairs & set(zip(i.tolist(), j.tolist()))
            pairs |= set(zip(i.tolist(), j.tolist()))
        expected = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= budget}
        assert {tuple(sorted(p)) for p in pairs} == expected


def test_links_connect_what_is_near_with_and_without_hot_blocks(spark):
    rng = random.Random(5)
    values = near_values(rng, 60)
    base = rng.getrandbits(64)
    values = sorted({*values, *(base ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(16, 40, 5))})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    pairs = [(signed[i], signed[j]) for i in range(len(values)) for j in range(i + 1, len(values)) if (values[i] ^ values[j]).bit_count() <= 2]
    expected = plain_components(pairs, signed)
    for hot in (10_000, 3):
        got = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, hot)).collect()
        assert {r.a: r.component for r in got} == {k: v for k, v in expected.items() if k != v}


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 600)] + [(7, 7), (3, 500)]
    expected = plain_components(pairs, {x for p in pairs for x in p})
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.a: r.component for r in got} == {k: v for k, v in expected.items() if k != v}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_groups_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = {r.doc_id: plain_simhash(r.text or "") for r in docs.collect()}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    expected = plain_components(pairs, prints)
    got = simhash.op4_simhash_groups(spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{p:016x}", expected[d]) for d, p in prints.items()}
    assert len(got) == len(prints)


def test_odd_rows(spark):
    df = odd_documents(spark)
    got = simhash.near_groups(df).collect()
    assert len(got) == df.count()
    assert {r.fp for r in got if r.doc_id in (0, 1, 2)} == {0}
    assert {r.component_id for r in got if r.doc_id in (0, 1, 2)} == {0}
    assert {r.component_id for r in got if r.doc_id in (3, 4)} == {3}
    assert simhash.near_groups(no_documents(spark)).count() == 0
