import hashlib
import random
import zlib
from collections import defaultdict

from tidemark.llm import conversations as T

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows, family=20):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in turns.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - c % family, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in sorted(made.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    out = {}
    for path, who in members.items():
        below = [q for q in members if q[: len(path)] == path]
        children = sum(len(q) == len(path) + 1 for q in below)
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below)
        saved = sum((len(members[q]) - 1) * (len(q[-1][1].split()) if q else 0) for q in below)
        ends = ",".join(str(c) for c in who if len(made[c]) == len(path))
        parent = members[path[:-1]][0] if path else None
        out[who[0], len(path)] = (parent, len(who), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def table(spark, rows, **more):
    return {
        (r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in T.prefix_trie(spark.createDataFrame(rows, SCHEMA), **more).collect()
    }


def talk(rng, conversations, longest=9, words="abc"):
    rows = []
    for c in rng.sample(range(conversations * 3), conversations):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", " ".join(rng.choice(words) for _ in range(rng.randint(0, 2)))))
    rng.shuffle(rows)
    return rows


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 60):
            best = max(range(low + 1, high + 1), key=lambda x: x & -x)
            assert T.two_fattest(low, high) == best


def test_z_fast_trie_against_all_prefixes():
    rng = random.Random(1)
    for start in (0, 5):
        trie, paths = T.ZFastTrie(start), []
        for member in range(400):
            path = tuple(rng.choice("ab") for _ in range(rng.randint(1, 20)))
            if paths and rng.random() < 0.5:
                path = rng.choice(paths)[: rng.randint(1, 20)] + path
            paths.append(path)
            trie.insert([path[: d + 1] for d in range(len(path))], [len(path[d]) for d in range(len(path))], member)
        expected = defaultdict(list)
        for member, path in enumerate(paths):
            for d in range(1, len(path) + 1):
                expected[path[:d]].append(member)
        got = {key: (depth, n, least) for depth, key, _, n, least in trie.expanded()}
        assert got == {key: (start + len(key), len(who), who[0]) for key, who in expected.items()}
        assert len(trie.handles) <= 2 * len(paths)


def test_trie_against_plain_prefixes(spark):
    rows = talk(random.Random(3), 150)
    assert table(spark, rows) == plain_trie(rows)


def test_long_conversations_are_cut_into_ranges(spark):
    rng = random.Random(4)
    rows = talk(rng, 20) + [(1000 + k, turn, "user", "same words") for k in (0, 1, 7) for turn in range(300 + k)]
    assert table(spark, rows) == plain_trie(rows)


def test_small_batches_and_packs(spark):
    rows = talk(random.Random(5), 120, longest=3, words="a")
    assert table(spark, rows, batch_turns=10, packed_ids=3) == plain_trie(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (20, None, None, None), (20, 0, "user", "x " * 50_000), (20, 1, "user", ""), (20, 1, "user", "")]
    rows += [(21, 5, "user", "tail"), (41, 0, "user", "no source"), (42, None, "user", None), (43, 0, "a", "b c"), (44, 0, "a b", "c")]
    assert table(spark, rows) == plain_trie(rows)
    assert table(spark, []) == {}
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS p", "2 AS depth", "'x' AS conv", "3 AS n")
    assert T.prefix_trie(extra).count() == len(plain_trie(rows))
