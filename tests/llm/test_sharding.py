from collections import Counter, defaultdict

from tests.llm.helpers import SCHEMA, no_documents, odd_documents
from tidemark.llm import sharding


def test_shards_are_equal_gapless_and_match_the_mixture(spark):
    rows = [(i, "t" * (i % 9), "en", "hot" if i % 3 == 0 else f"s{i % 50}", 1) for i in range(3001)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sharding.shard(df).collect()
    assert sorted(r.doc_id for r in got) == list(range(3001))
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    assert set(by_shard) == set(range(16))
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    whole = Counter(r.source for r in got)
    for shard in by_shard.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
        for source, n in Counter(r.source for r in shard).items():
            assert abs(n - whole[source] / 16) <= 1.5
    again = sharding.shard(df.repartition(3)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in got}


def test_order_is_that_of_fractional_ranks(spark):
    rows = [(i, "t", "en", f"s{i % 4}" if i % 7 else None, 1) for i in range(200)]
    got = sorted(sharding.shard(spark.createDataFrame(rows, SCHEMA), shards=3).collect(), key=lambda r: (r.shard, r.slot))
    seen, sizes = Counter(), Counter(r.source for r in got)
    for at, r in enumerate(got):
        seen[r.source] += 1
        assert abs(seen[r.source] / sizes[r.source] - at / len(got)) < 2 / min(sizes.values())


def test_odd_rows(spark):
    df = odd_documents(spark)
    got = sharding.shard(df)
    assert got.columns == [c for c in df.columns if c != "shard"] + ["shard", "slot"]
    assert got.count() == df.count()
    assert len({(r.shard, r.slot) for r in got.collect()}) == df.count()
    assert sharding.shard(no_documents(spark)).count() == 0
    query = sharding.op3_stratified_shards
    assert query.__doc__
