import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import no_documents, odd_documents
from tidemark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
WORDS = packing.WordTokens(PATH, cached=50)


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\x0b\x0c\r\x1c\x85\xa0 'sSİİé<|endoftext|>019ß!?"), st.characters(codec="utf-8")), max_size=60), max_size=6))
@settings(max_examples=400, deadline=None)
def test_words_one_by_one_give_the_ids_of_whole_texts(texts):
    got = WORDS.encode([t.encode() for t in texts])
    assert [g.tolist() for g in got] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


def squares(packer):
    return int((packer.count.astype(object) ** 2).sum())


def test_each_placement_is_the_best_one():
    rng = random.Random(1)
    packer = packing.SquaresPacker(32)
    for _ in range(2000):
        need = rng.choice([1, 3, 5, 8, 13, 21, 30])
        before = packer.count.copy()
        options = []
        for level in [0, *np.flatnonzero(before).tolist()]:
            if level + need <= 32:
                after = before.copy()
                after[level] -= level > 0
                after[level + need] += level + need < 32
                options.append(int((after**2).sum()))
        packer.place(need, ("k", 0, np.zeros(need), need))
        assert squares(packer) == min(options)


def check_windows(items, length, most_open):
    windows = list(packing.pack(iter(items), length, most_open))
    pieces = defaultdict(list)
    for w in windows:
        used = sum(len(p[2]) for p in w)
        assert used == length or (used < length and used & (used - 1) == 0)
        for key, start, ids, total in w:
            assert total == len(dict(items)[key]) and len(ids)
            pieces[key].append((start, ids.tolist()))
    for key, ids in items:
        assert sum((p for _, p in sorted(pieces[key])), []) == ids.tolist()
        assert [s for s, _ in sorted(pieces[key])] == [0, *np.cumsum([len(p) for _, p in sorted(pieces[key])])[:-1]]
    return windows


def test_windows_hold_every_id_once_and_no_padding():
    rng = random.Random(2)
    for n, most_open in ((0, 4), (1, 4), (400, 4), (400, 1000)):
        check_windows([(i, np.array([rng.randrange(1000) for _ in range(rng.randint(1, 150))], np.uint32)) for i in range(n)], 64, most_open)


def test_documents(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.op8_squares_packing(spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc_id, text in docs.items():
        ids = np.array([*PLAIN.encode(text, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0


def test_odd_rows(spark):
    df = odd_documents(spark)
    got = packing.pack_documents(df, PATH).collect()
    assert sum(r.length for r in got) == sum(len(PLAIN.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in df.collect())
    assert {(r.length, r.ids) for r in got if r.doc_id in (0, 1, 2)} == {(1, b"\2\0\0\0")}
    assert packing.pack_documents(no_documents(spark), PATH).count() == 0
