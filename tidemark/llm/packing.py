"""Sum-of-squares online packing of token sequences into windows of fixed length."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import batch_bytes, chunks, documents, utf8

LENGTH = 4096
END = 2
MOST_OPEN = 1024
CHUNK_BYTES = 4 << 20
# Words kept while a task runs, and from one task of a worker to the next: some 250 bytes each.
CACHED_WORDS, KEPT_WORDS = 500_000, 100_000
MARKS = b".,!?;:|%$#&*"
JOINED = 64
_ASCII_LETTERS = frozenset(bytes([c]) for c in b"abcdefghijklmnopqrstuvwxyz")
_MARK = np.zeros(256, bool)
_MARK[list(MARKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Numbers(dict):
    """Numbers words in order of arrival; ``new`` has those not numbered before."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class _Column:
    """An array that grows at its end, with room to spare."""

    def __init__(self, values: np.ndarray) -> None:
        self.room, self.size = values, len(values)

    def extend(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.room):
            larger = np.zeros((2 * end, *self.room.shape[1:]), self.room.dtype)
            larger[: self.size] = self.room[: self.size]
            self.room = larger
        self.room[self.size : end] = more
        self.size = end

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


class WordTokens:
    """Token ids of texts, word by word: the tokenizer never joins across ASCII white space and drops it.

    A-Z are lower-cased, as it does, and a word is cut once more before its last run of marks if a letter precedes them,
    which the tokenizer does too. The ids of these parts of words are kept for later texts. Beyond a bounded number of
    parts or bytes only those that came several times stay, the most frequent ones if these are too many as well.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task for each core
        from tokenizers import Tokenizer

        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends_word[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.parts, self.bytes = _Numbers(), 0
        # all ids, and of each part where its own begin, how many they are and how often it came
        self.flat, self.first, self.count = _Column(np.zeros(0, np.uint32)), _Column(np.zeros(0, np.int64)), _Column(np.zeros(0, np.int32))
        self.hits = _Column(np.zeros(0, np.int64))

    def trim(self, most: int) -> None:
        """Forgets all parts but at most ``most`` of those that came several times, the most frequent ones."""
        hits, parts = self.hits.values, list(self.parts)
        often = hits > 2
        if often.sum() > most:
            often &= hits >= np.partition(hits, -most)[-most]
        used = np.flatnonzero(often)[:most]
        parts = [parts[k] for k in used.tolist()]
        size = sum(map(len, parts))
        if size > 16 * most:
            return self._forget()
        count = self.count.values[used]
        self.flat = _Column(self._gather(used))
        self.first, self.count = _Column(np.cumsum(count, dtype=np.int64) - count), _Column(count)
        self.parts = _Numbers()
        self.parts.update(zip(parts, range(len(parts)), strict=True))
        self.hits, self.bytes = _Column(np.ones(len(parts), np.int64)), size

    def _learn(self) -> None:
        """Ids of the parts numbered since the last call."""
        new, self.parts.new = self.parts.new, []
        if not new:
            return
        self.bytes += sum(map(len, new))
        new = [p.decode("utf-8", "replace") for p in new]
        # letters only is one word to the tokenizer, so many can be encoded as one text and told apart by the ends of words
        letters = np.fromiter((p.isalpha() for p in new), bool, len(new))
        plain, other = np.flatnonzero(letters), np.flatnonzero(~letters)
        first, count = np.zeros(len(new), np.int64), np.zeros(len(new), np.int32)
        if len(plain):
            texts = [new[k] for k in plain.tolist()]
            ids, sizes = self._ids([" ".join(texts[k : k + JOINED]) for k in range(0, len(texts), JOINED)])
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            wanted = np.minimum(JOINED, len(texts) - np.arange(0, len(texts), JOINED))
            found = np.diff(np.searchsorted(ends, np.r_[0, np.cumsum(sizes)], "right"))
            good = np.repeat(found == wanted, wanted)  # of each word: its text has an end for each word
            ends = ends[np.repeat(found == wanted, found)]
            sure = plain[good]
            begins = np.r_[0, ends[:-1]] if good.all() else self._begins(ends, sizes, found == wanted, wanted)
            first[sure], count[sure] = self.flat.size + begins, ends - begins
            self.flat.extend(ids)
            other = np.r_[other, plain[~good]]
        if len(other):
            ids, sizes = self._ids([new[k] for k in other.tolist()])
            first[other], count[other] = self.flat.size + np.cumsum(sizes) - sizes, sizes
            self.flat.extend(ids)
        self.first.extend(first)
        self.count.extend(count)
        self.hits.extend(np.zeros(len(new), np.int64))

    @staticmethod
    def _begins(ends: np.ndarray, sizes: np.ndarray, good: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Where the words of the good texts begin: at the end of the word before, or at the start of their text."""
        begins = np.r_[0, ends[:-1]]
        heads = np.cumsum(wanted[good]) - wanted[good]
        begins[heads] = (np.cumsum(sizes) - sizes)[good]
        return begins

    def _gather(self, parts: np.ndarray) -> np.ndarray:
        first, count = self.first.values[parts], self.count.values[parts]
        ends = np.cumsum(count)
        return self.flat.values[np.repeat(first - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)]

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=offsets[1:])
        return self.encode_bytes(np.frombuffer(b"".join(texts), np.uint8), offsets)

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of the texts that lie in ``data`` between ``offsets``; distinct words are looked up once."""
        if len(self.parts) > self.cached or self.bytes > 16 * self.cached:
            self.trim(self.cached // 2)
        own = pa.py_buffer(np.ascontiguousarray(offsets - offsets[0]))
        texts = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, own, pa.py_buffer(_LOWER[data[int(offsets[0]) : int(offsets[-1])]])])
        split = pc.ascii_split_whitespace(texts)
        bounds, words = split.offsets.to_numpy(), split.values.dictionary_encode()
        at, distinct = words.indices.to_numpy(), words.dictionary.cast(pa.large_binary())
        content, ends = batch_bytes(distinct)
        empty, number = ends[1:] == ends[:-1], self.parts.__getitem__
        marked = np.zeros(len(distinct), bool)
        marked[~empty] = _MARK[content[ends[1:][~empty] - 1]]
        distinct = distinct.to_pylist()
        halves = np.empty((len(distinct), 2), np.int64)
        plain = np.flatnonzero(~marked)
        halves[plain, 0] = np.fromiter((number(distinct[k]) for k in plain.tolist()), np.int64, len(plain))
        halves[:, 1] = number(b"")
        for k in np.flatnonzero(marked).tolist():
            word = distinct[k]
            core = word.rstrip(MARKS)
            if core[-1:] in _ASCII_LETTERS or core[-4:].decode("utf-8", "ignore")[-1:].isalpha():
                halves[k] = number(core), number(word[len(core) :])
            else:
                halves[k, 0] = number(word)
        self._learn()
        np.add.at(self.hits.values, halves.ravel(), np.repeat(np.bincount(at, minlength=len(distinct)), 2))
        parts = halves[at]  # white space at either end of a text gives an empty word, which has no ids
        cuts = np.zeros(len(at) + 1, np.int64)
        np.cumsum(self.count.values[halves].sum(axis=1)[at], out=cuts[1:])
        ids, cuts = self._gather(parts.ravel()), cuts[bounds]
        return [ids[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


class SquaresPacker:
    """Places items online where the sum of squared counts of partially filled windows grows least.

    ``count[level]`` is the number of windows filled up to ``level``. Among equal choices the fullest window is taken.
    """

    def __init__(self, length: int) -> None:
        self.length = length
        self.count = np.zeros(length + 1, np.int64)
        self.windows: dict[int, list[list]] = {}
        self.open = 0

    def place(self, need: int, item) -> list | None:
        """Puts ``item`` of ``need`` (below the length) into a window; returns the window's items once it is full."""
        room = self.length - need
        here, there = self.count[1 : room + 1], self.count[need + 1 :]
        # one window less at the old level, one more at the new one; none more where it becomes full
        cost = np.where(here > 0, 2 * (there - here) + 2, np.iinfo(np.int64).max)
        if here[room - 1] > 0:
            cost[room - 1] = 1 - 2 * here[room - 1]
        best = room - 1 - int(np.argmin(cost[::-1]))
        if cost[best] < 2 * self.count[need] + 1:
            window = self._take(best + 1)
            level = best + 1 + need
        else:
            window, level = [], need
        window.append(item)
        if level == self.length:
            return window
        self._put(level, window)
        return None

    def _put(self, level: int, window: list) -> None:
        self.windows.setdefault(level, []).append(window)
        self.count[level] += 1
        self.open += 1

    def _take(self, level: int) -> list:
        self.count[level] -= 1
        self.open -= 1
        return self.windows[level].pop()

    def drain(self) -> list:
        """The items of all open windows, fullest first; no window is open afterwards."""
        items = [i for level in sorted(self.windows, reverse=True) for w in self.windows[level] for i in w]
        self.count[:] = 0
        self.windows, self.open = {}, 0
        return items


def pack(items: Iterator[tuple[object, np.ndarray]], length: int = LENGTH, most_open: int = MOST_OPEN) -> Iterator[list[tuple[object, int, np.ndarray, int]]]:
    """Windows as lists of (key, start, ids, total of the key), from (key, ids) in order.

    An item fills whole windows by itself as often as it can, its rest is placed by ``SquaresPacker``. Once more than
    ``most_open`` windows are open, and at the end, what the open ones hold is laid end to end and cut into full windows,
    the last of which stays open; at the end it is cut into powers of two, which need no padding.
    """
    packer = SquaresPacker(length)

    def relay() -> Iterator[list]:
        held, used = [], 0
        for key, start, ids, total in packer.drain():
            while len(ids):
                part = ids[: length - used]
                held.append((key, start, part, total))
                used, start, ids = used + len(part), start + len(part), ids[len(part) :]
                if used == length:
                    yield held
                    held, used = [], 0
        if held:
            packer._put(used, held)

    for key, ids in items:
        whole = len(ids) // length * length
        for start in range(0, whole, length):
            yield [(key, start, ids[start : start + length], len(ids))]
        if whole < len(ids):
            full = packer.place(len(ids) - whole, (key, whole, ids[whole:], len(ids)))
            if full:
                yield full
            if packer.open > most_open:
                yield from relay()
    yield from relay()
    rest = packer.drain()
    left = sum(len(p[2]) for p in rest)
    while left:
        size = 1 << (left.bit_length() - 1)
        held, used = [], 0
        while used < size:
            key, start, ids, total = rest.pop(0)
            part = ids[: size - used]
            held.append((key, start, part, total))
            used += len(part)
            if len(part) < len(ids):
                rest.insert(0, (key, start + len(part), ids[len(part) :], total))
        yield held
        left -= size


_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_tokens: dict[str, WordTokens] = {}


def _packed(path: str, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _tokens:  # stays in the worker for its later tasks, with few words
            _tokens[path] = WordTokens(path)
        encoder = _tokens[path]
        encoder.trim(KEPT_WORDS)
        sequence = TaskContext.get().partitionId() << 36

        def items() -> Iterator[tuple[object, np.ndarray]]:
            for b in batches:
                keys, (data, offsets) = b.column(0).to_pylist(), batch_bytes(b.column(1))
                for i, j in chunks(offsets, CHUNK_BYTES):
                    for key, ids in zip(keys[i:j], encoder.encode_bytes(data, offsets[i : j + 1]), strict=True):
                        yield key, np.append(ids, np.uint32(end))
            encoder.trim(KEPT_WORDS)
            pa.default_memory_pool().release_unused()

        rows: list[tuple] = []
        held = 0
        for window in pack(items(), length):
            offset = 0
            for key, start, ids, total in window:
                rows.append((key, start, len(ids), ids.astype("<u4").tobytes(), total, sequence, offset))
                offset += len(ids)
                held += 4 * len(ids) + 100
            sequence += 1
            if held > 8 << 20:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in _PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def pack_documents(rows: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", length: int = LENGTH, end: int = END) -> DataFrame:
    """Per piece: doc_id, start, length, ids (little-endian unsigned 32 bits), doc_tokens, sequence_id, offset.

    Every document's ids, with ``end`` after them, lie in exactly one piece each. A sequence belongs to the task that
    packs it, so nothing is shuffled; each task ends with at most log2(length) short sequences, powers of two. The
    result is the same each time as long as the rows come in the same partitions and order, as they do from files.

    Null and empty texts are the end id alone. Null keys and repeated rows are packed like any other. Long texts
    fill as many sequences as they need. No rows: no pieces. Other columns are not read.
    """
    narrow = rows.select(F.col(key).cast("long").alias("doc_id"), utf8(text).alias("content"))
    return narrow.mapInArrow(_packed(tokenizer, length, end), _PIECES)


def op8_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    import public_tokenizers

    pieces = pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
