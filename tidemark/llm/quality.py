"""Quality by attention-based multiple-instance learning: gated attention over encoded passages, labels on documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.base import batch_bytes, chunks, documents, remainder, unit_hash, utf8

PASSAGE = 96  # words
SHAPES = 192
WORDS = 64
FEATURES = SHAPES + WORDS + 6
HIDDEN, ATTENTION = 24, 16
SAMPLE = 3000  # labelled documents of each class that the model is fitted on
SAMPLE_BYTES = 48 << 20  # of their texts at most; no row has more than a hundredth
CHUNK_BYTES = 1 << 20
EPOCHS, BATCH, RATE, DECAY = 24, 128, 0.01, 1e-4
SEED = 11

# classes of bytes: each mark by itself, letters, digits and the rest together
_CLASS = np.zeros(256, np.uint32)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[32, 9, 11, 12, 13]] = 4
_CLASS[10] = 5
_CLASS[128:] = 6
_marks = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_marks] = np.arange(7, 7 + len(_marks))
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64))
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of ``PASSAGE`` words of the texts in a buffer, and the first passage of each text.

    Per passage: square roots of the shares of hashed pairs of byte classes and of hashed lower-case words, and the
    shares of distinct words, of words equal to the one before, of words in capitals, the mean word length, lines for
    each word and the logarithm of the number of words. A text without words has one passage of zeros.
    """
    texts = len(offsets) - 1
    if not texts:
        return np.zeros((0, FEATURES), np.float32), np.zeros(1, np.int64)
    lengths = np.diff(offsets) + 1
    data = np.frombuffer(b"\n".join([*(data[i:j].tobytes() for i, j in zip(offsets[:-1], offsets[1:], strict=True)), b""]), np.uint8)
    blank = _SPACE[data]
    first = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    text_of_byte = np.repeat(np.arange(texts), lengths)
    owner = text_of_byte[first]
    per_text = np.bincount(owner, minlength=texts)
    passages = np.maximum(1, -(-per_text // PASSAGE))
    begins = np.r_[0, np.cumsum(passages)]
    out = np.zeros((int(begins[-1]), FEATURES), np.float32)
    if not len(first):
        return out, begins
    number = np.arange(len(first)) - np.r_[0, np.cumsum(per_text)][owner]
    passage = begins[owner] + number // PASSAGE
    # bytes: white space goes with the word before it, or with none at the start of a text
    run = np.diff(np.r_[first, len(data)])
    inside = np.arange(len(data) - first[0]) - np.repeat(first - first[0], run)
    tail = data[first[0] :]
    of_byte = np.repeat(passage, run)
    shape = _CLASS[tail].astype(np.uint32)
    pairs = (shape[:-1] * np.uint32(40) + shape[1:]) * np.uint32(2654435761)
    texts_of = text_of_byte[first[0] :]
    own = texts_of == np.repeat(owner, run)
    both = np.flatnonzero(own[:-1] & own[1:] & (texts_of[:-1] == texts_of[1:]))
    _shares(out, 0, SHAPES, of_byte[both], ((pairs >> np.uint32(8)) % np.uint32(SHAPES))[both])
    solid = ~blank[first[0] :]
    letters = np.where(solid, (_LOWER[tail] + np.uint64(1)) * _POWERS[np.minimum(inside, 63)], np.uint64(0))
    heads = first - first[0]
    with np.errstate(over="ignore"):
        words = np.add.reduceat(letters, heads)
        words = (words ^ (words >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    words ^= words >> np.uint64(32)
    _shares(out, SHAPES, WORDS, passage, words % np.uint64(WORDS))
    count = np.maximum(1, np.bincount(passage, minlength=len(out))).astype(np.float32)
    length = np.add.reduceat(solid.astype(np.int32), heads)
    capital = np.add.reduceat((shape == 2).astype(np.int32), heads)
    order = np.lexsort((words, passage))
    new = np.r_[True, (words[order][1:] != words[order][:-1]) | (passage[order][1:] != passage[order][:-1])]
    same = np.r_[False, (words[1:] == words[:-1]) & (passage[1:] == passage[:-1])]
    at = SHAPES + WORDS
    for k, values in enumerate((new[np.argsort(order, kind="stable")], same, (capital == length) & (length > 1), length / 10)):
        out[:, at + k] = np.bincount(passage, values, len(out)) / count
    out[:, at + 4] = np.bincount(of_byte, (shape == 5) & own, len(out)) / count
    out[:, at + 5] = np.where(out[:, :SHAPES].any(axis=1), np.log1p(count) / 5, 0)
    return out, begins


def _shares(out: np.ndarray, at: int, width: int, row: np.ndarray, column: np.ndarray) -> None:
    found = np.bincount(row * width + column.astype(np.int64), minlength=len(out) * width).reshape(len(out), width)
    out[:, at : at + width] = np.sqrt(found / np.maximum(1, found.sum(axis=1, keepdims=True)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class AttentionModel:
    """h = tanh(x E + e) for each passage, weight = softmax over the text of w (tanh(h V) * sigmoid(h U)),
    score = sigmoid of a linear function of the weighted sum of h."""

    def __init__(self, seed: int = SEED) -> None:
        g = np.random.default_rng(seed)
        scale = lambda a, b: (g.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.p = {"E": scale(FEATURES, HIDDEN), "e": np.zeros(HIDDEN, np.float32), "V": scale(HIDDEN, ATTENTION), "U": scale(HIDDEN, ATTENTION), "w": scale(ATTENTION, 1)[:, 0], "o": scale(HIDDEN, 1)[:, 0], "b": np.zeros(1, np.float32)}
        self.mean, self.spread = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)

    def _forward(self, x: np.ndarray, begins: np.ndarray) -> dict:
        p, heads, sizes = self.p, begins[:-1], np.diff(begins)
        h = np.tanh(x @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        a = (t * s) @ p["w"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, heads), sizes))
        a /= np.repeat(np.add.reduceat(a, heads), sizes)
        z = np.add.reduceat(a[:, None] * h, heads, axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "score": _sigmoid(z @ p["o"] + p["b"])}

    def score(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.spread, begins)["score"]

    def attention(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.spread, begins)["a"]

    def gradients(self, x: np.ndarray, begins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict:
        """Of the weighted mean cross-entropy."""
        p, f, sizes = self.p, self._forward(x, begins), np.diff(begins)
        d = ((f["score"] - label) * weight / weight.sum()).astype(np.float32)
        dz = np.repeat(d[:, None] * p["o"], sizes, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        dl = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, begins[:-1]), sizes))
        dt, ds = dl[:, None] * p["w"] * f["s"], dl[:, None] * p["w"] * f["t"]
        dt *= 1 - f["t"] ** 2
        ds *= f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
        return {"E": x.T @ dh, "e": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ dl, "o": f["z"].T @ d, "b": d.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> AttentionModel:
        """Adam over batches of texts, both classes weighted alike. Without one of the classes the score is the other's label,
        without any label 0.5."""
        labels = np.asarray(labels, np.float32)
        share = labels.mean() if len(labels) else 0.5
        if share in (0.0, 1.0) or not len(labels):
            self.p["o"][:] = 0
            self.p["b"][:] = {0.0: -10.0, 1.0: 10.0}.get(float(share), 0.0)
            return self
        stacked = np.concatenate(bags)
        self.mean, self.spread = stacked.mean(axis=0), stacked.std(axis=0) + np.float32(0.02)
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        g, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            order = g.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                chosen = order[i : i + BATCH]
                x = (np.concatenate([bags[k] for k in chosen]) - self.mean) / self.spread
                grads = self.gradients(x, np.r_[0, np.cumsum([len(bags[k]) for k in chosen])], labels[chosen], weight[chosen])
                step += 1
                for k, d in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8) + DECAY * self.p[k])).astype(np.float32)
        return self


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = batch_bytes(b.column(1))
        bags = []
        for i, j in chunks(offsets, CHUNK_BYTES):
            x, begins = encode(data, offsets[i : j + 1])
            for k in range(j - i):
                bags.append(x[begins[k] : begins[k + 1]].tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bags, pa.binary()), b.column(2)], names=["label", "bag", "key"])


def train(
    rows: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES
) -> AttentionModel:
    """A model fitted on all passages of up to ``sample`` labelled rows of each class, those with the least hash of the key.

    Null keys, null labels, labels other than 0 and 1, and keys with both labels teach nothing. What reaches the
    driver is bounded by the sample, a sample of rows: rows join it by their hash while their whole texts have at most
    ``sample_bytes`` together; rows with over a hundredth of that are not in it. Features take some twice the bytes.
    """
    clear = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(label).cast("int").alias("_label"), F.max(label).cast("int").alias("_other"))
        .filter("_label = _other")
        .drop("_other")
    )
    narrow = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), utf8(text).alias("_text"))
    sizes = narrow.groupBy("_key").agg(F.max(F.octet_length("_text")).alias("_bytes")).filter(F.col("_bytes") <= sample_bytes // 100)
    known = sizes.join(clear, "_key").withColumn("_u", unit_hash(F.col("_key"), F.lit(SEED)))
    least = [known.filter(F.col("_label") == k).orderBy("_u", "_key").limit(sample) for k in (0, 1)]
    # at most 2 * sample rows of numbers
    before = F.sum("_bytes").over(Window.partitionBy(F.lit(0)).orderBy("_u", "_key"))
    chosen = least[0].union(least[1]).withColumn("_sum", before).filter(F.col("_sum") <= sample_bytes).select("_key", "_label")
    picked = narrow.join(F.broadcast(chosen), "_key").dropDuplicates(["_key"]).select("_label", "_text", F.col("_key").cast("string"))
    found = picked.mapInArrow(_bags, "label int, bag binary, key string").orderBy("key").toArrow()
    bags = [np.frombuffer(x.as_py(), np.float32).reshape(-1, FEATURES) for x in found.column("bag")]
    return AttentionModel().fit(bags, np.array(found.column("label").to_pylist(), np.float32))


def score(rows: DataFrame, model: AttentionModel, text: str = "text") -> DataFrame:
    """``rows`` without the text, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Every passage of every whole text is encoded and weighed. Null texts count as empty; texts without words have one
    empty passage and so all the same score. Equal texts have equal scores but for rounding. No rows: no rows. Columns
    named ``score`` or ``predicted`` are replaced.
    """
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in rows.columns if c not in (text, "score", "predicted")]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), "score double, predicted int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = batch_bytes(b.column(len(kept)))
            scores = [np.zeros(0)]
            for i, j in chunks(offsets, CHUNK_BYTES):
                scores.append(sent.value.score(*encode(data, offsets[i : j + 1])))
            s = np.concatenate(scores).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*kept, "score", "predicted"])

    return rows.select(*kept, utf8(text).alias("_text")).mapInArrow(run, schema)


def accepted(rows: DataFrame, model: AttentionModel, text: str = "text") -> DataFrame:
    """The rows whose text scores 0.5 or more, with all their columns. Cases as in ``score``."""
    sent, at = rows.sparkSession.sparkContext.broadcast(model), rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = batch_bytes(b.column(at))
            scores = [np.zeros(0)]
            for i, j in chunks(offsets, CHUNK_BYTES):
                scores.append(sent.value.score(*encode(data, offsets[i : j + 1])))
            yield b.filter(pa.array(np.concatenate(scores) >= 0.5))

    return rows.mapInArrow(run, rows.schema)


def op1_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of those whose remainder is not 1."""
    docs = documents(spark, sf_dir).withColumn("held_out", remainder(3) == 1)
    model = train(docs.filter("NOT held_out"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "held_out", "text"), model)
