"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import documents, remainder

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
SLICE = 1 << 19
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_PRIORS = -1


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, two zeros after each, other ASCII than letters as spaces; and where each starts."""
    lowered = [t.replace("\0", " ").lower() for t in texts]
    codes = np.frombuffer("\0\0".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (codes < 128) & (codes != 0) & ~((codes >= 97) & (codes <= 122))
    starts = np.cumsum([0, *(len(t) + 2 for t in lowered[:-1])], dtype=np.int64)
    return np.where(blank, np.uint32(32), codes), starts


def _buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram at each position; one beyond the last where it would leave its text."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    mixed, whole = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32), np.ones(n, bool)
    for k in range(order):
        part = codes[k : k + n]
        whole &= part != 0
        mixed = (mixed ^ part) * np.uint32(0x01000193) + (mixed >> np.uint32(15))
    mixed ^= mixed >> np.uint32(13)
    mixed *= np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(16)
    return np.where(whole, mixed & np.uint32(BUCKETS - 1), np.uint32(BUCKETS)).astype(np.int64)


def _slices(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Slices with an overlap, so that memory is bounded whatever the length of a text, and each n-gram comes once."""
    for first in range(0, len(codes), SLICE):
        for order in ORDERS:
            yield first, _buckets(codes[first : first + SLICE + order - 1], order)


def _groups(texts: list[str], limit: int = SLICE) -> Iterator[tuple[int, int]]:
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) + 2
        if held > limit:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    priors: dict[str, int] = {}
    for b in batches:
        for lang, texts in b.groupby("lang")["text"]:
            texts = texts.tolist()
            total = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            priors[lang] = priors.get(lang, 0) + len(texts)
            for i, j in _groups(texts):
                for _, found in _slices(_codes(texts[i:j])[0]):
                    total += np.bincount(found, minlength=BUCKETS + 1)
    for lang, total in counts.items():
        used = np.flatnonzero(total[:BUCKETS])
        yield pd.DataFrame({"lang": lang, "bucket": np.r_[_PRIORS, used], "count": np.r_[priors[lang], total[used]]})


class Model:
    """Log-probabilities (buckets + 1, languages), the last row zero; log-priors; the languages."""

    def __init__(self, counts: pd.DataFrame) -> None:
        self.langs = sorted(counts["lang"].unique())
        at = {lang: i for i, lang in enumerate(self.langs)}
        table, priors = np.zeros((BUCKETS, len(self.langs))), np.zeros(len(self.langs))
        prior = counts["bucket"].to_numpy() == _PRIORS
        column = counts["lang"].map(at).to_numpy(np.int64)
        priors[column[prior]] = counts["count"].to_numpy()[prior]
        table[counts["bucket"].to_numpy()[~prior], column[~prior]] = counts["count"].to_numpy()[~prior]
        logs = np.log((table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * BUCKETS))
        self.logs = np.vstack([logs, np.zeros(len(self.langs))]).astype(np.float32)
        self.priors = np.log(priors / max(1, priors.sum())) if len(priors) else priors

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log of prior times likelihood, a row for each text: sparse counts times the matrix, summed position by position."""
        out = np.tile(self.priors, (len(texts), 1))
        for i, j in _groups(texts):
            codes, starts = _codes(texts[i:j])
            for first, found in _slices(codes):
                if not len(found):
                    continue
                low = int(np.searchsorted(starts, first, "right")) - 1
                cuts = np.maximum(starts[low : int(np.searchsorted(starts, first + len(found)))] - first, 0)
                out[i + low : i + low + len(cuts)] += np.add.reduceat(self.logs[found], cuts, axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = np.array([bool(t) and _LETTER.search(t) is not None for t in texts], bool) & bool(self.langs)
        names, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
        where = np.flatnonzero(known)
        if len(where):
            logs = self.scores([texts[k] for k in where])
            best = logs.argmax(axis=1)
            sure[where] = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            for k, b in zip(where.tolist(), best.tolist(), strict=True):
                names[k] = self.langs[b]
        return names, sure


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all labelled rows, added up in tasks and by Spark; what reaches the driver is bounded by buckets times languages."""
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = rows.mapInPandas(_count, "lang string, bucket int, count long")
    return Model(counted.groupBy("lang", "bucket").agg(F.sum("count").alias("count")).toPandas())


def identify(rows: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``rows`` without the text, with ``lang_pred`` and ``score`` (the probability of the prediction).

    Null texts, texts without a letter, and all texts if nothing was learned: ``und`` with score 0. Ties go to the language that
    sorts first. Repeated and very long texts are like any other; no rows give no rows. A column named ``lang_pred`` or ``score`` is replaced.
    """
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in rows.columns if c not in (text, "lang_pred", "score")]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), "lang_pred string", "score double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names, sure = sent.value.predict([None if t is None else t for t in b[text].tolist()])
            yield b[kept].assign(lang_pred=names, score=sure)

    return rows.select(*kept, text).mapInPandas(run, schema)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those whose remainder is not 2."""
    docs = documents(spark, sf_dir).withColumn("held_out", remainder(4) == 2)
    return identify(docs.select("doc_id", "held_out", "text"), fit(docs.filter("NOT held_out")))
