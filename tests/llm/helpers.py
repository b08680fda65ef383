"""Small tables for the tests of the corpus operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \t\n", "a", "a", "Ünïcödé ßtraße 日本語", "x " * 20_000, "one two three four five six seven " * 40]


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns with clashing names."""
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(ODD)]
    rows += [(None, "null id", None, None, None), (3, "a", "en", "s0", 1), (3, "a", "en", "s0", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "'x' AS shard", "1L AS rid", "2L AS n", "'y' AS size", "3 AS rank", "'z' AS content")


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(rng: random.Random, n: int, letters="abcdefgh") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def crc_remainder(doc_id, modulus):
    import zlib

    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus
