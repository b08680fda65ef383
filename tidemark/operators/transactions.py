"""Questions on the transaction log (same columns as the file operations, see ``views``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import is_hidden, under
from tidemark.operators.views import (
    KEY,
    TRANSACTION_STATUS,
    TRANSACTION_TYPES,
    decode,
    encode,
    with_status,
)


# The setting up to which Spark cuts windows off before their shuffle; for more rows a key, rows are spread over so many parts.
GROUP_LIMIT, SPREAD = "spark.sql.optimizer.windowGroupLimitThreshold", 64


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each key in ``order``, with their 1-based rank.

    The ``rank <= n`` filter makes Spark keep at most ``n`` rows per key in each map task before the shuffle
    (window group limit), so a hot key never reaches one task as a whole. Spark does so below a threshold of the session,
    which is left as it is; for larger pages the rows of a key are first cut to ``n`` in each of several parts, so that
    at most ``SPREAD`` times ``n`` of them meet.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    if n < int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
    part = F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]), F.lit(SPREAD))
    spread = Window.partitionBy(*keys, "__part").orderBy(*order)
    cut = df.withColumn("__part", part).withColumn(rank, F.row_number().over(spread)).where(F.col(rank) <= n).drop("__part")
    return cut.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def last_transactions(transactions: DataFrame, *, include_open: bool = False, keys: list[str] = KEY) -> DataFrame:
    """Newest transaction per key: seq, type, status. Aborted ones never count."""
    return (
        with_status(transactions, include_open)
        .groupBy(*keys)
        .agg(
            F.max("seq").alias("seq"),
            F.max_by(encode(F.col("type"), TRANSACTION_TYPES), F.col("seq")).alias("type_code"),
            F.max_by(encode(F.col("status"), TRANSACTION_STATUS), F.col("seq")).alias("status_code"),
        )
        .select(
            *keys,
            "seq",
            decode(F.col("type_code"), TRANSACTION_TYPES).alias("type"),
            decode(F.col("status_code"), TRANSACTION_STATUS).alias("status"),
        )
    )


def open_transactions(transactions: DataFrame) -> DataFrame:
    """The last transaction per dataset and branch where it is still open."""
    return last_transactions(transactions, include_open=True).where(F.col("status") == "OPEN")


def reverse_transactions(
    transactions: DataFrame,
    page_size: int,
    *,
    end: int | Column | None = None,
    include_open: bool = False,
    columns: tuple[str, ...] = ("seq", "type", "status"),
) -> DataFrame:
    """Newest ``page_size`` transactions per dataset and branch, going back to ``end`` at most."""
    rows = with_status(transactions, include_open)
    if end is not None:
        rows = rows.where(F.col("seq") >= end)
    return top_per_key(rows.select(*KEY, *columns), KEY, [F.col("seq").desc()], page_size, "position")


def transaction_metadata(files: DataFrame, keys: list[str]) -> DataFrame:
    """File counts and sizes per transaction, hidden files counted apart."""
    hidden = is_hidden(F.col("path"))
    return files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("length").alias("total_file_size"),
        F.count_if(hidden).alias("hidden_file_count"),
        F.sum(F.when(hidden, F.col("length")).otherwise(F.lit(0))).alias("total_hidden_file_size"),
    )


def log_violations(transactions: DataFrame) -> DataFrame:
    """Breaches of the log rules per dataset and branch: more than one open transaction, or one not at the end."""
    opened = F.col("status") == "OPEN"
    found = transactions.groupBy(*KEY).agg(
        F.count_if(opened).alias("open_count"),
        F.max(F.when(F.col("status") == "COMMITTED", F.col("seq"))).alias("last_committed"),
        F.min(F.when(opened, F.col("seq"))).alias("first_open"),
    )
    overtaken = F.coalesce(F.col("first_open") < F.col("last_committed"), F.lit(False))
    return found.where((F.col("open_count") > 1) | overtaken).select(
        *KEY, "open_count", (F.col("open_count") > 1).alias("many_open"), overtaken.alias("open_overtaken")
    )


def duplicate_puts(files: DataFrame, keys: list[str]) -> DataFrame:
    """Paths put more than once in the same transaction."""
    return files.groupBy(*keys, "path").agg(F.count(F.lit(1)).alias("puts")).where(F.col("puts") > 1)


def remove_from_open(files: DataFrame, removals: list[tuple[str, bool]]) -> DataFrame:
    """Drop files of open transactions: an exact path always, a folder's files only when recursive.

    A removal that matches nothing is ignored; committed and aborted rows are never touched.
    """
    hit = F.lit(False)
    for path, recursive in removals:
        hit = hit | (F.col("path") == path)
        if recursive:
            hit = hit | under(F.col("path"), path)
    return files.where(~((F.col("status") == "OPEN") & hit))


def provenance_edges(transactions: DataFrame, provenance: str = "provenance") -> DataFrame:
    """One row per input of a transaction: (rid, seq) reads input_rid over [input_start, input_end]."""
    doc = F.from_json(
        F.col(provenance),
        "provenanceRecords array<struct<datasetRid string, transactionRange struct<start bigint, `end` bigint>>>",
    )
    record = F.explode(doc.getField("provenanceRecords")).alias("record")
    return transactions.select("rid", "seq", record).select(
        "rid",
        "seq",
        F.col("record.datasetRid").alias("input_rid"),
        F.col("record.transactionRange.start").alias("input_start"),
        F.col("record.transactionRange.end").alias("input_end"),
    )
