"""Statistics of views and tables, and the size gate in front of full reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import is_hidden
from tidemark.operators.views import KEY

# Megabytes up to which a dataset is read in full, and rows of a sample.
SIZE_THRESHOLD_MB = 500
SAMPLE_ROWS = 5000


def dataset_stats(files: DataFrame) -> DataFrame:
    """Size and file counts of each view, hidden files apart, and the transactions that wrote its files.

    Files are first reduced per transaction, so that counting transactions needs no distinct over files.
    """
    hidden = is_hidden(F.col("path"))
    per_transaction = files.groupBy(*KEY, "seq").agg(
        F.sum("length").alias("bytes"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(hidden, F.col("length")).otherwise(F.lit(0))).alias("hidden_bytes"),
        F.count_if(hidden).alias("hidden_n"),
    )
    return per_transaction.groupBy(*KEY).agg(
        (F.sum("bytes") - F.sum("hidden_bytes")).alias("size_in_bytes"),
        (F.sum("n") - F.sum("hidden_n")).alias("num_files"),
        F.sum("hidden_bytes").alias("hidden_files_size_in_bytes"),
        F.sum("hidden_n").alias("num_hidden_files"),
        F.count(F.lit(1)).alias("num_transactions"),
    )


def _unpivoted(df: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(f.name).alias("column"), _as_text(f).alias("value")) for f in df.schema]
    return df.select(F.inline(F.array(*pairs)))


def _as_text(field: T.StructField) -> Column:
    """The text form of a column of any type; of bytes their base64, of maps their entries in order of the keys."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        return F.base64(column)
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(column)).cast("string")
    return column.cast("string")


def column_stats(df: DataFrame) -> DataFrame:
    """Exact nullCount, uniqueCount, avgLength and maxLength (of the text form) per column.

    One pass: values are counted per (column, value) with a map-side part, which also defuses hot values, and
    the counts give all four numbers. Only distinct values are shuffled.
    """
    counted = _unpivoted(df).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    length = F.length("value")
    return counted.groupBy("column").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(F.lit(0))).alias("null_count"),
        F.count("value").alias("unique_count"),
        (F.sum(length * F.col("n")) / F.sum(F.when(F.col("value").isNotNull(), F.col("n")))).alias("avg_length"),
        F.max(length).alias("max_length"),
    )


def column_stats_approx(df: DataFrame, rsd: float = 0.05) -> DataFrame:
    """As :func:`column_stats`, but with sketched unique counts: one aggregation without a shuffle of values."""
    aggregates = []
    for field in df.schema:
        name, text = field.name, _as_text(field)
        countable = text if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f"`{name}`")
        aggregates.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(text.isNull()).alias("null_count"),
                F.approx_count_distinct(countable, rsd).alias("unique_count"),
                F.avg(F.length(text)).alias("avg_length"),
                F.max(F.length(text)).alias("max_length"),
            )
        )
    return df.agg(F.array(*aggregates).alias("stats")).select(F.inline("stats"))


def size_in_mb(size: Column) -> Column:
    return F.round(size / F.lit(1024) / F.lit(1024), 2)


def size_gate(
    stats: DataFrame, *, size: str = "size_in_bytes", threshold_mb: float = SIZE_THRESHOLD_MB, force_full: bool = False
) -> DataFrame:
    """Whether each dataset is read in full or sampled: below the threshold, or forced, means full."""
    full = (F.col(size) / F.lit(1024) / F.lit(1024) < threshold_mb) | F.lit(force_full)
    return stats.withColumn("size_mb", size_in_mb(F.col(size))).withColumn(
        "read_mode", F.when(full, F.lit("FULL")).otherwise(F.lit("SAMPLE"))
    )


def sample_first(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``n`` rows in no particular order.

    Partitions are read one after another until there are enough rows, and those few rows become the frame. A
    ``limit`` inside a larger plan would take up to ``n`` rows of every partition to a single task instead.
    """
    return df.sparkSession.createDataFrame(df.take(n), df.schema)


def sample_random(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = 7) -> DataFrame:
    """``n`` rows drawn at random: the same rows as ``ORDER BY rand(seed) LIMIT n``.

    One scan: every task keeps its ``n`` smallest draws, nothing is sorted as a whole.
    """
    return df.withColumn("__draw", F.rand(seed)).orderBy("__draw").limit(n).drop("__draw")
