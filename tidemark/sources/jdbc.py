"""Extracts from databases, and tables registered in place."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def extract(
    spark: SparkSession,
    url: str,
    query: str,
    *,
    pre_queries: list[str] | None = None,
    timestamps_as_text: bool = True,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Result of a query run by the database.

    ``pre_queries`` run once per connection. With ``partition_column`` and ``bounds`` the rows are fetched over
    many connections, one per range; otherwise one task reads them all, which suits small results only.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if pre_queries:
        reader = reader.option("sessionInitStatement", "; ".join(pre_queries))
    if partition_column:
        low, high = bounds
        reader = (
            reader.option("dbtable", f"({query}) extracted")
            .option("partitionColumn", partition_column)
            .option("lowerBound", str(low))
            .option("upperBound", str(high))
            .option("numPartitions", str(partitions))
        )
    else:
        if partitions > 1:
            warnings.warn("without a partition column the extract runs in one task", stacklevel=2)
        reader = reader.option("query", query)
    frame = reader.load()
    return plain_timestamps_as_text(frame) if timestamps_as_text else frame


def plain_timestamps_as_text(df: DataFrame) -> DataFrame:
    """Timestamps without a time zone as ISO text, so that no zone is guessed for them."""
    return df.select(
        *[
            F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def register_external(spark: SparkSession, name: str, fmt: str, location: str | None = None, **options: str) -> None:
    """Register files or a source as a table that is read in place: CREATE TABLE ... USING fmt."""
    extra = f" OPTIONS ({', '.join(f'{k!r} {v!r}' for k, v in options.items())})" if options else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} USING {fmt}{extra}{where}")


def list_external(spark: SparkSession, database: str = "default") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
