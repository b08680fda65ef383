"""Writers: parquet version folders, CSV export, and the targets a result can be handed over in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources import schema as docs

# Fixed value: the compression of written parquet.
PARQUET_COMPRESSION = "snappy"

# The forms a query result can be returned in.
RETURN_TYPES = ["pandas", "polars", "spark", "arrow", "raw"]


def write_version(
    df: DataFrame, path: str, *, fmt: str = "parquet", partition_by: list[str] | None = None, options: dict | None = None
) -> None:
    """Write one version folder in parallel; fails if it exists, so a version is never changed afterwards."""
    options = {"compression": PARQUET_COMPRESSION, **(options or {})} if fmt == "parquet" else (options or {})
    writer = df.write.format(fmt).mode("errorifexists").options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def export_csv(df: DataFrame, path: str, *, header: bool = True, bom: bool = False, **options: str) -> None:
    """CSV part files, each with the optional header and byte order mark at its start."""
    if bom:
        first, *rest = df.columns
        if header:
            df = df.withColumnRenamed(first, "\ufeff" + first)
        else:
            # the low 33 bits of this id count the rows of a partition, and a partition becomes a file
            row_in_part = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
            mark = F.when(row_in_part == 0, F.lit("\ufeff")).otherwise(F.lit(""))
            df = df.select(F.concat(mark, F.coalesce(F.col(first).cast("string"), F.lit(""))).alias(first), *rest)
    df.write.options(header=str(header).lower(), **options).csv(path)


def csv_lines(df: DataFrame, **options: str) -> DataFrame:
    """The rows as CSV text, one line per row."""
    return df.select(F.to_csv(F.struct(*df.columns), options or None).alias("line"))


def json_row(columns: list[Column]) -> Column:
    """A row as a JSON array of the text forms of its values."""
    return F.to_json(F.array(*[c.cast("string") for c in columns]))


def deliver(df: DataFrame, return_type: str):
    """Hand a frame over as pandas, polars, Spark, Arrow or raw (document, rows).

    All but ``spark`` bring the rows to the driver, which ``spark.driver.maxResultSize`` bounds.
    """
    if return_type not in RETURN_TYPES:
        raise TypeError(f"return_type must be one of {RETURN_TYPES}, not {return_type!r}")
    if return_type == "spark":
        return df
    if return_type == "pandas":
        return df.toPandas()
    if return_type == "arrow":
        return df.toArrow()
    if return_type == "polars":
        try:
            import polars
        except ImportError as exc:
            raise ImportError("return_type='polars' needs the polars package") from exc
        return polars.from_arrow(df.toArrow())
    return docs.to_document(df.schema), [list(row) for row in df.collect()]
