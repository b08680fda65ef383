"""Tailing structured logs: every line is parsed and handed on once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import parse_log_lines


def parsed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Streaming frame of the parsed lines of all text files in ``folder``."""
    return parse_log_lines(spark.readStream.text(folder), "value")


def tail_log(spark: SparkSession, folder: str, output: str, checkpoint: str) -> None:
    """Parse the files that appeared since the last run and append them to ``output``, then stop.

    What was seen is kept by the file source's own log in the checkpoint, in place of a line number.
    """
    query = (
        parsed_lines(spark, folder)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
