"""Structured log lines."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The level names the parser knows, and the keys a structured line must have.
LEVELS = ["CRITICAL", "FATAL", "ERROR", "WARNING", "WARN", "INFO", "DEBUG", "NOTSET"]
REQUIRED_KEYS = ["level", "origin", "message", "time", "unsafeParams"]

_LINE = (
    "level string, origin string, message string, time string, stacktrace string, "
    "unsafeParams map<string,string>"
)


def _unescape(text: Column) -> Column:
    r"""Decode ``\n``, ``\uXXXX`` and ``\xXX`` sequences by reading the text as a JSON string."""
    as_json = F.regexp_replace(text, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    as_json = F.regexp_replace(as_json, '(?<!\\\\)"', '\\\\"')
    as_json = F.replace(F.replace(as_json, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
    return F.from_json(F.concat(F.lit('{"v":"'), as_json, F.lit('"}')), "v string").getField("v")


def parse_log_lines(df: DataFrame, line: str, *, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns and level, origin, time, message, args, stacktrace of each log line.

    A JSON object with all required keys is structured; any other text is an INFO line holding itself.
    An unknown level counts as ERROR; ``args`` are the values of the ``param_`` keys in their order.
    Each line is parsed once, in a projection of its own.
    """
    keep = keep or []
    text = F.col(line)
    as_json = F.from_json(F.when(text.startswith("{") & text.endswith("}"), text), _LINE)
    parsed = df.select(*keep, text.alias("__line"), as_json.alias("__json"))
    p = lambda name: F.col("__json").getField(name)
    present = [p(name).isNotNull() for name in REQUIRED_KEYS]
    structured = F.coalesce(reduce(and_, present), F.lit(False))
    exception = F.coalesce(F.try_element_at(p("unsafeParams"), F.lit("exception_message")), F.lit(""))
    trace = F.replace(p("stacktrace"), F.lit("{exception_message}"), exception)
    level = F.when(p("level").isin(LEVELS), p("level")).otherwise(F.lit("ERROR"))
    args = F.map_values(F.map_filter(p("unsafeParams"), lambda k, _: k.startswith("param_")))
    return parsed.select(
        *keep,
        F.when(structured, level).otherwise(F.lit("INFO")).alias("level"),
        F.when(structured, p("origin")).otherwise(F.lit("")).alias("origin"),
        F.when(structured, F.to_timestamp(p("time"))).alias("time"),
        F.when(structured, p("message")).otherwise(F.col("__line")).alias("message"),
        F.when(structured, args).otherwise(F.array().cast("array<string>")).alias("args"),
        F.when(structured & trace.isNotNull(), _unescape(trace)).alias("stacktrace"),
    )


def explode_lines(df: DataFrame, text: str, *, keep: list[str], skip: int = 0) -> DataFrame:
    """One row per line of a multi-line text column, numbered from 0; ``skip`` lines already seen are left out."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\\R")).alias("line_no", "line")).where(
        F.col("line_no") >= skip
    )
