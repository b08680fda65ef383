"""SQL text over datasets: back-ticked paths or rids, ranges and branches, dialects, time limits."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, SparkSession

from tidemark import errors
from tidemark.sources import writers

# The dialects, and seconds a query may take.
DIALECTS = {"ANSI": "true", "SPARK": "false"}
TIMEOUT_SECONDS = 600

# Quoted text and comments are matched first, so that nothing inside them is taken for a reference.
_SKIP = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|--[^\n]*|/\*.*?\*/"
_REF = r"`(?:[^`]+)`(?:\.`[^`]+`)?"
_ALIAS = r"(?:\s+(?:as\s+)?[a-z_]\w*)?"
_FROM = re.compile(rf"{_SKIP}|\b(?:from|join)\s+(?P<refs>{_REF}(?:{_ALIAS}\s*,\s*{_REF})*)", re.I | re.S)
_RANGE = re.compile(r"^(?P<start>[^:@]*):(?P<end>[^:@]*)(?:@(?P<branch>.*))?$")


_PLAIN = re.compile(r"`([^`]+)`")
# Words that may follow a table without being its alias.
_AFTER_TABLE = """where group order having limit join inner left right full outer cross semi anti natural on using union
intersect except minus window lateral tablesample cluster distribute sort pivot unpivot qualify offset select""".split()


def _has_alias(rest: str) -> bool:
    """Whether the text after a table begins with an alias for it."""
    found = re.match(r"\s+(?:as\s+)?(`|[a-z_]\w*)", rest, re.I)
    return bool(found) and found[1].lower() not in _AFTER_TABLE


def references(query: str) -> list[str]:
    """The back-ticked dataset references after FROM and JOIN."""
    return [r for m in _FROM.finditer(query) if m["refs"] for r in re.findall(_REF, m["refs"], re.I)]


def _resolve(store, ref: str, branch: str, fallbacks: list[str]) -> DataFrame:
    """Frame of `path`, of `branch`.`path`, or of `start:end@branch`.`path` (either bound may be left out)."""
    parts = re.findall(r"`([^`]+)`", ref)
    start = end = None
    if len(parts) == 2:
        bounds = _RANGE.match(parts[0])
        if bounds:
            start, end, branch = bounds["start"] or None, bounds["end"] or None, bounds["branch"] or branch
        else:
            branch = parts[0]
    return store.dataset(parts[-1], branch, fallbacks).dataframe(start=start, end=end)


@contextmanager
def dialect(spark: SparkSession, name: str):
    """Analyse under the given dialect: it decides whether a failing cast raises (ANSI) or gives NULL (SPARK)."""
    if name not in DIALECTS:
        raise TypeError(f"dialect must be one of {sorted(DIALECTS)}, not {name!r}")
    key = "spark.sql.ansi.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, DIALECTS[name])
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_sql(
    store,
    query: str,
    return_type: str = "pandas",
    *,
    branch: str = "master",
    fallbacks: list[str] | None = None,
    sql_dialect: str = "SPARK",
    timeout: float = TIMEOUT_SECONDS,
):
    """Run SQL whose tables are datasets of ``store``.

    Each reference becomes a view of that version's scan, and Catalyst does the rest; the views are gone once
    the query is analysed. Results other than ``spark`` are bounded by ``timeout`` seconds.
    """
    spark = store.spark
    if return_type not in writers.RETURN_TYPES:
        raise TypeError(f"return_type must be one of {writers.RETURN_TYPES}, not {return_type!r}")
    names: dict[str, str] = {}

    def name_refs(match: re.Match) -> str:
        if not match["refs"]:
            return match[0]
        for ref in re.findall(_REF, match["refs"], re.I):
            names.setdefault(ref, f"ref_{uuid.uuid4().hex}")
        # each view goes by the name it was asked for, so that columns can be qualified with it
        text = query[match.start() :]
        named = re.sub(_REF, lambda r: names[r[0]] + ("" if _has_alias(text[r.end() :]) else f" AS `{_PLAIN.findall(r[0])[-1]}`"), match[0])
        return named

    with dialect(spark, sql_dialect):
        text = _FROM.sub(name_refs, query)
        try:
            for ref, name in names.items():
                _resolve(store, ref, branch, fallbacks or []).createOrReplaceTempView(name)
            frame = spark.sql(text)
        except (ParseException, AnalysisException) as exc:
            raise errors.QueryFailedError(str(exc)) from exc
        finally:
            for name in names.values():
                spark.catalog.dropTempView(name)
    if return_type == "spark":
        return frame
    return within(spark, timeout, lambda: writers.deliver(frame, return_type))


def query_from(dataset, query: str, return_type: str = "pandas", **kwargs):
    """SQL on one dataset without its FROM clause."""
    ref = f"`{dataset.rid}`"
    text = f"SELECT * FROM {ref}" if query == "SELECT *" else f"FROM {ref} {query}"
    return run_sql(dataset.store, text, return_type, branch=dataset.branch, **kwargs)


def within(spark: SparkSession, seconds: float, action: Callable):
    """Run a Spark action; after ``seconds`` its jobs are cancelled and QueryTimeoutError is raised."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    expired = threading.Event()

    def expire() -> None:
        expired.set()
        context.cancelJobGroup(group)

    timer = threading.Timer(seconds, expire)
    context.setJobGroup(group, "tidemark query", interruptOnCancel=True)
    timer.start()
    try:
        return action()
    except Exception as exc:
        if expired.is_set():
            raise errors.QueryTimeoutError(f"no result within {seconds} s") from exc
        if isinstance(exc, PySparkException):
            raise errors.QueryFailedError(str(exc)) from exc
        raise
    finally:
        timer.cancel()
        context.setLocalProperty("spark.jobGroup.id", None)
