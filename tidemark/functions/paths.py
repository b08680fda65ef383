"""Functions on slash-separated logical paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: a path is hidden when a component starts with a dot or an underscore.
HIDDEN_PATTERN = r"(^|/)[._]"


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """The path without its last component; ``/`` for a top-level path."""
    head = F.regexp_replace(path, r"/[^/]*$", "")
    return F.when(head == "", F.lit("/")).otherwise(head)


def ancestors(path: Column) -> Column:
    """Array of all prefixes of an absolute path, outermost first, the path itself last."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))


def is_hidden(path: Column) -> Column:
    return path.rlike(HIDDEN_PATTERN)


def matches_regex(path: Column, regex: str) -> Column:
    """True when ``regex`` matches at the start of the path (the end is left open)."""
    return path.rlike(f"^(?:{regex})")


def under(path: Column, folder: str) -> Column:
    """True for files below ``folder``; a trailing slash is implied."""
    return path.startswith(folder if folder.endswith("/") else f"{folder}/")


def route_key(key: Column) -> tuple[Column, Column]:
    """Split an object key into (dataset, path in the dataset) at its first slash."""
    cut = F.instr(key, "/")
    dataset = F.when(cut > 0, F.substr(key, F.lit(1), cut - 1)).otherwise(key)
    return dataset, F.when(cut > 0, F.substr(key, cut + 1)).otherwise(F.lit(""))
