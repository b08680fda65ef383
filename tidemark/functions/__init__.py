"""Column functions: each takes and returns Spark columns."""

from tidemark.functions.logs import explode_lines, parse_log_lines
from tidemark.functions.paths import (
    ancestors,
    basename,
    is_hidden,
    matches_regex,
    parent,
    route_key,
    under,
)
from tidemark.functions.text import clamp, decamelize, is_dataset_rid, is_view, parse_iso, rid_kind

__all__ = [
    "ancestors",
    "basename",
    "clamp",
    "decamelize",
    "explode_lines",
    "is_dataset_rid",
    "is_hidden",
    "is_view",
    "matches_regex",
    "parent",
    "parse_iso",
    "parse_log_lines",
    "rid_kind",
    "route_key",
    "under",
]
