"""String, identifier and record functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed format: resource identifiers read ri.<service>.<instance>.<kind>.<locator>.
RID_PATTERN = r"^ri\.[^.]+\.[^.]*\.([^.]+)\."
DATASET_KIND = "dataset"


def decamelize(name: Column) -> Column:
    """CamelCase to snake_case: an underscore before every capital but a leading one."""
    return F.lower(F.regexp_replace(name, r"(?<!^)(?=[A-Z])", "_"))


def parse_iso(text: Column) -> Column:
    """ISO-8601 instant with ``Z`` or an offset; digits past the microsecond are dropped."""
    return F.to_timestamp(text)


def is_view(record: Column) -> Column:
    """True when the JSON record holds ``"view": true``, the boolean and not the string."""
    flag = F.try_variant_get(F.try_parse_json(record), "$.view", "variant")
    # a boolean variant prints as a bare true; schema_of_variant tells it from "true"
    return F.coalesce((F.schema_of_variant(flag) == "BOOLEAN") & (flag.cast("string") == "true"), F.lit(False))


def rid_kind(rid: Column) -> Column:
    """The kind part of a resource identifier, NULL for any other string."""
    return F.nullif(F.regexp_extract(rid, RID_PATTERN, 1), F.lit(""))


def is_dataset_rid(text: Column) -> Column:
    return F.coalesce(rid_kind(text) == DATASET_KIND, F.lit(False))


def clamp(value: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
