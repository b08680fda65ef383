"""As-of lookups: the newest fact at or before a reference."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

# (key, range) is the unit of work: ranges are as many as give this many positions each on average, up to a bound
# that one task can order by itself.
POSITIONS_PER_RANGE = 20_000
MAX_RANGES = 65_536


def quantile_bounds(df: DataFrame, column: str, ranges: int) -> list[int]:
    """Lower bounds of all ranges but the first: approximate quantiles, each within a quarter of a range."""
    shares = [i / ranges for i in range(1, ranges)]
    return sorted({int(b) for b in df.approxQuantile(column, shares, 1 / (4 * ranges))}) if shares else []


def range_number(position: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the position, counted in two steps of about the root of their number each."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    known = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    firsts = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>")
    below = lambda array: F.size(F.filter(array, lambda b: b <= position))
    group = F.greatest(below(firsts) - 1, F.lit(0))
    return group * step + below(F.get(known, group))


def latest_before(
    refs: DataFrame, facts: DataFrame, keys: list[str], *, at: str, seq: str = "seq", strict: bool = False, name: str = "found"
) -> DataFrame:
    """``refs`` with ``name`` = the highest ``seq`` of ``facts`` with equal keys and seq <= at (< if strict), or NULL.

    The time line is cut into ranges of about equally many positions, wherever these cluster. Within a (key, range) a running maximum over the distinct facts and
    positions answers most; a position ahead of the first fact of its range takes the last fact of the ranges
    before, carried over from one summary row per range. So neither a hot key's rows nor pairs of references and
    facts ever come together in one task. References meet their position's answer again in an equi-join.
    """
    marks = facts.select(*keys, F.col(seq).alias("__at")).distinct().withColumn("__fact", F.col("__at"))
    asked = refs.select(*keys, F.col(at).alias("__at")).distinct().withColumn("__asked", F.lit(True))
    # written once, as it is used three times below
    both, positions = materialize(marks.unionByName(asked, allowMissingColumns=True), "positions")
    ranges = max(1, min(MAX_RANGES, positions // POSITIONS_PER_RANGE))
    both = both.withColumn("__range", range_number(F.col("__at"), quantile_bounds(both, "__at", ranges)))

    # at equal positions a fact goes ahead of a reference, or after it when the comparison is strict
    question = F.col("__asked").isNotNull().cast("int")
    inside = Window.partitionBy(*keys, "__range").orderBy("__at", (1 - question) if strict else question)
    local = F.max("__fact").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    answers = both.withColumn("__local", local).where(F.col("__asked").isNotNull())

    # one row per key and range: at most ranges + 2 of a key meet in this window
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy(*keys, "__range")
        .agg(F.max("__fact").alias("__last"))
        .select(*keys, "__range", F.max("__last").over(earlier).alias("__carry"))
    )
    found = answers.join(carried, [*keys, "__range"]).select(
        *keys, F.col("__at").alias(at), F.coalesce("__local", "__carry").alias(name)
    )
    return refs.join(found, list(dict.fromkeys([*keys, at])), "left")
