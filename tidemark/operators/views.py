"""File views: which files of a dataset are visible at a branch, a transaction, or over a range.

The input is a frame of file operations, one row per file touched by a transaction:

    rid string, branch string, seq bigint, type string, status string, path string, length bigint

``seq`` orders transactions. ``type`` is SNAPSHOT, APPEND, UPDATE or DELETE; ``status`` is COMMITTED, OPEN or
ABORTED. Further columns ride along only when named in ``payload``.

The latest operation on a path decides about it: a path whose latest operation is older than the last
snapshot is out of the view, and so is one whose latest operation is a delete. So no operation has to be
dropped before the reduction to one row per path, which is an aggregation with a map-side part (a hot dataset
or path is combined before the shuffle) and not a window over whole datasets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, measured_side

KEY = ["rid", "branch"]

# Transaction types and states.
TRANSACTION_TYPES = ["SNAPSHOT", "APPEND", "UPDATE", "DELETE"]
TRANSACTION_STATUS = ["OPEN", "COMMITTED", "ABORTED"]


def encode(column: Column, values: list[str]) -> Column:
    """Position of ``column`` in ``values`` (from 1, 0 if not there).

    Aggregation buffers of fixed width stay in hash aggregation; a string payload would force a sort.
    """
    return F.array_position(F.array(*map(F.lit, values)), column).cast("int")


def decode(code: Column, values: list[str]) -> Column:
    # element_at would not give NULL for a NULL code under ANSI mode
    return F.get(F.array(*map(F.lit, values)), code - 1)


def in_range(df: DataFrame, start: int | Column | None, end: int | Column | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("seq") >= start)
    if end is not None:
        df = df.where(F.col("seq") <= end)
    return df


def with_status(df: DataFrame, include_open: bool) -> DataFrame:
    return df.where(F.col("status").isin("COMMITTED", "OPEN") if include_open else F.col("status") == "COMMITTED")


def last_snapshots(transactions: DataFrame) -> DataFrame:
    """Newest snapshot per dataset and branch. The type filter reaches the scan."""
    return transactions.where(F.col("type") == "SNAPSHOT").groupBy(*KEY).agg(F.max("seq").alias("snapshot_seq"))


def latest_by_path(ops: DataFrame, payload: list[str]) -> DataFrame:
    """The newest operation on each (rid, branch, path).

    With fixed-width payload columns this is a hash aggregation. Any other payload makes Spark sort each map
    task's rows by the key before combining them, so it is meant for manifests and not for logs.
    """
    return ops.groupBy(*KEY, "path").agg(
        F.max("seq").alias("seq"),
        F.max_by(F.col("type") == "DELETE", "seq").alias("deleted"),
        *[F.max_by(F.col(c), F.col("seq")).alias(c) for c in payload],
    )


def view_files(
    ops: DataFrame,
    *,
    transactions: DataFrame | None = None,
    start: int | Column | None = None,
    end: int | Column | None = None,
    include_open: bool = False,
    payload: tuple[str, ...] = ("length",),
) -> DataFrame:
    """Visible files per (rid, branch): columns rid, branch, path, seq and the payload.

    ``end`` gives the state as of a transaction, ``start`` restricts to the changes from a transaction on (the
    same rules applied inside the range). Snapshots are looked up in ``transactions``, so that an empty snapshot
    also counts, or else in the operations themselves.
    """
    live = with_status(in_range(ops, start, end), include_open)
    log = live if transactions is None else with_status(in_range(transactions, start, end), include_open)
    newest = latest_by_path(live, list(payload))
    snapshots = measured_side(last_snapshots(log), "snapshots")
    return (
        newest.join(snapshots, KEY, "left")
        .where(~F.col("deleted") & (F.col("snapshot_seq").isNull() | (F.col("seq") >= F.col("snapshot_seq"))))
        .select(*KEY, "path", "seq", *payload)
    )


def append_conflicts(ops: DataFrame) -> DataFrame:
    """Committed APPEND operations on a path that was in the view just before them (strict mode).

    The operation before on the path must not be a delete, and no snapshot may lie between the two.
    """
    from tidemark.operators.asof import latest_before

    path_key = [*KEY, "path"]
    committed = with_status(ops, include_open=False)
    appends = committed.where(F.col("type") == "APPEND").select(*path_key, "seq")
    before = latest_before(appends, committed, path_key, at="seq", strict=True, name="prev_seq")
    before, _ = materialize(before.where(F.col("prev_seq").isNotNull()), "before")
    snapshots = committed.where(F.col("type") == "SNAPSHOT").select(*KEY, "seq").distinct()
    bounded = latest_before(before, snapshots, KEY, at="seq", strict=True, name="snapshot_seq")
    alive = bounded.where(F.col("snapshot_seq").isNull() | (F.col("snapshot_seq") <= F.col("prev_seq")))
    deletes = committed.where(F.col("type") == "DELETE").select(*path_key, F.col("seq").alias("prev_seq"))
    return alive.drop("snapshot_seq").join(deletes, [*path_key, "prev_seq"], "left_anti").select(*path_key, "seq", "prev_seq")


def pick_logical_path(files: DataFrame, logical_path: str | None) -> DataFrame:
    """All files; or the one at exactly ``logical_path``; or, if a dataset has no such file, those below it."""
    if logical_path is None:
        return files
    from tidemark.functions import under

    exact = files.where(F.col("path") == logical_path)
    below = files.where(under(F.col("path"), logical_path))
    return exact.unionByName(below.join(exact.select(*KEY), KEY, "left_anti"))


def changed_paths(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``files`` whose path is listed in ``wanted(path)``."""
    return files.join(wanted.select("path"), "path", "left_semi")
