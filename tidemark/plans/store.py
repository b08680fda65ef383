"""Versioned datasets on a shared file system.

Layout below the root: ``<rid>/__txn=<transaction>/__folder=<top folder>/...`` holds the files of one transaction,
named like partitions so that one scan covers many transactions; the log (see ``logs``) are append-only tables with
checkpoints: datasets, branches, transactions, files, schemas. Files are written first, their manifest rows
next and the committed transaction row last; readers go by the log alone, so an unfinished transaction is never
seen. Every commit takes the next slot of its dataset, which one writer gets: see ``Dataset.commit_transaction``.

Everything about files is a DataFrame job on the manifest. Only names go through the driver: a handful of log
rows of one dataset, and the folders (or, where a folder is partly replaced, the files) a scan has to list.
"""

from __future__ import annotations

import json
import re
import time
import uuid
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import errors
from tidemark.functions import is_hidden
from tidemark.operators import branches as branch_ops
from tidemark.operators import catalog, stats, transactions, views
from tidemark.plans.logs import CHECKPOINT_EVERY, Log, local_table
from tidemark.session import fresh_dir
from tidemark.sources import files as fsio
from tidemark.sources import readers, writers
from tidemark.sources import schema as docs

DEFAULT_BRANCH = "master"
DEFAULT_TYPE = "APPEND"

# Transactions of a dataset kept at hand on the driver; older ones are asked for in the log.
RECENT = 1000

# Answers a store keeps, the least used ones go.
REMEMBERED = 512

# Times a commit is tried again after another writer took its slot.
TRIES = 1000

# Fixed value: the folder readers expect the files of a written frame in.
DATA_FOLDER = "spark"

TABLES = {
    "datasets": "rid string, path string, trashed boolean, event bigint",
    "branches": "rid string, branch string, branch_rid string, parent string, fork_seq bigint, event bigint",
    "transactions": "rid string, branch string, seq bigint, txn string, type string, status string, "
    "at timestamp, record string, provenance string, file_count bigint, total_file_size bigint, "
    "hidden_file_count bigint, total_hidden_file_size bigint, event bigint",
    "files": "rid string, branch string, seq bigint, txn string, path string, physical string, "
    "length bigint, modified timestamp, deleted boolean",
    "schemas": "rid string, branch string, seq bigint, doc string",
}
METADATA = ["file_count", "total_file_size", "hidden_file_count", "total_hidden_file_size"]
BY_DATASET = {"branches", "transactions", "files", "schemas"}

_RID = re.compile(r"^ri\.[^.]+\.[^.]*\.dataset\.")


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Frame of a few driver rows, planned as a local table (one task, no Python worker)."""
    return spark.createDataFrame(local_table(rows, schema), T.StructType.fromDDL(schema))


def newest_rows(table: str, rows: DataFrame) -> DataFrame:
    """The rows of a log table that a checkpoint has to keep: of a transaction or branch the newest state."""
    key = {"transactions": ["rid", "branch", "seq", "txn"], "branches": ["rid", "branch"]}.get(table)
    if key is None:
        return rows
    rest = [c for c in rows.columns if c not in key and c != "event"]
    newest = rows.groupBy(*key).agg(F.max(F.struct("event", *rest)).alias("now"))
    return newest.select(*[c if c in key else F.col(f"now.{c}").alias(c) for c in rows.columns])


class Store:
    def __init__(self, spark: SparkSession, root: str | None = None, service: str = "catalog", *, checkpoint_every: int = CHECKPOINT_EVERY):
        self.spark = spark
        self.root = fsio.qualify(root or fresh_dir(spark, "store")).rstrip("/")
        self.service = service
        self.logs = Log(spark, self.root, TABLES, BY_DATASET, checkpoint_every)
        self._memo: dict = {}

    # -- log ---------------------------------------------------------------------------------------------

    def tick(self) -> int:
        return self.logs.tick()

    def log_path(self, table: str) -> str:
        return self.logs.path(table)

    def log(self, table: str, rid: str | None = None) -> DataFrame:
        return self.logs.read(table, rid)

    def append(self, table: str, rows: list[tuple] | DataFrame, rid: str | None = None) -> str:
        return self.logs.append(table, rows, rid)

    def remembered(self, key: tuple, tables: list[str], rid: str | None, compute: Callable):
        """``compute()``, or its last result while the given logs have not changed since; the latest answers are kept."""
        state = tuple(self.logs.state(t, rid) for t in tables)
        found = self._memo.pop(key, None)
        if found is None or found[0] != state:
            found = (state, compute())
        self._memo[key] = found
        while len(self._memo) > REMEMBERED:
            del self._memo[next(iter(self._memo))]
        return found[1]

    # -- catalog -----------------------------------------------------------------------------------------

    def datasets(self) -> DataFrame:
        """Current state of every dataset: rid, path, trashed."""
        return self.log("datasets").groupBy("rid", "path").agg(F.max_by("trashed", "event").alias("trashed"))

    def transactions(self, rid: str | None = None) -> DataFrame:
        """Current state of every transaction."""
        state = ["type", "status", "at", "record", "provenance", *METADATA]
        return (
            self.log("transactions", rid)
            .groupBy("rid", "branch", "seq", "txn")
            .agg(F.max(F.struct("event", *state)).alias("now"))
            .select("rid", "branch", "seq", "txn", *[f"now.{c}" for c in state])
        )

    def identities(self) -> DataFrame:
        """dataset_path, dataset_rid and last committed transaction per branch."""
        last = transactions.last_transactions(self.transactions()).select("rid", "branch", "seq")
        return (
            self.datasets()
            .join(last, "rid", "left")
            .select(F.col("path").alias("dataset_path"), F.col("rid").alias("dataset_rid"), "branch", "seq")
        )

    def create_dataset(self, path: str, branch: str = DEFAULT_BRANCH) -> Dataset:
        if self.has_dataset(path):
            raise errors.DatasetAlreadyExistsError(path)
        rid = f"ri.{self.service}.main.dataset.{uuid.uuid4()}"
        self.append("datasets", [(rid, path, False, self.tick())])
        dataset = Dataset(self, rid, path, branch)
        dataset.log_branch(branch)
        return dataset

    def _lookup(self, ref: str) -> list:
        """Up to two datasets with this rid or path."""
        key = "rid" if _RID.match(ref) else "path"
        find = self.datasets().where(F.col(key) == ref).limit(2)
        return self.remembered(("dataset", ref), ["datasets"], None, find.collect)

    def dataset(self, ref: str, branch: str = DEFAULT_BRANCH, fallbacks: list[str] | None = None) -> Dataset:
        """The one dataset with this rid or path, on ``branch`` or else on the first fallback branch it has."""
        found = self._lookup(ref)
        if len(found) != 1:
            raise errors.DatasetNotFoundError(f"{ref}: {len(found)} datasets found")
        dataset = Dataset(self, found[0]["rid"], found[0]["path"], branch)
        if found[0]["trashed"]:
            warnings.warn(f"{dataset.path} is in the trash", stacklevel=2)
        names = dataset.branch_names()
        for name in [branch, *(fallbacks or [])]:
            if name in names:
                dataset.branch = name
                return dataset
        raise errors.BranchNotFoundError(f"{ref}: no branch {branch}")

    def has_dataset(self, ref: str) -> bool:
        return len(self._lookup(ref)) > 0

    def set_trashed(self, ref: str, trashed: bool) -> None:
        found = next(iter(self._lookup(ref)), None)
        if found is None:
            raise errors.DatasetNotFoundError(ref)
        self.append("datasets", [(found["rid"], found["path"], trashed, self.tick())])

    def save_dataset(
        self,
        df: DataFrame,
        ref: str,
        branch: str = DEFAULT_BRANCH,
        *,
        exists_ok: bool = False,
        mode: str = "SNAPSHOT",
        **kwargs,
    ) -> tuple[str, str]:
        """Save a frame under a path, creating dataset and branch where missing; returns (rid, transaction).

        An existing dataset is only written to with ``exists_ok``, and never while it is in the trash.
        """
        if df is None or branch is None:
            raise ValueError("a frame and a branch are needed")
        try:
            dataset = self.dataset(ref, branch)
        except errors.DatasetNotFoundError:
            if _RID.match(ref):
                raise
            dataset, exists_ok = self.create_dataset(ref, branch), True
        except errors.BranchNotFoundError:
            found = self._lookup(ref)[0]
            dataset, exists_ok = Dataset(self, found["rid"], found["path"], branch).create_branch(branch), True
        if dataset.is_trashed():
            raise errors.DatasetInTrashError(f"{dataset.path} is in the trash")
        if not exists_ok:
            raise ValueError(f"{ref} exists; pass exists_ok=True to write to it")
        dataset.save_dataframe(df, mode, **kwargs)
        return dataset.rid, dataset.last_transaction()["txn"]


class UnitOfWork:
    """A block of writes to a dataset. Only a transaction that the block began ends with it."""

    def __init__(self, dataset: Dataset, kind: str | None, abort_on_error: bool, concurrent: bool = False):
        self.dataset, self.kind, self.abort_on_error, self.concurrent = dataset, kind, abort_on_error, concurrent
        self.began = False

    def __enter__(self) -> dict:
        joined = self.dataset._open or (None if self.concurrent else self.dataset.open_transaction())
        if joined is None:
            self.began = True
            self.dataset.start_transaction(self.kind, concurrent=self.concurrent)
            return self.dataset.transaction
        self.dataset._open = joined
        if self.kind not in (None, joined["type"]):
            raise errors.TransactionTypeMismatchError(self.kind, joined["type"])
        return self.dataset.transaction

    def __exit__(self, failure: type[BaseException] | None, *_: object) -> None:
        if self.began and failure is None:
            self.dataset.commit_transaction()
        elif self.began and self.abort_on_error and self.dataset._open is not None:
            self.dataset.abort_transaction()


class Dataset:
    """One dataset on one branch."""

    def __init__(self, store: Store, rid: str, path: str, branch: str):
        self.store = store
        self.spark = store.spark
        self.rid = rid
        self.path = path
        self.branch = branch
        self._open: dict | None = None

    def __repr__(self) -> str:
        return f"Dataset({self.path}, {self.rid}, branch={self.branch})"

    # -- branches ----------------------------------------------------------------------------------------

    def branches(self) -> DataFrame:
        newest = F.max(F.struct("event", "branch_rid", "parent", "fork_seq")).alias("now")
        return (
            self.store.log("branches", self.rid)
            .groupBy("rid", "branch")
            .agg(newest)
            .select("rid", "branch", "now.branch_rid", "now.parent", "now.fork_seq")
        )

    def _branch_rows(self) -> list:
        return self.store.remembered(("branches", self.rid), ["branches"], self.rid, lambda: self.branches().collect())

    def branch_names(self) -> list[str]:
        return sorted(r["branch"] for r in self._branch_rows())

    def log_branch(self, branch: str, parent: str | None = None, fork_seq: int | None = None, rid: str | None = None) -> None:
        rid = rid or f"ri.{self.store.service}.main.branch.{uuid.uuid4()}"
        self.store.append("branches", [(self.rid, branch, rid, parent, fork_seq, self.store.tick())])

    def create_branch(
        self, branch: str, *, parent: str | None = None, parent_transaction: str | None = None
    ) -> Dataset:
        """Create a branch and switch to it: a root, or forked off a branch or transaction as of now."""
        if branch in self.branch_names():
            raise errors.BranchAlreadyExistsError(f"{self.path}: {branch}")
        fork_seq = None
        if parent_transaction is not None:
            row = self.transaction_row(parent_transaction)
            parent, fork_seq = row["branch"], row["seq"]
        elif parent is not None:
            if parent not in self.branch_names():
                raise errors.BranchNotFoundError(f"{self.path}: {parent}")
            fork_seq = self.store.tick()
        self.log_branch(branch, parent, fork_seq)
        self.branch = branch
        return self

    def switch_branch(self, branch: str, *, create: bool = False, **kwargs) -> Dataset:
        if branch in self.branch_names():
            self.branch = branch
            return self
        if not create:
            raise errors.BranchNotFoundError(f"{self.path}: {branch}")
        return self.create_branch(branch, **kwargs)

    def fast_forward(self, parent_transaction: str) -> Dataset:
        """Move this branch's fork point to a later transaction of its parent."""
        row = self.transaction_row(parent_transaction)
        current = next(r for r in self._branch_rows() if r["branch"] == self.branch)
        if current["parent"] not in (None, row["branch"]) or row["branch"] == self.branch:
            raise errors.BranchNotFoundError(f"{row['branch']} is not the parent of {self.branch}")
        if current["fork_seq"] is not None and current["fork_seq"] > row["seq"]:
            raise ValueError("the branch is already past that transaction")
        self.log_branch(self.branch, row["branch"], row["seq"], current["branch_rid"])
        return self

    def _sources(self) -> list[tuple[str, int]]:
        """Branches whose transactions this branch shows, each with the last seq that counts."""
        rows = {r["branch"]: r for r in self._branch_rows()}
        out, name, bound = [], self.branch, branch_ops.UNBOUNDED
        while name is not None and name not in [n for n, _ in out]:
            out.append((name, bound))
            row = rows.get(name)
            name = row["parent"] if row else None
            if row is not None and row["fork_seq"] is not None:
                bound = min(bound, row["fork_seq"])
        return out

    def _inherited(self, frame: DataFrame) -> DataFrame:
        """Rows of this branch and its ancestors up to the forks, relabelled as this branch's."""
        mine = F.lit(False)
        for name, bound in self._sources():
            mine = mine | ((F.col("branch") == name) & (F.col("seq") <= bound))
        return frame.where(mine).withColumn("branch", F.lit(self.branch))

    # -- transactions --------------------------------------------------------------------------------------

    def transactions(self) -> DataFrame:
        return self._inherited(self.store.transactions(self.rid))

    def _recent(self) -> tuple[list, bool]:
        """The newest transactions on any branch, newest first, and whether these are all."""

        def read() -> list:
            return self.store.transactions(self.rid).orderBy(F.col("seq").desc()).limit(RECENT).collect()

        rows = self.store.remembered(("recent", self.rid), ["transactions"], self.rid, read)
        return rows, len(rows) < RECENT

    def _recent_here(self, statuses: tuple[str, ...], branches: list[tuple[str, int]] | None = None) -> tuple[list, bool]:
        """Of the newest transactions, those seen from this branch (or from ``branches``) in one of the states."""
        rows, complete = self._recent()
        bounds = dict(self._sources() if branches is None else branches)
        return [r for r in rows if r["status"] in statuses and r["seq"] <= bounds.get(r["branch"], -1)], complete

    def transaction_row(self, txn: str):
        rows, complete = self._recent()
        row = next((r for r in rows if r["txn"] == txn), None)
        if row is None and not complete:
            row = self.store.transactions(self.rid).where(F.col("txn") == txn).first()
        if row is None:
            raise errors.TransactionNotFoundError(txn)
        return row

    def get_transactions(self, page_size: int, *, end: str | None = None, include_open: bool = False) -> list[dict]:
        rows = transactions.reverse_transactions(
            self.transactions(),
            page_size,
            end=None if end is None else self.transaction_row(end)["seq"],
            include_open=include_open,
            columns=("seq", "txn", "type", "status", "at", "record", "provenance", *METADATA),
        )
        return [r.asDict() for r in rows.orderBy("position").collect()]

    def last_transaction(self, *, include_open: bool = False) -> dict | None:
        rows, complete = self._recent_here(("COMMITTED", "OPEN") if include_open else ("COMMITTED",))
        if rows or complete:
            return {**rows[0].asDict(), "branch": self.branch} if rows else None
        page = self.get_transactions(1, include_open=include_open)
        return page[0] if page else None

    def open_transaction(self) -> dict | None:
        """The branch's own last transaction, if it is open."""
        rows, complete = self._recent_here(("COMMITTED", "OPEN"), [(self.branch, branch_ops.UNBOUNDED)])
        if not rows and not complete:
            own = self.store.transactions(self.rid).where(F.col("branch") == self.branch)
            rows = views.with_status(own, include_open=True).orderBy(F.col("seq").desc()).limit(1).collect()
        return rows[0].asDict() if rows and rows[0]["status"] == "OPEN" else None

    @property
    def transaction(self) -> dict:
        self._open = self._open or self.open_transaction()
        if self._open is None:
            raise errors.DatasetHasNoOpenTransactionError(self.path)
        return self._open

    def start_transaction(self, kind: str | None = None, *, record: dict | None = None, concurrent: bool = False) -> Dataset:
        """Open the one transaction of the branch, or with ``concurrent`` one of several that run side by side.

        A concurrent transaction is not logged before its commit, where it gets its place behind all others.
        """
        kind = kind or DEFAULT_TYPE
        if kind not in views.TRANSACTION_TYPES:
            raise ValueError(f"unknown transaction type {kind!r}")
        if self.is_trashed():
            raise errors.DatasetInTrashError(f"{self.path} is in the trash")
        if self._open is not None or not concurrent and self.open_transaction() is not None:
            raise errors.DatasetHasOpenTransactionError(f"{self.path} on {self.branch}")
        seq = self.store.tick()
        # the number is padded, so that transaction rids sort by time; concurrent ones may begin at the same moment
        name = f"{seq:020d}-{uuid.uuid4().hex[:12]}" if concurrent else f"{seq:020d}"
        opened = {"seq": seq, "txn": f"ri.{self.store.service}.main.transaction.{name}", "type": kind, "status": "OPEN"}
        base = self.store.logs.last_slot(self.rid)
        self._open = {**opened, "record": json.dumps(record or {}), "concurrent": concurrent, "base": base}
        if not concurrent:
            self._log_transaction("OPEN")
        return self

    def _log_transaction(self, status: str, *, provenance: dict | None = None, metadata: dict | None = None) -> None:
        t = self.transaction
        row = (
            self.rid,
            self.branch,
            t["seq"],
            t["txn"],
            t["type"],
            status,
            datetime.now(UTC),
            t["record"],
            None if provenance is None else json.dumps(provenance),
            *[(metadata or {}).get(c) or 0 for c in METADATA],
            self.store.tick(),
        )
        self.store.append("transactions", [row])

    def commit_transaction(self, *, provenance: dict | None = None, record: dict | None = None) -> Dataset:
        """Publish the staged files, then the transaction; its file counts are observed on the way.

        Commits of a dataset are numbered without gaps: each takes the next slot, which is created only if it is absent. A
        transaction whose slot was taken by another looks at all that was committed since it began. What doesn't touch
        the same files does not matter, and it tries the next slot; an UPDATE or DELETE of files that were changed, or
        of a branch that got a new snapshot, is refused and aborted.
        """
        if record is not None:
            self.transaction["record"] = json.dumps(record)
        staged, logs, t = self._staged(), self.store.logs, self.transaction
        checked = t.get("base")
        for _ in range(TRIES):
            last = logs.last_slot(self.rid)
            between = logs.slots(self.rid, checked + 1, last) if checked is not None else []
            self._refuse_conflicts(staged, [c for c in between if c["branch"] == self.branch and c["txn"] != t["txn"]])
            checked = last
            if t.get("concurrent"):  # its place is behind all that is committed
                t["seq"] = max([self.store.tick(), *(c["seq"] + 1 for c in between)])
            manifest, metadata = self._publish(staged)
            slot = {"txn": t["txn"], "seq": t["seq"], "branch": self.branch, "type": t["type"], "manifest": manifest}
            if logs.claim(self.rid, last + 1, slot):
                break
        else:
            raise errors.CommitConflictError(f"{self.path}: no slot for a commit after {TRIES} tries")
        if t.get("doc"):
            self.store.append("schemas", [(self.rid, self.branch, t["seq"], t["doc"])])
        self._log_transaction("COMMITTED", provenance=provenance, metadata=metadata)
        self._open = None
        logs.checkpoint_if_due(self.rid, newest_rows)
        return self

    def _publish(self, staged: DataFrame | None) -> tuple[str | None, dict | None]:
        """Manifest rows under the number of the transaction; they count only once it is committed under this number."""
        if staged is None:
            return None, None
        hidden, seen = is_hidden(F.col("path")), Observation()
        zero = F.lit(0).cast("bigint")
        counts = (
            F.count_if(~F.col("deleted")).alias("file_count"),
            F.sum("length").alias("total_file_size"),
            F.count_if(hidden & ~F.col("deleted")).alias("hidden_file_count"),
            F.sum(F.when(hidden, F.col("length")).otherwise(zero)).alias("total_hidden_file_size"),
        )
        numbered = staged.withColumn("seq", F.lit(self.transaction["seq"]).cast("bigint"))
        entry = self.store.append("files", numbered.observe(seen, *counts), self.rid)
        return entry, seen.get

    def _refuse_conflicts(self, staged: DataFrame | None, others: list[dict]) -> None:
        """Abort if commits since the transaction began changed what it changes: a join of their manifests with its own."""
        if self.transaction["type"] not in ("UPDATE", "DELETE") or not others:
            return
        snapshot = any(c["type"] == "SNAPSHOT" for c in others)
        if not snapshot and staged is not None:
            numbers = local_frame(self.spark, [(c["seq"], c["txn"]) for c in others], "seq bigint, txn string")
            theirs = self.store.log("files", self.rid).join(numbers, ["seq", "txn"], "left_semi").select("path")
            folder = F.regexp_replace("path", "[^/]+$", "")
            # an UPDATE that takes files away has replaced folders, so new files in these count as well
            gone = staged.where("deleted").select(folder.alias("at")).distinct() if self.transaction["type"] == "UPDATE" else None
            hit = theirs.join(staged.select("path"), "path", "left_semi")
            if gone is not None:
                hit = hit.unionAll(theirs.withColumn("at", folder).join(gone, "at", "left_semi").select("path"))
            if hit.isEmpty():
                return
        elif not snapshot:
            return
        names = [c["txn"] for c in others]
        self.abort_transaction()
        raise errors.CommitConflictError(f"{self.path}: files were changed by {names}")

    def abort_transaction(self) -> Dataset:
        if not self.transaction.get("concurrent"):
            self._log_transaction("ABORTED")
        self._open = None
        return self

    def transaction_context(self, kind: str | None = None, *, abort_on_error: bool = True, concurrent: bool = False) -> UnitOfWork:
        """Run a block in the open transaction, or in a new one that is committed after it or aborted on error."""
        return UnitOfWork(self, kind, abort_on_error, concurrent)

    # -- files of the open transaction -----------------------------------------------------------------------

    def folder(self, txn: str | None = None) -> str:
        return f"{self.store.root}/{self.rid}/{readers.TRANSACTION_FOLDER}={txn or self.transaction['txn']}"

    def location(self, path: str) -> str:
        """Where the open transaction keeps the file of a logical path."""
        top, slash, rest = path.partition("/")
        return f"{self.folder()}/{readers.TOP_FOLDER}={top}/{rest}" if slash else f"{self.folder()}/{path}"

    def _staging(self) -> str:
        return f"{self.store.root}/_log/staged/{self.rid}/{self.transaction['txn']}"

    def _staged(self) -> DataFrame | None:
        """Manifest rows of the open transaction: the newest generation in its staging folder."""
        generations = fsio.sub_dirs(self._staging())
        if not generations:
            return None
        return self.spark.read.schema(TABLES["files"]).parquet(f"{self._staging()}/{generations[-1]}")

    def _stage(self, rows: DataFrame, *, replace: bool = False) -> None:
        generations = fsio.sub_dirs(self._staging())
        number = len(generations) - 1 + replace if generations else 0
        rows.write.mode("append").parquet(f"{self._staging()}/g{number:06d}")

    def _as_manifest(self, listed: DataFrame, *, deleted: bool = False) -> DataFrame:
        t = self.transaction
        return listed.select(
            F.lit(self.rid).alias("rid"),
            F.lit(self.branch).alias("branch"),
            F.lit(t["seq"]).cast("bigint").alias("seq"),
            F.lit(t["txn"]).alias("txn"),
            "path",
            F.col("physical"),
            F.col("length").cast("bigint").alias("length"),
            F.col("modified").cast("timestamp").alias("modified"),
            F.lit(deleted).alias("deleted"),
        )

    def put_file(self, path: str, data: str | bytes, *, overwrite: bool = False, kind: str | None = None) -> Dataset:
        """Write one file; a path already in the transaction is refused unless ``overwrite``."""
        with self.transaction_context(kind):
            staged = self._staged()
            taken = staged is not None and not staged.where(F.col("path") == path).isEmpty()
            if taken and not overwrite:
                raise errors.FileAlreadyExistsError(path)
            payload = data.encode() if isinstance(data, str) else data
            physical = self.location(path)
            fsio.write_bytes(physical, payload)
            row = local_frame(self.spark, [(path, physical, len(payload))], "path string, physical string, length bigint")
            row = self._as_manifest(row.withColumn("modified", F.current_timestamp()))
            if taken:
                self._stage(staged.where(F.col("path") != path).unionByName(row), replace=True)
            else:
                self._stage(row)
        return self

    def upload_files(self, path_file_dict: dict[str, str], *, max_workers: int | None = None, kind: str | None = None) -> Dataset:
        """Copy files into the dataset in Spark tasks: {logical path: location}."""
        with self.transaction_context(kind):
            pairs = self.spark.createDataFrame(
                [(fsio.qualify(str(src)), self.location(path), path) for path, src in path_file_dict.items()],
                "source string, target string, path string",
            )
            copied = fsio.copy_files(pairs, max_workers or len(path_file_dict))
            listed = copied.join(pairs.select("target", "path"), "target").select(
                "path", F.col("target").alias("physical"), "length", F.current_timestamp().alias("modified")
            )
            self._stage(self._as_manifest(listed))
        return self

    def upload_folder(self, folder: str, *, max_workers: int | None = None, kind: str = "UPDATE") -> Dataset:
        """Copy all files below a folder, keeping their relative paths."""
        listing = fsio.FileSystem(folder)
        found = {e.path: f"{folder}/{e.path}" for e in listing.ls(show_hidden=True)}
        return self.upload_files(found, max_workers=max_workers, kind=kind)

    def import_files(self, location: str, *, kind: str = "SNAPSHOT", doc: dict | None = None, folder: str = DATA_FOLDER) -> Dataset:
        """Take files into the dataset where they lie: only the manifest is written, no data is copied."""
        with self.transaction_context(kind) as t:
            listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
            # logical paths keep the folders below the location: names repeat between partition folders
            root = fsio.qualify(location).rstrip("/")
            below = F.when(F.col("path") == root, F.substring_index("path", "/", -1)).otherwise(
                F.col("path").substr(F.lit(len(root) + 2), F.length("path"))
            )
            rows = listed.select(
                F.concat(F.lit(f"{folder}/"), below).alias("path"),
                F.col("path").alias("physical"),
                "length",
                F.col("modificationTime").alias("modified"),
            )
            self._stage(self._as_manifest(rows))
            self.put_schema(doc or readers.infer_schema(self.spark, [location], "parquet"), t["seq"])
        return self

    def delete_files(self, paths: list[str] | DataFrame) -> Dataset:
        """Take files out of the view by a DELETE transaction; the paths may be a frame with a path column."""
        with self.transaction_context("DELETE"):
            if not isinstance(paths, DataFrame):
                paths = local_frame(self.spark, [(p,) for p in paths], "path string")
            self.stage_tombstones(paths)
        return self

    def stage_tombstones(self, paths: DataFrame) -> None:
        gone = paths.select(
            "path", F.lit(None).cast("string").alias("physical"), F.lit(0).alias("length"), F.current_timestamp().alias("modified")
        )
        self._stage(self._as_manifest(gone, deleted=True))

    def remove_file(self, path: str, *, recursive: bool = False) -> Dataset:
        """Remove a file, or a folder's files, from the open transaction; no match is no error."""
        staged = self._staged()
        if staged is not None:
            kept = transactions.remove_from_open(staged.withColumn("status", F.lit("OPEN")), [(path, recursive)])
            self._stage(kept.drop("status"), replace=True)
        return self

    # -- writes of frames ------------------------------------------------------------------------------------

    def save_dataframe(
        self,
        df: DataFrame | pd.DataFrame | pa.Table,
        kind: str = "SNAPSHOT",
        *,
        doc: dict | None = None,
        fmt: str = "parquet",
        partition_by: list[str] | None = None,
        replace_partitions: bool = False,
        options: dict | None = None,
        concurrent: bool = False,
    ) -> Dataset:
        """Write a frame as one transaction, in parallel and straight into the dataset.

        An APPEND goes to a folder of its own. The files of a Spark frame have names of their own, so an UPDATE
        leaves all others in place; with ``replace_partitions`` it removes those in the partitions it writes. A
        pandas, polars or Arrow table becomes the one file ``dataset.parquet``, which the next UPDATE replaces.
        """
        local = not isinstance(df, DataFrame)
        if local:
            df = self.spark.createDataFrame(df.to_arrow() if type(df).__module__.startswith("polars") else df).coalesce(1)
        with self.transaction_context(kind, concurrent=concurrent) as t:
            folder = str(self.store.tick()) if kind == "APPEND" else DATA_FOLDER
            target = f"{self.folder()}/{readers.TOP_FOLDER}={folder}"
            writers.write_version(df, target, fmt=fmt, partition_by=partition_by, options=options)
            listed = fsio.list_frame(self.spark, target)
            # one file in each partition folder
            name = F.regexp_replace("path", "[^/]+$", "dataset.parquet") if local else F.col("path")
            rows = listed.withColumn("path", F.concat(F.lit(f"{folder}/"), name))
            self._stage(self._as_manifest(rows))
            if kind == "UPDATE" and replace_partitions:
                self.stage_tombstones(self._overwritten(rows))
            if doc is None:
                stored = df.schema if not partition_by else _partitions_last(df, partition_by)
                doc = docs.to_document(stored, fmt)
            self.put_schema(doc, t["seq"])
        return self

    def _overwritten(self, written: DataFrame) -> DataFrame:
        """Files of the view in the folders just written, other than the written ones."""
        before = self.files().select("path", F.regexp_replace("path", "/[^/]*$", "").alias("at"))
        touched = written.select(F.regexp_replace("path", "/[^/]*$", "").alias("at")).distinct()
        return before.join(touched, "at", "left_semi").join(written.select("path"), "path", "left_anti")

    # -- schemas -----------------------------------------------------------------------------------------------

    def put_schema(self, doc: dict, seq: int) -> Dataset:
        if self._open is not None and self._open.get("concurrent"):  # its number is not known before the commit
            self._open["doc"] = json.dumps(doc)
            return self
        self.store.append("schemas", [(self.rid, self.branch, seq, json.dumps(doc))])
        return self

    def get_schema(self, end: str | int | None = None) -> dict:
        """Document in force at a transaction (default: now): the newest one of a committed transaction."""
        def read():
            rows = views.in_range(self._inherited(self.store.log("schemas", self.rid)), None, self._seq(end))
            unfinished = self.transactions().where(F.col("status") != "COMMITTED").select("seq")
            if self._open is not None:  # its own writes are seen inside an open transaction
                unfinished = unfinished.where(F.col("seq") != self._open["seq"])
            return rows.join(unfinished, "seq", "left_anti").orderBy(F.col("seq").desc()).first()

        newest = self.store.remembered(
            ("schema", self.rid, self.branch, end), ["schemas", "branches", "transactions"], self.rid, read
        )
        if newest is None:
            raise errors.DatasetHasNoSchemaError(f"{self.path} on {self.branch}")
        return json.loads(newest["doc"])

    def infer_schema(self, fmt: str | None = None) -> dict:
        files = self.files(exclude_hidden=True).orderBy("path")
        first = files.first()
        if first is None:
            raise errors.DatasetHasNoFilesError(self.path)
        fmt = fmt or ("csv" if "csv" in first["path"] else "json" if "json" in first["path"] else "parquet")
        return readers.infer_schema(self.spark, [r["physical"] for r in files.select("physical").collect()], fmt)

    # -- views and reads -----------------------------------------------------------------------------------------

    def _seq(self, ref: str | int | None) -> int | None:
        return self.transaction_row(ref)["seq"] if isinstance(ref, str) else ref

    def timeline(self, *, start: int | None = None, end: int | None = None, include_open: bool = False) -> DataFrame:
        """The transactions a view is made of: from the last snapshot in the range on, as a local table.

        One row per transaction goes through the driver, as the names of a scan's folders do. As a local table
        its size is known, so the join with the manifest is a broadcast join as long as it is small.
        """
        recent, complete = self._recent_here(("COMMITTED", "OPEN") if include_open else ("COMMITTED",))
        oldest = min((r["seq"] for r in self._recent()[0]), default=0)
        inside = [r for r in recent if (start is None or r["seq"] >= start) and (end is None or r["seq"] <= end)]
        snapshot = max((r["seq"] for r in inside if r["type"] == "SNAPSHOT"), default=None)
        if snapshot is None and not complete and (start is None or start < oldest):
            inside, snapshot = self._long_timeline(start, end, include_open)
        live = [
            (r["seq"], r["txn"], r["type"], r["status"], r["file_count"] - r["hidden_file_count"], r["hidden_file_count"])
            for r in inside
            if snapshot is None or r["seq"] >= snapshot
        ]
        return local_frame(self.spark, live, "seq bigint, txn string, type string, status string, written bigint, hidden bigint")

    def _long_timeline(self, start: int | None, end: int | None, include_open: bool) -> tuple[list, int | None]:
        """The same from the log, when the last snapshot is not among the newest transactions."""
        rows = views.with_status(views.in_range(self.transactions(), start, end), include_open)
        snapshot = rows.agg(F.max(F.when(F.col("type") == "SNAPSHOT", F.col("seq")))).first()[0]
        return rows.where(F.col("seq") >= (snapshot or 0)).collect(), snapshot

    def files(
        self,
        *,
        start: str | int | None = None,
        end: str | int | None = None,
        logical_path: str | None = None,
        include_open: bool = False,
        exclude_hidden: bool = False,
        timeline: DataFrame | None = None,
    ) -> DataFrame:
        """The visible files: rid, branch, path, seq, txn, physical, length, modified."""
        if timeline is None:
            timeline = self.timeline(start=self._seq(start), end=self._seq(end), include_open=include_open)
        manifest = self.store.log("files", self.rid)
        if include_open and self.open_transaction() is not None:
            staged = self._staged()
            manifest = manifest if staged is None else manifest.unionByName(staged)
        ops = self._inherited(manifest).join(timeline.select("seq", "type"), "seq")
        ops = ops.withColumn("type", F.when(F.col("deleted"), F.lit("DELETE")).otherwise(F.col("type")))
        found = views.latest_by_path(ops.drop("deleted"), ["txn", "physical", "length", "modified"])
        found = found.where(~F.col("deleted")).drop("deleted")
        if exclude_hidden:
            found = found.where(~is_hidden(F.col("path")))
        return views.pick_logical_path(found, logical_path)

    def file_page(self, page_size: int = catalog.FILE_PAGE, start_path: str | None = None, **kwargs) -> tuple[list, str | None]:
        """One page of files by path, and the path the next one starts at (None on the last)."""
        rows = self.files(**kwargs)
        if start_path is not None:
            rows = rows.where(F.col("path") >= start_path)
        page = rows.orderBy("path").limit(page_size + 1).collect()
        return page[:page_size], (page[page_size]["path"] if len(page) > page_size else None)

    def list_files(self, page_size: int = catalog.FILE_PAGE, **kwargs) -> Iterator:
        token = None
        while True:
            page, token = self.file_page(page_size, token, **kwargs)
            yield from page
            if token is None:
                return

    def stats(self, end: str | int | None = None) -> DataFrame:
        return stats.dataset_stats(self.files(end=end))

    def _located(self, start: str | int | None = None, end: str | int | None = None) -> list[tuple[str, str, str]]:
        key = ("scan", self.rid, self.branch, start, end)
        tables = ["files", "transactions", "branches"]
        return self.store.remembered(key, tables, self.rid, lambda: self._locate(start, end))

    def _locate(self, start: str | int | None, end: str | int | None) -> list[tuple[str, str, str]]:
        """What a scan lists, as (partition base, partition names, location): the folder of a transaction where
        all its files are in that folder and visible, the single files where only some are."""
        timeline = self.timeline(start=self._seq(start), end=self._seq(end))
        base, names = readers.partition_layout(F.col("physical"))
        files = self.files(timeline=timeline, exclude_hidden=True).withColumn("base", base).withColumn("names", names)
        folder = F.concat(
            F.lit(f"{self.store.root}/{self.rid}/{readers.TRANSACTION_FOLDER}="), F.col("txn"),
            F.lit(f"/{readers.TOP_FOLDER}="), F.substring_index("path", "/", 1), F.lit("/"),
        )
        per_txn = (
            files.groupBy("seq", "base", "names")
            .agg(
                F.count(F.lit(1)).alias("visible"),
                F.bool_and(F.contains(F.col("physical"), folder)).alias("native"),
                F.min(folder).alias("folder"),
                F.max(folder).alias("other"),
            )
            .join(timeline.select("seq", "written", "hidden"), "seq")
            .withColumn("whole", F.expr("native AND folder = other AND visible = written AND hidden = 0"))
        )
        found = per_txn.select("seq", "base", "names", "whole", "folder").orderBy("seq").collect()
        located = [(r["base"], r["names"], r["folder"]) for r in found if r["whole"]]
        single = [r["seq"] for r in found if not r["whole"]]
        if single:
            rows = files.where(F.col("seq").isin(single)).select("base", "names", "physical")
            located += [tuple(r) for r in rows.collect()]
        return located

    def scan(self, files: DataFrame, doc: dict) -> DataFrame:
        """The rows of files of a manifest frame."""
        base, names = readers.partition_layout(F.col("physical"))
        rows = files.select(base, names, "physical").collect()
        return readers.scan_located(self.spark, [tuple(r) for r in rows], doc)

    def dataframe(self, *, start: str | int | None = None, end: str | int | None = None, doc: dict | None = None) -> DataFrame:
        """The visible rows as of ``end`` (a transaction; default now), or of the files since ``start``."""
        doc = doc or self.get_schema(end)
        located = self._located(start, end)
        if not located:
            return self.spark.createDataFrame([], docs.to_struct_type(doc))
        return readers.scan_located(self.spark, located, doc)

    def lazy(self, txn: str | None = None) -> DataFrame:
        """Scan of the files one transaction wrote (default: the last committed), partition folders as columns."""
        if txn is None:
            last = self.last_transaction()
            if last is None:
                raise errors.DatasetHasNoTransactionsError(self.path)
            txn = last["txn"]
        seq = self.transaction_row(txn)["seq"]
        return self.dataframe(start=seq, end=seq)

    def binary(self, glob: str | None = None) -> DataFrame:
        """The visible files as (path, modificationTime, length, content); works without a schema."""
        return readers.read_binary(self.spark, [location for _, _, location in self._located()], glob)

    def select_files(self, wanted: DataFrame) -> DataFrame:
        return views.changed_paths(self.files(), wanted)

    def download_files(self, output: str, paths: list[str] | None = None, max_workers: int | None = None) -> list[str]:
        """Copy visible files (all, or the named ones) below ``output`` in Spark tasks; an empty view is an error."""
        rows = self.files()
        if paths is not None:
            rows = rows.where(F.col("path").isin(list(paths)))
        target = F.concat(F.lit(fsio.qualify(output).rstrip("/") + "/"), "path")
        pairs = rows.select(F.col("physical").alias("source"), target.alias("target"))
        copied = sorted(r["target"] for r in fsio.copy_files(pairs, max_workers).collect())
        if not copied:
            raise errors.DatasetHasNoFilesError(self.path)
        return copied

    @contextmanager
    def download_files_temporary(self, paths: list[str] | None = None, max_workers: int | None = None) -> Iterator[str]:
        """Files copied to a folder of the shared area for the time of a block."""
        folder = fresh_dir(self.spark, "download")
        self.download_files(folder, paths, max_workers)
        try:
            yield folder
        finally:
            fsio.delete_dir(folder)

    def query(self, query: str, return_type: str = "pandas", **kwargs):
        """SQL on this dataset; the FROM clause is put in front: ``SELECT a WHERE b = 1``."""
        from tidemark.plans.sql import query_from

        return query_from(self, query, return_type, **kwargs)

    def to_spark(self) -> DataFrame:
        return self.dataframe()

    def to_arrow(self):
        return writers.deliver(self.dataframe(), "arrow")

    def to_pandas(self):
        return writers.deliver(self.dataframe(), "pandas")

    def to_polars(self):
        return writers.deliver(self.dataframe(), "polars")

    # -- state -----------------------------------------------------------------------------------------------

    def is_trashed(self) -> bool:
        found = self.store._lookup(self.rid)
        return bool(found and found[0]["trashed"])

    def identity(self) -> dict:
        last = self.last_transaction()
        return {
            "dataset_path": self.path,
            "dataset_rid": self.rid,
            "last_transaction_rid": last and last["txn"],
            "last_transaction": last,
        }


def _partitions_last(df: DataFrame, partition_by: list[str]):
    return df.select(*[c for c in df.columns if c not in partition_by], *partition_by).schema
