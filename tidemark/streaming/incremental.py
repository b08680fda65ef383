"""Rows of newly committed transactions, as a stream that remembers where it stopped.

The source of the stream are the commits of a dataset, one small file each, that appear whole and never change: Spark's
file source takes each once and its checkpoint holds which. A commit names its manifest entry; the manifest and then the
data files are read in tasks, so no name of a file passes the driver and a batch costs what it adds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions import is_hidden
from tidemark.plans.store import Dataset
from tidemark.sources import files as fsio
from tidemark.sources import schema as docs

COMMIT = "txn string, seq bigint, branch string, type string, manifest string"


def commits(dataset: Dataset) -> DataFrame:
    """The commits on the dataset's branch as a stream: txn, seq, branch, type and the manifest entry."""
    folder = dataset.store.logs.commits(dataset.rid)
    lines = dataset.spark.readStream.schema("value string").text(f"{folder}/*")
    return lines.select(F.from_json("value", COMMIT).alias("c")).select("c.*").where(F.col("branch") == dataset.branch)


def _added(entries: str, segments: str):
    """Commits as rows of the files they added. An entry that was merged meanwhile is looked for in the segments."""

    def rows_of(txn: str, entry: str) -> list[dict]:
        wanted = (pads.field("txn") == txn) & ~pads.field("deleted")
        for place in (f"{entries}/{entry}", segments):
            fs, path = fsio.resolve(place)
            try:
                found = pads.dataset(path, filesystem=fs, format="parquet", exclude_invalid_files=False).to_table(["path", "physical", "length"], filter=wanted)
            except FileNotFoundError:
                continue
            if found.num_rows or place == segments:
                return found.to_pylist()
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for commit in batch.to_pylist():
                rows = [{"seq": commit["seq"], **r} for r in rows_of(commit["txn"], commit["manifest"])]
                kinds = [("seq", pa.int64()), ("path", pa.string()), ("physical", pa.string()), ("length", pa.int64())]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return run


def added_files(dataset: Dataset) -> DataFrame:
    """The files added by commits, as a stream: seq, path, physical, length."""
    logs = dataset.store.logs
    made = commits(dataset).where(F.col("manifest").isNotNull()).select("txn", "seq", "manifest")
    found = made.mapInArrow(_added(logs.path("files", dataset.rid), logs.segments("files", dataset.rid)), "seq bigint, path string, physical string, length bigint")
    return found.where(~is_hidden(F.col("path")))


def _rows(schema: T.StructType):
    """Parquet files as rows of ``schema``: columns a file lacks come from its partition folders, or are null."""
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for physical in batch.column(0).to_pylist():
                fs, path = fsio.resolve(physical)
                parts = (p.partition("=") for p in path.split("/")[:-1])
                folders = {unquote(name): None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value) for name, at, value in parts if at}
                with fs.open_input_file(path) as source:
                    file = pq.ParquetFile(source)
                    there = [f.name for f in target if f.name in file.schema_arrow.names]
                    for rows in file.iter_batches(columns=there):
                        columns = [
                            rows.column(f.name).cast(f.type, safe=False)
                            if f.name in there
                            else pa.array([folders.get(f.name)] * rows.num_rows, pa.string()).cast(f.type)
                            for f in target
                        ]
                        yield pa.RecordBatch.from_arrays(columns, schema=target)

    return run


def stream_rows(dataset: Dataset, tasks: int | None = None) -> DataFrame:
    """The rows of a dataset's transactions as a streaming frame, each transaction once and whole, in batches of commits.

    Deletes and replaced files take nothing back. The files of a batch are dealt to ``tasks`` tasks. The schema is the one in
    force when the stream starts. For datasets of parquet files; others are streamed by :func:`new_rows`.
    """
    doc = dataset.get_schema()
    if docs.reader_format(doc) != "parquet":
        raise NotImplementedError(f"{dataset.path}: only parquet files are streamed row by row")
    schema = docs.to_struct_type(doc)
    files = added_files(dataset).select("physical").repartition(tasks or dataset.spark.sparkContext.defaultParallelism, "physical")
    return files.mapInArrow(_rows(schema), schema)


def new_rows(dataset: Dataset, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand the rows of all transactions committed since the last run to ``sink(frame, batch)``, then stop.

    A batch that failed is repeated as a whole: sinks should write by batch number. Batches of transactions without
    rows are not handed over.
    """
    parquet = docs.reader_format(dataset.get_schema()) == "parquet"

    def rows(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            sink(batch, number)

    def files(batch: DataFrame, number: int) -> None:
        newest = batch.agg(F.max("seq")).first()[0]
        if newest is not None:
            sink(dataset.scan(batch, dataset.get_schema(newest)), number)

    stream = stream_rows(dataset) if parquet else added_files(dataset)
    query = stream.writeStream.foreachBatch(rows if parquet else files).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def append_by_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to a folder of its number, so that repeating a batch replaces it."""
    return lambda frame, number: frame.write.mode("overwrite").parquet(f"{path}/batch={number}")
