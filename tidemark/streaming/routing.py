"""Object-created events routed to datasets: the first part of a key names the dataset, the rest the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import route_key

EVENT_SCHEMA = "Records array<struct<eventTime timestamp, s3 struct<object struct<key string, size bigint>>>>"


def routed(events: DataFrame) -> DataFrame:
    """Rows (event_time, dataset, path, size) of an event frame, batch or streaming."""
    record = events.select(F.explode("Records").alias("r"))
    key = F.url_decode(F.col("r.s3.object.key"))
    dataset, path = route_key(key)
    return record.select(
        F.col("r.eventTime").alias("event_time"), dataset.alias("dataset"), path.alias("path"), F.col("r.s3.object.size").alias("size")
    )


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def route_objects(spark: SparkSession, folder: str, output: str, checkpoint: str) -> None:
    """Route the events that arrived since the last run to ``output/batch=<n>``, then stop.

    Events are delivered at least once. The keys routed so far are the state of the stream, kept by key in RocksDB and
    saved by changes, so a batch looks up its own keys only and reads nothing of earlier output. There is no watermark: no
    event is lost for being late, and none is routed twice. A batch that failed is replaced when repeated.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    events = spark.readStream.schema(EVENT_SCHEMA).json(folder)
    fresh = routed(events).dropDuplicates(["dataset", "path"])
    writer = fresh.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a stream takes the setting when it starts
    try:
        query = writer.start()
    finally:
        spark.conf.set(STATE_STORE, before)
    query.awaitTermination()
