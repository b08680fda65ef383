"""What no committed transaction shows: files of aborted or abandoned transactions, found by joins and deleted in tasks."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.store import Store
from tidemark.sources import files as fsio
from tidemark.sources.readers import TRANSACTION_FOLDER

# Hours for which files are left alone, as a transaction may still be about to commit them.
GRACE_HOURS = 24


def vacuum_candidates(store: Store, grace_hours: float = GRACE_HOURS, now: datetime | None = None) -> DataFrame:
    """(rid, txn, physical, length, modified) of files below the store that no committed or open transaction lists.

    A listing of the data folders, without the files that some manifest of a committed transaction names (wherever
    that dataset is) and without those of open transactions, written more than ``grace_hours`` ago.
    """
    listed = fsio.list_frame(store.spark, store.root)
    parts = F.split("path", "/")
    marked = f"{TRANSACTION_FOLDER}="
    data = listed.where(F.startswith(parts[1], F.lit(marked))).select(
        parts[0].alias("rid"), F.substr(parts[1], F.lit(len(marked) + 1)).alias("txn"), "physical", "length", "modified"
    )
    state = store.transactions().select("rid", "seq", "txn", "status")
    committed = state.where(F.col("status") == "COMMITTED").select("rid", "seq", "txn")
    manifest = store.log("files").where(~F.col("deleted")).join(committed, ["rid", "seq", "txn"], "left_semi")
    running = state.where(F.col("status") == "OPEN").select("rid", "txn")
    moment = F.current_timestamp() if now is None else F.lit(now)
    old = data.where(F.col("modified") < moment - F.make_dt_interval(hours=F.lit(0), mins=F.lit(0), secs=F.lit(grace_hours * 3600.0).cast("decimal(18,6)")))
    return old.join(running, ["rid", "txn"], "left_anti").join(manifest.select("physical").distinct(), "physical", "left_anti")


def vacuum(store: Store, grace_hours: float = GRACE_HOURS, now: datetime | None = None) -> int:
    """Delete the candidates, in tasks; returns their number. Repeating a lost task does no harm."""

    def delete(batches):
        for batch in batches:
            for physical in batch["physical"]:
                fs, path = fsio.resolve(physical)
                try:
                    fs.delete_file(path)
                except FileNotFoundError:
                    continue
            yield pd.DataFrame({"n": [len(batch)]})

    found = vacuum_candidates(store, grace_hours, now).select("physical").mapInPandas(delete, "n long").agg(F.sum("n").alias("n"))
    return found.first()["n"] or 0
