"""Ingest files as they arrive in drop folders, with the batch ingest inside foreachBatch.

Layout: ``<drop_root>/<table>/*.csv`` for the four plant tables.  Each table is one
file stream with its own checkpoint, drained parents first (machines, then events,
then checks, then maintenance) so children never arrive before their parents.
``trigger(availableNow=True)`` processes what is there and stops, which suits a
scheduled run; a long-running deployment uses a processing-time trigger instead.
Sinks are idempotent (insert-if-absent), so a replayed micro-batch changes nothing:
delivery is at-least-once and the outcome exactly-once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline import contracts as C
from forgeline.plans.ingest import ingest_table, log_stats
from forgeline.sources.csv import read_csv
from forgeline.sources.store import TableStore


FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of files in a folder, by path (their content is not read here)."""
    return (spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", 1000).load(folder).select("path"))


def stream_ingest(spark: SparkSession, store: TableStore, drop_root: str, checkpoint_root: str,
                  source_file: str, tables: list[str] | None = None, multi_line: bool | str = "auto") -> DataFrame:
    """Process every file not yet seen; return counters per table for this run.

    Files are read as in a batch: columns by each file's own header, in multi-line mode only
    where a record spans lines.  Batch ids hold the query's id, so they differ between checkpoints."""
    drop_root, checkpoint_root = drop_root.rstrip("/"), checkpoint_root.rstrip("/")
    run_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = []
    for table in tables or C.INGEST_ORDER:
        cols = C.CSV_COLUMNS[table]

        def handle(batch: DataFrame, epoch_id: int, table=table, cols=cols) -> None:
            paths = [r["path"] for r in batch.collect()]  # of one trigger, at most maxFilesPerTrigger
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            batch_id = f"stream-{table}-{query}-{epoch_id}"
            stats = ingest_table(store, table, read_csv(batch.sparkSession, paths, cols, multi_line), source_file, batch_id, run_at)
            log_stats(store, [(table, stats)], batch_id, source_file, run_at)
            rows.append((table, epoch_id, stats["inserted"], stats["skipped_duplicate"], stats["quarantined"]))

        q = (new_files(spark, f"{drop_root}/{table}").writeStream
             .trigger(availableNow=True)
             .option("checkpointLocation", f"{checkpoint_root}/{table}")
             .foreachBatch(handle).start())
        q.awaitTermination()
    per_batch = spark.createDataFrame(
        rows, "table_name string, epoch long, inserted long, skipped_duplicate long, quarantined long")
    totals = per_batch.groupBy("table_name").agg(
        F.sum("inserted").alias("inserted"), F.sum("skipped_duplicate").alias("skipped_duplicate"),
        F.sum("quarantined").alias("quarantined"))
    order = spark.createDataFrame([(t,) for t in tables or C.INGEST_ORDER], "table_name string")
    return order.join(totals, "table_name", "left").select(
        "table_name", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                        for c in ("inserted", "skipped_duplicate", "quarantined")])
