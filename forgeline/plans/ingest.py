"""Ingest: validate, route, de-duplicate and append the four plant tables.

Order of rules is part of the contract: the first failing rule supplies the reason,
and validation happens before de-duplication, so an invalid row never shadows a later
valid row with the same key.  Re-running a batch inserts nothing and quarantines
nothing new.
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forgeline import contracts as C
from forgeline.functions import (
    is_blank,
    is_plain_timestamp,
    ntz_lit,
    integer_text_ok,
    integer_text_value,
    parse_timestamp,
    plain_timestamp,
    quantity_text,
    row_json,
    row_reference,
)
from forgeline.operators.dedup import first_per_stored_key, insert_stored_if_absent
from forgeline.operators.validate import first_failure, mark_known, named_keys
from forgeline.sources.csv import EXTRA
from forgeline.sources.store import PACKED, TableStore

log = logging.getLogger("forgeline.ingest")

ORDER_COLS = ["_file", "_pos"]


def _null(*cols):
    out = None
    for c in cols:
        p = F.col(c).isNull()
        out = p if out is None else (out | p)
    return out


# ---------------------------------------------------------------------------
# Classification: raw text columns -> typed columns + _reason (NULL = valid)
# ---------------------------------------------------------------------------
def classify_machines(raw: DataFrame) -> DataFrame:
    # the cast alone would also take a year, or a month without its zero
    install = F.when(F.col("install_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("install_date")).try_cast("date")
    rules = [
        (is_blank("machine_id") | is_blank("machine_name") | is_blank("install_date"),
         C.REASON_MISSING_REQUIRED),
        # added guards for values the table contract cannot hold (evaluated last)
        (install.isNull(), C.REASON_BAD_INSTALL_DATE),
        (_null("machine_type"), C.REASON_MISSING_REQUIRED),
    ]
    return raw.withColumns({"_install_date": install, "_reason": first_failure(rules)})


def classify_production_events(raw: DataFrame, known_machines: DataFrame, n_known: int | None = None) -> DataFrame:
    df = mark_known(raw, "machine_id", known_machines, "machine_id", "_fk_ok", n_keys=n_known)
    # each parse is its own column, evaluated once per row; the rules read the results
    df = df.withColumns({"_ts": parse_timestamp("timestamp"), "_qtext": quantity_text("quantity_produced")})
    df = df.withColumns({"_qok": integer_text_ok("_qtext"), "_qty": integer_text_value("_qtext")})
    rules = [
        (~F.col("_fk_ok"), C.REASON_UNKNOWN_MACHINE),
        (F.col("_ts").isNull(), C.REASON_BAD_TIMESTAMP),
        (~F.col("_qok"), C.REASON_BAD_QUANTITY),
        (F.col("_qok") & F.coalesce(F.col("_qty") <= 0, F.col("_qtext").startswith("-")),
         C.REASON_NONPOSITIVE_QUANTITY),
        (F.coalesce(F.col("_qty") > C.INT32_MAX, F.lit(True)), C.REASON_QUANTITY_RANGE),
        (_null("event_id", "product_code", "unit", "shift"), C.REASON_MISSING_REQUIRED),
    ]
    return df.withColumn("_reason", first_failure(rules)).drop("_qtext", "_qok")


def classify_quality_checks(raw: DataFrame, known_events: DataFrame, n_known: int | None = None) -> DataFrame:
    df = mark_known(raw, "production_event_id", known_events, "event_id", "_fk_ok", n_keys=n_known)
    df = df.withColumn("_ts", parse_timestamp("timestamp"))
    rules = [
        (~F.col("_fk_ok"), C.REASON_UNKNOWN_EVENT),
        (F.col("_ts").isNull(), C.REASON_BAD_TIMESTAMP),
        (_null("check_id", "result"), C.REASON_MISSING_REQUIRED),
    ]
    return df.withColumn("_reason", first_failure(rules))


def classify_maintenance_events(raw: DataFrame, known_machines: DataFrame, n_known: int | None = None) -> DataFrame:
    df = mark_known(raw, "machine_id", known_machines, "machine_id", "_fk_ok", n_keys=n_known)
    # a lambda reads all but the plainest form: generated code that holds the whole parse twice is too long for the JVM to compile
    def parsed(c):
        return F.when(is_plain_timestamp(c), plain_timestamp(c)).otherwise(F.transform(F.array(c), parse_timestamp)[0])

    df = df.withColumns({"_start": parsed("start_time"), "_end": parsed("end_time")})
    rules = [
        (~F.col("_fk_ok"), C.REASON_UNKNOWN_MACHINE),
        (F.col("_start").isNull() | F.col("_end").isNull(), C.REASON_BAD_TIMESTAMP),
        (_null("maintenance_id", "maintenance_type", "technician_id"), C.REASON_MISSING_REQUIRED),
    ]
    return df.withColumn("_reason", first_failure(rules))


# typed projection of accepted rows, per table (raw table contract minus lineage)
def typed_columns(table: str) -> list:
    if table == "machines":
        return ["machine_id", "machine_name", "machine_type", F.col("_install_date").alias("install_date")]
    if table == "production_events":
        return ["event_id", "machine_id", F.col("_ts").alias("event_timestamp"), "product_code",
                F.col("_qty").cast("int").alias("quantity_produced"), "unit", "shift"]
    if table == "quality_checks":
        return ["check_id", "production_event_id", F.col("_ts").alias("check_timestamp"), "result",
                F.nullif(F.col("defect_type"), F.lit("")).alias("defect_type"),
                F.nullif(F.col("inspector_id"), F.lit("")).alias("inspector_id")]
    if table == "maintenance_events":
        return ["maintenance_id", "machine_id", F.col("_start").alias("start_time"),
                F.col("_end").alias("end_time"), "maintenance_type", "technician_id"]
    raise ValueError(table)


def classify(table: str, raw: DataFrame, parents: dict[str, DataFrame], n_known: int | None = None) -> DataFrame:
    if table == "machines":
        return classify_machines(raw)
    if table == "production_events":
        return classify_production_events(raw, parents["machines"], n_known)
    if table == "quality_checks":
        return classify_quality_checks(raw, parents["production_events"], n_known)
    if table == "maintenance_events":
        return classify_maintenance_events(raw, parents["machines"], n_known)
    raise ValueError(table)


def _whole_row(df: DataFrame, cols: list[str]):
    """The original row as JSON: the contract's columns, then the file's others."""
    row = row_json(cols)
    if EXTRA not in df.columns:
        return row
    more = F.substring(F.to_json(F.col(EXTRA), {"ignoreNullFields": "false"}), 2, 2 ** 31 - 1)
    return F.when(F.cardinality(EXTRA) > 0, F.concat(F.substring(row, F.lit(1), F.length(row) - 1), F.lit(","), more)).otherwise(row)


def referenced(rejected: DataFrame, table: str) -> DataFrame:
    """Rejected rows with their reference."""
    return rejected.withColumn("row_reference", row_reference(C.PRIMARY_KEY[table], C.CSV_COLUMNS[table]))


def quarantine_rows(rejected: DataFrame, table: str, source_file: str, batch_id: str,
                    quarantined_at: _dt.datetime) -> DataFrame:
    """Rejected rows in quarantine layout (reference id, reason, original row as JSON)."""
    cols = C.CSV_COLUMNS[table]
    return referenced(rejected, table).select(
        F.lit(table).alias("table_name"),
        "row_reference",
        F.col("_reason").alias("reason"),
        _whole_row(rejected, cols).alias("raw_data"),
        F.lit(source_file).alias("source_file"),
        F.lit(batch_id).alias("batch_id"),
        ntz_lit(quarantined_at).alias("quarantined_at"),
        *ORDER_COLS,
    )


def stamp_lineage(df: DataFrame, source_file: str, batch_id: str, ingested_at: _dt.datetime) -> DataFrame:
    """Lineage columns from values fixed once on the driver (identical on every retry)."""
    return df.withColumns({
        "ingested_at": ntz_lit(ingested_at),
        "source_file": F.lit(source_file),
        "batch_id": F.lit(batch_id),
    })


# ---------------------------------------------------------------------------
# Table and dataset ingest against a TableStore
# ---------------------------------------------------------------------------
def _stored_keys(store: TableStore, table: str, among: DataFrame) -> DataFrame:
    """The stored primary keys of the batches that may hold some of the keys in ``among``."""
    pk = C.PRIMARY_KEY[table]
    return store.keys(table, [pk], C.RAW_SCHEMAS[table], among)


#: The foreign key of a table: its column, the parent table and the parent's key.
PARENT = {"production_events": ("machine_id", "machines", "machine_id"), "quality_checks": ("production_event_id", "production_events", "event_id"),
          "maintenance_events": ("machine_id", "machines", "machine_id")}


def ingest_table(store: TableStore, table: str, raw: DataFrame, source_file: str, batch_id: str,
                 loaded_at: _dt.datetime) -> dict:
    """Validate ``raw`` (text columns + _file/_pos), append new valid rows and new
    quarantine rows; return the counters (inserted, skipped_duplicate, quarantined)."""
    spark = store.spark
    # What lost executors computed is read from the shared store: the parent keys that the batch names, its classified rows,
    # and its stored keys.  Rows are shuffled at most once, to meet very many parents; keys do the rest.
    staging = f"_staging/{batch_id}-{table}"

    def kept(df: DataFrame, name: str) -> DataFrame:  # without dictionaries: these cost more than they save in files that are read once or twice
        df.write.mode("overwrite").options(**{"compression": PACKED, "parquet.enable.dictionary": "false"}).parquet(store.path(f"{staging}-{name}"))
        return spark.read.parquet(store.path(f"{staging}-{name}"))

    parents, n_known = {}, None
    if table in PARENT:
        fk, parent, key = PARENT[table]
        named = kept(raw.select(F.col(fk).alias(key)).distinct(), "named")  # a NULL among them meets no parent
        parents[parent] = named_keys(named, key, _stored_keys(store, parent, named), key, named.count())
        n_known = parents[parent].count()
    classified = classify(table, raw, parents, n_known)

    # Both outputs are cut from the same classified rows.
    counts = Observation(f"classified_{table}_{uuid.uuid4().hex[:6]}")
    staged = kept(classified.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_reason").isNull()).alias("valid")), "classified")
    valid, rejected_rows = counts.get["valid"], counts.get["rows"] - counts.get["valid"]

    def accept() -> int:
        if not valid:  # an all-rejected batch never touches the stored keys
            return 0
        pk = C.PRIMARY_KEY[table]
        accepted = staged.filter(F.col("_reason").isNull())
        new_rows = first_per_stored_key(accepted, [pk], ORDER_COLS)
        if store.exists(table):
            new_rows = insert_stored_if_absent(new_rows, _stored_keys(store, table, accepted), [pk], partial(kept, name="met"))
        new_rows = stamp_lineage(new_rows.select(*typed_columns(table)), source_file, batch_id, loaded_at)
        ins = Observation(f"inserted_{table}_{uuid.uuid4().hex[:6]}")
        store.append(new_rows.observe(ins, F.count(F.lit(1)).alias("n")), table, lambda: ins.get["n"], key=[pk])
        return ins.get["n"]

    def quarantine() -> int:
        if not rejected_rows:  # a clean batch never reads or writes the quarantine table
            return 0
        q_new = first_per_stored_key(referenced(staged.filter(F.col("_reason").isNotNull()), table), ["row_reference"], ORDER_COLS)
        if store.exists("quarantine"):
            stored_q = (store.read("quarantine", C.QUARANTINE_SCHEMA)
                        .filter((F.col("table_name") == table) & (F.col("source_file") == source_file)))
            q_new = insert_stored_if_absent(q_new, stored_q.select("row_reference"), ["row_reference"], partial(kept, name="met-rejected"))
        q_new = quarantine_rows(q_new, table, source_file, batch_id, loaded_at)
        qobs = Observation(f"quarantined_{table}_{uuid.uuid4().hex[:6]}")
        store.append(q_new.select(*C.QUARANTINE_SCHEMA.fieldNames()).observe(
            qobs, F.count(F.lit(1)).alias("n")), "quarantine", lambda: qobs.get["n"])
        return qobs.get["n"]

    inserted, quarantined = (step.result() for step in started(spark, [(accept, ()), (quarantine, ())]))
    # both outputs are committed; the staged copies of the batch are no longer read
    for name in ("named", "classified", "met", "met-rejected"):
        store.drop(f"{staging}-{name}")
    stats = {"inserted": inserted, "skipped_duplicate": valid - inserted, "quarantined": quarantined}
    log.info(json.dumps({"event": "table_ingested", "table": table, "batch_id": batch_id, **stats}))
    return stats


def started(spark: SparkSession, steps: list[tuple[Callable, tuple[int, ...]]]) -> list[Future]:
    """Steps that submit Spark jobs of their own, run at the same time; all have ended on return.

    Each comes with the numbers of earlier steps that it waits for; if one of those fails, it fails likewise and does nothing."""
    def run(step, waits):
        for other in waits:
            other.result()
        return step()

    with ThreadPoolExecutor(max(1, len(steps))) as pool:  # a thread for each, so that none waits for a thread
        out: list[Future] = []
        for step, waits in steps:
            out.append(pool.submit(inheritable_thread_target(spark)(run), step, [out[i] for i in waits]))
    return out


def ingest_dataset(store: TableStore, tables: dict[str, DataFrame], source_file: str,
                   batch_id: str | None = None, loaded_at: _dt.datetime | None = None) -> DataFrame:
    """Ingest the four tables, each as soon as its parent is stored; one batch id and load time for all.

    A table that fails leaves the ones beside it to finish, and the batch raises its error.  Returns the per-table counters as a DataFrame and appends them to the run log."""
    batch_id = batch_id or str(uuid.uuid4())
    loaded_at = loaded_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    log.info(json.dumps({"event": "ingest_batch_started", "batch_id": batch_id, "source_file": source_file}))
    store.sweep()  # what a batch that failed left behind, and what earlier runs replaced
    names = [t for t in C.INGEST_ORDER if t in tables]
    steps = [(partial(ingest_table, store, t, tables[t], source_file, batch_id, loaded_at),
              tuple(names.index(p) for p in [PARENT[t][1]] if p in names) if t in PARENT else ()) for t in names]
    done = [(t, step.result()) for t, step in zip(names, started(store.spark, steps))]
    return log_stats(store, done, batch_id, source_file, loaded_at)


def log_stats(store: TableStore, done: list[tuple[str, dict]], batch_id: str, source_file: str, loaded_at: _dt.datetime) -> DataFrame:
    """The counters as a DataFrame; appended to the run log, with one event for the finished batch."""
    rows = [(t, s["inserted"], s["skipped_duplicate"], s["quarantined"]) for t, s in done]
    stats = store.spark.createDataFrame(rows, C.STATS_SCHEMA)
    finished = {"event": "ingest_batch_finished", "batch_id": batch_id, "source_file": source_file, **{t: s for t, s in done}}
    log.info(json.dumps(finished))
    whole = store.spark.createDataFrame([(json.dumps(finished),)], "event_json string").select(
        ntz_lit(loaded_at).alias("logged_at"), F.lit(batch_id).alias("batch_id"), F.lit(source_file).alias("source_file"),
        F.lit(None).cast("string").alias("table_name"), "event_json")
    store.append(run_log(stats, batch_id, source_file, loaded_at).unionByName(whole), "run_log")
    return stats


def run_log(stats: DataFrame, batch_id: str, source_file: str, logged_at: _dt.datetime) -> DataFrame:
    """One JSON log event per ingested table."""
    payload = F.to_json(F.struct(
        F.lit("table_ingested").alias("event"), F.col("table_name").alias("table"),
        F.lit(batch_id).alias("batch_id"), "inserted", "skipped_duplicate", "quarantined"))
    return stats.select(
        ntz_lit(logged_at).alias("logged_at"),
        F.lit(batch_id).alias("batch_id"), F.lit(source_file).alias("source_file"),
        F.col("table_name"), payload.alias("event_json"))


def ingest_folder(spark: SparkSession, store: TableStore, data_dir: str, source_file: str,
                  multi_line: bool | str = "auto") -> DataFrame:
    """Ingest a drop folder holding machines.csv, production_events.csv, ..."""
    from forgeline.sources.csv import read_dataset

    return ingest_dataset(store, read_dataset(spark, data_dir, multi_line), source_file)
