"""The daily run: detect -> ingest -> models -> data tests -> gate -> scoring."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.operators.quality import dq_gate, dq_report, enforce_gate
from forgeline.plans.ingest import ingest_folder
from forgeline.plans.refresh import refresh_models, stored_models
from forgeline.plans.scoring import score_anomalies
from forgeline.plans.tests_suite import SUITE
from forgeline.sources.store import TableStore

log = logging.getLogger("forgeline.daily")


def arrived(spark: SparkSession, data_dir: str) -> bool:
    """Has the day's drop folder arrived (its production events file is present)?"""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{data_dir.rstrip('/')}/production_events.csv")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


SUMMARY = ("run_date string, status string, inserted long, skipped_duplicate long, quarantined long, "
           "failed_error_tests long, gate_passed boolean, machine_days_scored long, baseline_anomalies long, "
           "isolation_forest_anomalies long, isolation_forest_ran boolean")


def run_daily(spark: SparkSession, data_dir: str, store_root: str, run_date: str,
              multi_line: bool | str = "auto", raise_on_failed_tests: bool = True) -> DataFrame:
    """One scheduled run; safe to repeat for the same date (sinks are idempotent and
    the source label is per date).  Returns one summary row.

    Failed error-severity data tests stop the run before scoring: it raises
    QualityGateError, or, without ``raise_on_failed_tests``, reports ``blocked_by_data_tests``."""
    store = TableStore(spark, store_root)
    if not arrived(spark, data_dir):
        log.info("no drop folder for %s at %s", run_date, data_dir)
        return spark.createDataFrame([(run_date, "no_data", 0, 0, 0, 0, None, 0, 0, 0, False)], SUMMARY)
    stats = ingest_folder(spark, store, data_dir, f"daily/{run_date}", multi_line)
    totals = stats.agg(*[F.sum(c).alias(c) for c in ("inserted", "skipped_duplicate", "quarantined")]).first()
    refresh_models(store)
    store.overwrite(dq_report(SUITE, stored_models(store)), "dq_report")
    report = store.read("dq_report")
    gate = (enforce_gate(report) if raise_on_failed_tests else dq_gate(report)).first()
    scores, status = (0, 0, 0, False), "blocked_by_data_tests"
    if gate["gate_passed"]:
        scores, status = tuple(score_anomalies(spark, store).first()), "scored"
    return spark.createDataFrame(
        [(run_date, status, totals["inserted"], totals["skipped_duplicate"], totals["quarantined"],
          gate["failed_error_tests"], gate["gate_passed"], *scores)], SUMMARY)
