"""Intermediate models: newest check per event, enriched events, daily machine summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.functions import machine_day_key
from forgeline.operators.topk import latest_per_key


def latest_quality_check(stg_checks: DataFrame) -> DataFrame:
    """Newest check per production event (by check_timestamp, then check_id) and the
    number of checks the event received.  One row per event that has checks."""
    return latest_per_key(
        stg_checks, "production_event_id",
        order_by=["check_timestamp", "check_id"],
        carry=["result", "defect_type"],
        count_alias="n_checks",
    )


def events_with_check(stg_events: DataFrame, latest: DataFrame) -> DataFrame:
    """Each production event with its newest check (left join, 1:0..1)."""
    chk = latest.select(
        F.col("production_event_id").alias("event_id"), "check_id",
        F.col("result").alias("quality_result"), "defect_type", "n_checks",
    )
    return (stg_events.join(chk, "event_id", "left")
            .withColumn("has_duplicate_quality_checks",
                        F.coalesce(F.col("n_checks"), F.lit(0)) > 1)
            .drop("n_checks"))


def int_production_enriched(stg_events: DataFrame, stg_machines: DataFrame,
                            stg_checks: DataFrame | None = None,
                            latest: DataFrame | None = None) -> DataFrame:
    """One row per production event with machine type and its newest quality check."""
    if latest is None:
        latest = latest_quality_check(stg_checks)
    ev = events_with_check(stg_events, latest)
    return (ev.join(stg_machines.select("machine_id", "machine_type"), "machine_id", "left")
            .select("event_id", "machine_id", "machine_type", "production_date", "product_code",
                    "quantity_produced", "unit", "has_unit_inconsistency", "shift", "check_id",
                    "quality_result", "defect_type", "has_duplicate_quality_checks"))


def _daily_aggs():
    return [
        F.count(F.lit(1)).alias("event_count"),
        F.sum("quantity_produced").cast("bigint").alias("total_quantity"),
        F.count("check_id").alias("checked_count"),
        F.count_if(F.col("quality_result") == "fail").alias("fail_count"),
        F.count_if(F.col("has_unit_inconsistency")).alias("unit_inconsistency_count"),
    ]


def int_daily_machine_summary(stg_events: DataFrame, stg_machines: DataFrame,
                              stg_checks: DataFrame | None = None,
                              latest: DataFrame | None = None) -> DataFrame:
    """One row per machine and day.

    Same result as grouping the enriched events by (machine, type, day): the machine
    type depends on machine_id alone (machine_id is the machines key), so events are
    aggregated first and the machine attributes joined to the far smaller daily rows.
    """
    if latest is None:
        latest = latest_quality_check(stg_checks)
    daily = (events_with_check(stg_events, latest)
             .groupBy("machine_id", "production_date").agg(*_daily_aggs()))
    return (daily.join(stg_machines.select("machine_id", "machine_type"), "machine_id", "left")
            .select(machine_day_key("machine_id", "production_date").alias("machine_day_key"),
                    "machine_id", "machine_type", "production_date", "event_count",
                    "total_quantity", "checked_count", "fail_count", "unit_inconsistency_count"))


def daily_summary_from_enriched(enriched: DataFrame) -> DataFrame:
    """The daily summary from an already materialized enriched table."""
    return (enriched.groupBy("machine_id", "machine_type", "production_date").agg(*_daily_aggs())
            .select(machine_day_key("machine_id", "production_date").alias("machine_day_key"),
                    "machine_id", "machine_type", "production_date", "event_count",
                    "total_quantity", "checked_count", "fail_count", "unit_inconsistency_count"))
