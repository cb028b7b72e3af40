"""Staging models: light projections of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.contracts import BASE_UNIT
from forgeline.functions import duration_hours


def stg_machines(raw: DataFrame) -> DataFrame:
    return raw.select("machine_id", "machine_name", "machine_type", "install_date", "ingested_at")


def stg_production_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id", "machine_id", "event_timestamp",
        F.to_date("event_timestamp").alias("production_date"),
        "product_code", "quantity_produced", "unit",
        (F.col("unit") != F.lit(BASE_UNIT)).alias("has_unit_inconsistency"),
        "shift", "ingested_at",
    )


def stg_quality_checks(raw: DataFrame) -> DataFrame:
    return raw.select(
        "check_id", "production_event_id", "check_timestamp", "result", "defect_type",
        "inspector_id", F.col("inspector_id").isNull().alias("is_missing_inspector"), "ingested_at",
    )


def stg_maintenance_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "maintenance_id", "machine_id", "start_time", "end_time",
        duration_hours("start_time", "end_time").alias("duration_hours"),
        "maintenance_type", "technician_id", "ingested_at",
    )


def staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_machines": stg_machines(raw["machines"]),
        "stg_production_events": stg_production_events(raw["production_events"]),
        "stg_quality_checks": stg_quality_checks(raw["quality_checks"]),
        "stg_maintenance_events": stg_maintenance_events(raw["maintenance_events"]),
    }
