"""Mart models: daily production, quality by product, machine downtime."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.contracts import DEFECT_TYPES
from forgeline.functions import defect_rate


def mart_production_daily(daily: DataFrame) -> DataFrame:
    return daily.select(
        F.col("machine_day_key").alias("production_day_id"), "machine_id", "machine_type",
        "production_date", "event_count", "total_quantity", "checked_count", "fail_count",
        defect_rate("fail_count", "checked_count").alias("defect_rate"),
        "unit_inconsistency_count",
    )


QUALITY_COUNTS = ["total_checks", "pass_count", "fail_count", *(f"defect_{t}_count" for t in DEFECT_TYPES)]


def quality_counts(enriched: DataFrame, *by: str) -> DataFrame:
    """Checks, pass/fail counts and one count per defect type, by the given columns."""
    return enriched.groupBy(*by).agg(
        F.count("check_id").alias("total_checks"),
        F.count_if(F.col("quality_result") == "pass").alias("pass_count"),
        F.count_if(F.col("quality_result") == "fail").alias("fail_count"),
        *[F.count_if(F.col("defect_type") == t).alias(f"defect_{t}_count") for t in DEFECT_TYPES])


def quality_rates(counts: DataFrame) -> DataFrame:
    return counts.select("product_code", "total_checks", "pass_count", "fail_count", defect_rate("fail_count", "total_checks").alias("defect_rate"),
                         *[f"defect_{t}_count" for t in DEFECT_TYPES])


def mart_quality_summary(enriched: DataFrame) -> DataFrame:
    """Per product: checks, pass/fail counts, defect rate and one count per defect type.

    ``enriched`` needs product_code, check_id, quality_result, defect_type (machine
    attributes are not used, so events joined to their newest check suffice)."""
    return quality_rates(quality_counts(enriched, "product_code"))


def maintenance_by_machine(stg_maintenance: DataFrame) -> DataFrame:
    """Per machine: maintenance count, summed duration, latest end (partial aggregate)."""
    return stg_maintenance.groupBy("machine_id").agg(
        F.count("maintenance_id").alias("maintenance_event_count"),
        F.sum("duration_hours").alias("total_downtime_hours"),
        F.max("end_time").alias("last_maintenance_end"),
    )


def mart_machine_downtime(stg_machines: DataFrame, stg_maintenance: DataFrame) -> DataFrame:
    """Every machine with its maintenance totals; machines without maintenance get 0 / NULL.

    Maintenance is aggregated per machine before the join (1:0..1 instead of 1:n), so a
    machine with very many interventions never concentrates raw rows in one join task."""
    per_machine = maintenance_by_machine(stg_maintenance)
    return (stg_machines.select("machine_id", "machine_name", "machine_type")
            .join(per_machine, "machine_id", "left")
            .select("machine_id", "machine_name", "machine_type",
                    F.coalesce("maintenance_event_count", F.lit(0)).alias("maintenance_event_count"),
                    F.coalesce("total_downtime_hours", F.lit(0.0)).alias("total_downtime_hours"),
                    "last_maintenance_end"))
