"""The model graph: raw tables -> staging -> intermediate -> marts, as lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from forgeline.plans import intermediate as I
from forgeline.plans import marts as M
from forgeline.plans import staging as S

MARTS = ["mart_production_daily", "mart_quality_summary", "mart_machine_downtime"]


def build_models(raw: dict[str, DataFrame], latest: DataFrame | None = None) -> dict[str, DataFrame]:
    """All relations of the graph keyed by model name (raw tables included).

    ``latest`` (newest check per event, the costliest intermediate step) may be passed
    in already materialized so the enriched model and both marts reuse it."""
    st = S.staging(raw)
    if latest is None:
        latest = I.latest_quality_check(st["stg_quality_checks"])
    ev, mach = st["stg_production_events"], st["stg_machines"]
    daily = I.int_daily_machine_summary(ev, mach, latest=latest)
    return {
        **raw, **st,
        "int_latest_quality_check": latest,
        "int_production_enriched": I.int_production_enriched(ev, mach, latest=latest),
        "int_daily_machine_summary": daily,
        "mart_production_daily": M.mart_production_daily(daily),
        "mart_quality_summary": M.mart_quality_summary(I.events_with_check(ev, latest)),
        "mart_machine_downtime": M.mart_machine_downtime(mach, st["stg_maintenance_events"]),
    }
