"""The declared data-test suite of the models (46 generic tests + 2 singular assertions)."""

from __future__ import annotations

from forgeline.contracts import ACCEPTED_RESULTS, ACCEPTED_UNITS
from forgeline.operators.quality import DQTest


def _key(rel, col):
    return [DQTest("unique", rel, col), DQTest("not_null", rel, col)]


def _fk(rel, col, to, field):
    return [DQTest("not_null", rel, col), DQTest("relationships", rel, col, to=to, field=field)]


SUITE: list[DQTest] = [
    # raw sources
    *_key("machines", "machine_id"), DQTest("not_null", "machines", "machine_type"),
    *_key("production_events", "event_id"), *_fk("production_events", "machine_id", "machines", "machine_id"),
    DQTest("accepted_values", "production_events", "unit", values=tuple(ACCEPTED_UNITS)),
    *_key("quality_checks", "check_id"),
    *_fk("quality_checks", "production_event_id", "production_events", "event_id"),
    DQTest("accepted_values", "quality_checks", "result", values=tuple(ACCEPTED_RESULTS)),
    *_key("maintenance_events", "maintenance_id"),
    *_fk("maintenance_events", "machine_id", "machines", "machine_id"),
    # staging
    *_key("stg_machines", "machine_id"),
    *_key("stg_production_events", "event_id"),
    *_fk("stg_production_events", "machine_id", "stg_machines", "machine_id"),
    DQTest("not_null", "stg_production_events", "quantity_produced"),
    *_key("stg_quality_checks", "check_id"),
    *_fk("stg_quality_checks", "production_event_id", "stg_production_events", "event_id"),
    *_key("stg_maintenance_events", "maintenance_id"),
    *_fk("stg_maintenance_events", "machine_id", "stg_machines", "machine_id"),
    DQTest("not_null", "stg_maintenance_events", "duration_hours"),
    # intermediate
    *_key("int_production_enriched", "event_id"),
    *_key("int_daily_machine_summary", "machine_day_key"),
    DQTest("not_null", "int_daily_machine_summary", "machine_id"),
    DQTest("not_null", "int_daily_machine_summary", "total_quantity"),
    # marts
    *_key("mart_production_daily", "production_day_id"),
    DQTest("not_null", "mart_production_daily", "machine_id"),
    *_key("mart_quality_summary", "product_code"),
    *_key("mart_machine_downtime", "machine_id"),
    # singular assertions
    DQTest("singular", "mart_production_daily", None, "error", ("quality_rule",),
           name_override="assert_defect_rate_within_bounds"),
    DQTest("singular", "mart_production_daily", None, "error", ("quality_rule",),
           name_override="assert_positive_total_quantity"),
]
