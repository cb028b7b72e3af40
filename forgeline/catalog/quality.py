"""Catalog: data-quality tests, report and gate (§2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgeline.catalog.base import register, with_ctes
from forgeline.catalog.ingest import events_classified
from forgeline.contracts import ACCEPTED_UNITS
from forgeline.operators import quality as Q
from forgeline.operators.validate import route_valid
from forgeline.plans.models import build_models
from forgeline.plans.tests_suite import SUITE
from forgeline.sources import bindings as B


def relations(spark, sf_dir):
    return build_models(B.raw_tables(spark, sf_dir))


@register("dq_unique", with_ctes("stg_quality_checks") + """
    SELECT production_event_id, count(*) AS n_records FROM stg_quality_checks
    WHERE production_event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def q_dq_unique(spark, sf_dir):
    return Q.dq_unique(relations(spark, sf_dir)["stg_quality_checks"], "production_event_id")


@register("dq_not_null", with_ctes("stg_quality_checks") + """
    SELECT check_id FROM stg_quality_checks WHERE inspector_id IS NULL""")
def q_dq_not_null(spark, sf_dir):
    return Q.dq_not_null(relations(spark, sf_dir)["stg_quality_checks"], "inspector_id").select("check_id")


@register("dq_relationships", with_ctes("stg_quality_checks", "stg_production_events") + """
    SELECT c.check_id, c.production_event_id FROM stg_quality_checks c
    LEFT JOIN stg_production_events p ON c.production_event_id = p.event_id
    WHERE c.production_event_id IS NOT NULL AND p.event_id IS NULL""")
def q_dq_relationships(spark, sf_dir):
    r = relations(spark, sf_dir)
    return Q.dq_relationships(r["stg_quality_checks"], "production_event_id",
                              r["stg_production_events"], "event_id").select("check_id", "production_event_id")


@register("dq_accepted_values", with_ctes("events_classified") + """
    SELECT event_id, ord, unit FROM events_classified
    WHERE reason IS NULL AND unit IS NOT NULL AND unit NOT IN ('units', 'kg')""")
def q_dq_accepted_values(spark, sf_dir):
    valid = route_valid(events_classified(spark, sf_dir))
    return Q.dq_accepted_values(valid, "unit", ACCEPTED_UNITS).select(
        "event_id", F.col("_pos").cast("int").alias("ord"), "unit")


# the marts' own rates and totals are always in bounds, so these two tests get marts with planted violations
_PLANTED_RATE = "CASE WHEN event_count % 3 = 0 THEN defect_rate + 1.5 WHEN event_count % 3 = 1 THEN -0.25 ELSE defect_rate END"
_PLANTED_TOTAL = "CASE WHEN total_quantity % 4 = 0 THEN 0 WHEN total_quantity % 4 = 1 THEN -total_quantity ELSE total_quantity END"


@register("dq_defect_rate_bounds", with_ctes("mart_production_daily") + f"""
    SELECT * FROM (SELECT production_day_id, machine_id, {_PLANTED_RATE} AS defect_rate FROM mart_production_daily)
    WHERE defect_rate IS NOT NULL AND (defect_rate < 0 OR defect_rate > 1)""")
def q_dq_defect_rate_bounds(spark, sf_dir):
    mart = relations(spark, sf_dir)["mart_production_daily"]
    return Q.dq_defect_rate_bounds(mart.withColumn("defect_rate", F.expr(_PLANTED_RATE)))


@register("dq_positive_total", with_ctes("mart_production_daily") + f"""
    SELECT * FROM (SELECT production_day_id, machine_id, {_PLANTED_TOTAL} AS total_quantity FROM mart_production_daily)
    WHERE total_quantity <= 0""")
def q_dq_positive_total(spark, sf_dir):
    mart = relations(spark, sf_dir)["mart_production_daily"]
    return Q.dq_positive_total(mart.withColumn("total_quantity", F.expr(_PLANTED_TOTAL)))


def _report_sql() -> str:
    rows = []
    for t in SUITE:
        col = f"'{t.column}'" if t.column else "CAST(NULL AS VARCHAR)"
        if t.kind == "not_null":
            cnt = f"SELECT count(*) FROM {t.relation} WHERE {t.column} IS NULL"
        elif t.kind == "unique":
            cnt = (f"SELECT count(*) FROM (SELECT {t.column} FROM {t.relation} WHERE {t.column} IS NOT NULL "
                   f"GROUP BY 1 HAVING count(*) > 1)")
        elif t.kind == "relationships":
            cnt = (f"SELECT count(*) FROM {t.relation} c LEFT JOIN (SELECT DISTINCT {t.field} AS k FROM {t.to}) p "
                   f"ON c.{t.column} = p.k WHERE c.{t.column} IS NOT NULL AND p.k IS NULL")
        elif t.kind == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in t.values)
            cnt = f"SELECT count(*) FROM {t.relation} WHERE {t.column} IS NOT NULL AND {t.column} NOT IN ({vals})"
        elif t.name == "assert_defect_rate_within_bounds":
            cnt = ("SELECT count(*) FROM mart_production_daily WHERE defect_rate IS NOT NULL "
                   "AND (defect_rate < 0 OR defect_rate > 1)")
        else:
            cnt = "SELECT count(*) FROM mart_production_daily WHERE total_quantity <= 0"
        rows.append(f"SELECT '{t.name}' AS test_name, '{t.kind}' AS test_type, '{t.relation}' AS relation, "
                    f"{col} AS column_name, '{t.severity}' AS severity, '{','.join(t.tags)}' AS tags, "
                    f"CAST(({cnt}) AS BIGINT) AS violations")
    return "\nUNION ALL\n".join(rows)


_ALL = ["machines", "production_events", "quality_checks", "maintenance_events",
        "int_production_enriched", "int_daily_machine_summary", "mart_production_daily",
        "mart_quality_summary", "mart_machine_downtime"]


@register("dq_report", with_ctes(*_ALL) + _report_sql())
def q_dq_report(spark, sf_dir):
    return Q.dq_report(SUITE, relations(spark, sf_dir))


@register("dq_gate", with_ctes(*_ALL, extra=f"report AS ({_report_sql()})") + """
    SELECT count(*) AS tests_run,
           count(*) FILTER (WHERE severity = 'error' AND violations > 0) AS failed_error_tests,
           count(*) FILTER (WHERE severity <> 'error' AND violations > 0) AS warnings,
           count(*) FILTER (WHERE severity = 'error' AND violations > 0) = 0 AS gate_passed
    FROM report""")
def q_dq_gate(spark, sf_dir):
    return Q.dq_gate(Q.dq_report(SUITE, relations(spark, sf_dir)))
