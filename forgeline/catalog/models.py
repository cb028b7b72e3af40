"""Catalog: staging, intermediate and mart models, joins, aggregations, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.catalog.base import register, rounded, with_ctes
from forgeline.plans import intermediate as I
from forgeline.plans import marts as M
from forgeline.plans import staging as S
from forgeline.sources import bindings as B


# ---------------------------------------------------------------------------
# Shared Spark builders
# ---------------------------------------------------------------------------
def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return S.staging(B.raw_tables(spark, sf_dir))


def _latest(st):
    return I.latest_quality_check(st["stg_quality_checks"])


def daily(spark, sf_dir) -> DataFrame:
    st = staged(spark, sf_dir)
    return I.int_daily_machine_summary(st["stg_production_events"], st["stg_machines"], latest=_latest(st))


def production_daily(spark, sf_dir) -> DataFrame:
    return M.mart_production_daily(daily(spark, sf_dir))


# ---------------------------------------------------------------------------
# §2.3 projections
# ---------------------------------------------------------------------------
for _n in ["stg_machines", "stg_production_events", "stg_quality_checks", "stg_maintenance_events"]:
    def _mk(n):
        def q(spark, sf_dir):
            return staged(spark, sf_dir)[n]
        q.__name__ = n
        return q
    register(_n, with_ctes(_n) + f"SELECT * FROM {_n}")(_mk(_n))


@register("mart_rename", with_ctes("int_daily_machine_summary") + """
    SELECT machine_day_key AS production_day_id, machine_id, production_date
    FROM int_daily_machine_summary""")
def q_mart_rename(spark, sf_dir):
    return daily(spark, sf_dir).select(
        F.col("machine_day_key").alias("production_day_id"), "machine_id", "production_date")


# ---------------------------------------------------------------------------
# §2.4 joins, §2.5 aggregations, §2.6 windows
# ---------------------------------------------------------------------------
@register("latest_check", with_ctes("newest_check") + """
    SELECT production_event_id, check_id, check_timestamp, result, defect_type, n_checks
    FROM newest_check""")
def q_latest_check(spark, sf_dir):
    return _latest(staged(spark, sf_dir))


@register("int_production_enriched", with_ctes("int_production_enriched") + "SELECT * FROM int_production_enriched")
def q_enriched(spark, sf_dir):
    st = staged(spark, sf_dir)
    return I.int_production_enriched(st["stg_production_events"], st["stg_machines"], latest=_latest(st))


@register("int_daily_machine_summary", with_ctes("int_daily_machine_summary") + "SELECT * FROM int_daily_machine_summary")
def q_daily(spark, sf_dir):
    return daily(spark, sf_dir)


@register("mart_production_daily", with_ctes("mart_production_daily") + "SELECT * FROM mart_production_daily")
def q_mart_production_daily(spark, sf_dir):
    return production_daily(spark, sf_dir)


@register("mart_quality_summary", with_ctes("mart_quality_summary") + "SELECT * FROM mart_quality_summary")
def q_mart_quality_summary(spark, sf_dir):
    st = staged(spark, sf_dir)
    return M.mart_quality_summary(I.events_with_check(st["stg_production_events"], _latest(st)))


@register("mart_machine_downtime", with_ctes("mart_machine_downtime") + """
    SELECT machine_id, machine_name, machine_type, maintenance_event_count,
           round(total_downtime_hours, 6) AS total_downtime_hours, last_maintenance_end
    FROM mart_machine_downtime""")
def q_mart_machine_downtime(spark, sf_dir):
    st = staged(spark, sf_dir)
    return rounded(M.mart_machine_downtime(st["stg_machines"], st["stg_maintenance_events"]),
                   ["total_downtime_hours"])


# ---------------------------------------------------------------------------
# Individual joins, aggregates and windows of the models (J1-J3, A2, A3, A6, W2, O1)
# ---------------------------------------------------------------------------
from forgeline.operators.topk import count_per_key, top_k_per_group  # noqa: E402


@register("join_event_machine", with_ctes("stg_production_events", "stg_machines") + """
    SELECT p.event_id, p.machine_id, m.machine_type
    FROM stg_production_events p LEFT JOIN stg_machines m ON p.machine_id = m.machine_id""")
def q_join_event_machine(spark, sf_dir):
    st = staged(spark, sf_dir)
    return st["stg_production_events"].join(
        st["stg_machines"].select("machine_id", "machine_type"), "machine_id", "left").select(
        "event_id", "machine_id", "machine_type")


@register("join_event_latest_check", with_ctes("stg_production_events", "newest_check") + """
    SELECT p.event_id, q.check_id, q.result AS quality_result, q.n_checks
    FROM stg_production_events p
    LEFT JOIN newest_check q ON q.production_event_id = p.event_id""")
def q_join_event_latest_check(spark, sf_dir):
    st = staged(spark, sf_dir)
    chk = _latest(st).select(F.col("production_event_id").alias("event_id"), "check_id",
                             F.col("result").alias("quality_result"), "n_checks")
    return st["stg_production_events"].select("event_id").join(chk, "event_id", "left")


@register("join_machine_maintenance", with_ctes("stg_machines", "stg_maintenance_events") + """
    SELECT m.machine_id, x.maintenance_id, x.end_time
    FROM stg_machines m LEFT JOIN stg_maintenance_events x ON m.machine_id = x.machine_id""")
def q_join_machine_maintenance(spark, sf_dir):
    """An inner join, whose hot side AQE may split (it cannot split the right side of a left join), and the
    machines without maintenance."""
    st = staged(spark, sf_dir)
    machines = st["stg_machines"].select("machine_id")
    done = st["stg_maintenance_events"].select("machine_id", "maintenance_id", "end_time")
    none = machines.join(done.select("machine_id"), "machine_id", "left_anti")
    return machines.join(done, "machine_id").unionByName(none, allowMissingColumns=True)


@register("count_filter", with_ctes("int_production_enriched") + """
    SELECT product_code, shift,
           count(*) FILTER (WHERE quality_result = 'fail') AS fail_count,
           count(*) FILTER (WHERE has_unit_inconsistency) AS unit_inconsistency_count
    FROM int_production_enriched GROUP BY 1, 2""")
def q_count_filter(spark, sf_dir):
    st = staged(spark, sf_dir)
    ev = I.events_with_check(st["stg_production_events"], _latest(st))
    return ev.groupBy("product_code", "shift").agg(
        F.count_if(F.col("quality_result") == "fail").alias("fail_count"),
        F.count_if(F.col("has_unit_inconsistency")).alias("unit_inconsistency_count"))


@register("count_non_null", with_ctes("int_production_enriched") + """
    SELECT machine_id, count(*) AS event_count, count(check_id) AS checked_count
    FROM int_production_enriched GROUP BY 1""")
def q_count_non_null(spark, sf_dir):
    st = staged(spark, sf_dir)
    ev = I.events_with_check(st["stg_production_events"], _latest(st))
    return ev.groupBy("machine_id").agg(F.count(F.lit(1)).alias("event_count"),
                                        F.count("check_id").alias("checked_count"))


@register("defect_rate", with_ctes("mart_production_daily") + """
    SELECT production_day_id, fail_count, checked_count, defect_rate FROM mart_production_daily""")
def q_defect_rate(spark, sf_dir):
    return production_daily(spark, sf_dir).select("production_day_id", "fail_count", "checked_count",
                                                  "defect_rate")


@register("check_count", with_ctes("stg_quality_checks") + """
    SELECT c.check_id, c.production_event_id,
           (SELECT count(*) FROM stg_quality_checks o WHERE o.production_event_id IS NOT DISTINCT FROM c.production_event_id) AS n_checks
    FROM stg_quality_checks c""")
def q_check_count(spark, sf_dir):
    chk = staged(spark, sf_dir)["stg_quality_checks"].select("check_id", "production_event_id")
    return count_per_key(chk, "production_event_id", "n_checks").select(
        "check_id", "production_event_id", "n_checks")


@register("topk_per_group", with_ctes("newest_check") + """
    SELECT production_event_id, check_id, 1 AS rank FROM newest_check""")
def q_topk_per_group(spark, sf_dir):
    chk = staged(spark, sf_dir)["stg_quality_checks"]
    return top_k_per_group(chk, ["production_event_id"],
                           [F.desc("check_timestamp"), F.desc("check_id")], 1).select(
        "production_event_id", "check_id", "rank")
