"""Catalog: machine-day features, leave-one-out baseline, isolation forest, scores (§2.9, A8, S7, J6, W4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from forgeline import contracts as C
from forgeline.catalog.base import define_cte, register, rounded, with_ctes
from forgeline.catalog.forest_sql import forest_sql
from forgeline.catalog.models import production_daily, staged
from forgeline.operators.iforest import isolation_forest
from forgeline.operators.zscore import loo_frame
from forgeline.plans import intermediate as I
from forgeline.plans import marts as M
from forgeline.plans.scoring import (
    FEATURES,
    anomaly_scores,
    baseline_scores,
    machine_day_features,
    score_anomalies,
    score_summary,
)
from forgeline.functions import ntz_lit
from forgeline.session import drop_scratch, scratch_path
from forgeline.sources.store import TableStore

FIXED_SCORED_AT = _dt.datetime(2026, 1, 3, 0, 0, 0)
BASELINE_COLS = ["machine_day_key", "machine_id", "production_date", "total_quantity",
                  "baseline_mean", "baseline_stddev", "baseline_z_score", "is_baseline_anomaly"]
BASELINE_DOUBLES = ["baseline_mean", "baseline_stddev", "baseline_z_score"]


def features(spark, sf_dir):
    return machine_day_features(production_daily(spark, sf_dir))


# each row's own frame of the group's other rows
_LOO_SQL = """
    SELECT production_day_id AS machine_day_key, machine_id, production_date,
           CAST(total_quantity AS BIGINT) AS x, count(*) OVER w AS k,
           CAST(coalesce(sum(total_quantity) OVER w, 0) AS HUGEINT) AS p,
           CAST(coalesce(sum(CAST(total_quantity AS HUGEINT) * total_quantity) OVER w, 0) AS HUGEINT) AS q
    FROM {src}
    WINDOW w AS (PARTITION BY machine_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW)"""


def z_sql(src_cte: str) -> str:
    return f"""
    SELECT machine_day_key, machine_id, production_date, x AS total_quantity,
           round(mean, 6) AS baseline_mean, round(sd, 6) AS baseline_stddev,
           round(CASE WHEN k >= 2 AND num > 0 THEN (x - mean) / sd END, 6) AS baseline_z_score,
           coalesce(k >= 2 AND num > 0 AND abs((x - mean) / sd) > 2.5, false) AS is_baseline_anomaly
    FROM (SELECT *, CASE WHEN k >= 2 THEN CAST(p AS DOUBLE) / k END AS mean,
                    CASE WHEN k >= 2 THEN sqrt(CAST(k * q - p * p AS DOUBLE)) / k END AS sd,
                    k * q - p * p AS num
          FROM {src_cte})"""


define_cte("loo_frame", _LOO_SQL.format(src="mart_production_daily"), ["mart_production_daily"])


define_cte("machine_day_features", """
    SELECT production_day_id AS machine_day_key, machine_id, production_date,
           CAST(total_quantity AS BIGINT) AS total_quantity, checked_count, fail_count,
           unit_inconsistency_count,
           CASE WHEN checked_count = 0 THEN 0.0 ELSE CAST(fail_count AS DOUBLE) / checked_count END
               AS defect_rate_feature
    FROM mart_production_daily""", ["mart_production_daily"])
define_cte("forest_scores", forest_sql("machine_day_features", "machine_day_key", FEATURES), ["machine_day_features"])


@register("machine_day_features", with_ctes("machine_day_features") + "SELECT * FROM machine_day_features")
def q_machine_day_features(spark, sf_dir):
    return features(spark, sf_dir)


@register("loo_frame", with_ctes("loo_frame") + """
    SELECT machine_day_key, k AS peer_count, CAST(p AS DECIMAL(38,0)) AS peer_sum,
           CAST(q AS DECIMAL(38,0)) AS peer_sum_sq
    FROM loo_frame""")
def q_loo_frame(spark, sf_dir):
    return loo_frame(features(spark, sf_dir), "machine_id", "total_quantity").select(
        "machine_day_key", "peer_count", "peer_sum", "peer_sum_sq")


@register("loo_peers", with_ctes("loo_frame") + """
    SELECT machine_day_key, k AS peer_days,
           round(CASE WHEN k > 0 THEN CAST(p AS DOUBLE) / k END, 6) AS peer_mean
    FROM loo_frame""")
def q_loo_peers(spark, sf_dir):
    f = loo_frame(features(spark, sf_dir), "machine_id", "total_quantity")
    return f.select("machine_day_key", F.col("peer_count").alias("peer_days"),
                    F.round(F.when(F.col("peer_count") > 0, F.col("peer_sum").cast("double") / F.col("peer_count")),
                            6).alias("peer_mean"))


@register("loo_zscore", with_ctes("loo_frame") + z_sql("loo_frame"))
def q_loo_zscore(spark, sf_dir):
    return rounded(baseline_scores(features(spark, sf_dir)).select(*BASELINE_COLS), BASELINE_DOUBLES)


@register("isolation_forest", with_ctes("forest_scores") + """
    SELECT machine_day_key, round(isolation_forest_score, 6) AS isolation_forest_score, is_isolation_forest_anomaly FROM forest_scores""")
def q_isolation_forest(spark, sf_dir):
    """Forest score per machine-day; the SQL grows and walks the same forest."""
    f = features(spark, sf_dir).checkpoint(eager=True)
    return rounded(isolation_forest(f, "machine_day_key", FEATURES, C.FOREST_TREES, C.FOREST_MAX_SAMPLES,
                                    C.FOREST_SEED, C.MIN_ROWS_FOR_FOREST).select(
        "machine_day_key", "isolation_forest_score", "is_isolation_forest_anomaly"), ["isolation_forest_score"])


@register("forest_min_rows", with_ctes("mart_quality_summary") + """
    SELECT product_code, CAST(NULL AS DOUBLE) AS isolation_forest_score,
           false AS is_isolation_forest_anomaly
    FROM mart_quality_summary""")
def q_forest_min_rows(spark, sf_dir):
    """The forest over per-product quality rows: fewer rows than the minimum (one per
    product), so every score is NULL and nothing is flagged."""
    st = staged(spark, sf_dir)
    qs = M.mart_quality_summary(I.events_with_check(st["stg_production_events"],
                                                    I.latest_quality_check(st["stg_quality_checks"])))
    return isolation_forest(qs, "product_code", ["total_checks", "fail_count"],
                            min_rows=C.MIN_ROWS_FOR_FOREST).select(
        "product_code", "isolation_forest_score", "is_isolation_forest_anomaly")


_ANOMALY_SQL = f"""
    SELECT z.*, round(isolation_forest_score, 6) AS isolation_forest_score, is_isolation_forest_anomaly, TIMESTAMP '{FIXED_SCORED_AT}' AS scored_at
    FROM ({z_sql('loo_frame')}) z JOIN forest_scores USING (machine_day_key)"""
_SUMMARY_SQL = f"""
    SELECT count(*) AS machine_days_scored, count(*) FILTER (is_baseline_anomaly) AS baseline_anomalies,
           count(*) FILTER (is_isolation_forest_anomaly) AS isolation_forest_anomalies, count(*) >= 20 AS isolation_forest_ran
    FROM ({_ANOMALY_SQL})"""


@register("anomaly_scores", with_ctes("loo_frame", "forest_scores") + _ANOMALY_SQL)
def q_anomaly_scores(spark, sf_dir):
    f = features(spark, sf_dir).checkpoint(eager=True)
    return rounded(anomaly_scores(f, FIXED_SCORED_AT), [*BASELINE_DOUBLES, "isolation_forest_score"])


@register("score_summary", with_ctes("loo_frame", "forest_scores") + _SUMMARY_SQL)
def q_score_summary(spark, sf_dir):
    f = features(spark, sf_dir).checkpoint(eager=True)
    return score_summary(anomaly_scores(f, FIXED_SCORED_AT))


@register("score_missing_mart", with_ctes("loo_frame", "forest_scores") + f"""
    SELECT 'no mart' AS store, 0::BIGINT AS machine_days_scored, 0::BIGINT AS baseline_anomalies, 0::BIGINT AS isolation_forest_anomalies, false AS isolation_forest_ran
    UNION ALL SELECT 'mart', * FROM ({_SUMMARY_SQL})""")
def q_score_missing_mart(spark, sf_dir):
    """Scoring through a store that has no mart yet, and again once the mart is there."""
    store = TableStore(spark, scratch_path(spark, "missing-mart"))
    none = score_anomalies(spark, store)
    store.commit(store.write_parts(production_daily(spark, sf_dir), "mart_production_daily", "production_date"))
    out = (none.select(F.lit("no mart").alias("store"), "*").unionByName(score_anomalies(spark, store).select(F.lit("mart").alias("store"), "*"))).checkpoint()
    drop_scratch(spark, store.root)
    return out


@register("scoring_time", with_ctes("mart_production_daily") + """
    SELECT count(*) AS machine_days, 1::BIGINT AS stamps, true AS within_the_run FROM mart_production_daily""")
def q_scoring_time(spark, sf_dir):
    """The stamp of a scoring run: one for all its rows, and between the run's start and end."""
    now = lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    began = now()
    scored = anomaly_scores(features(spark, sf_dir).checkpoint(eager=True)).checkpoint()
    return scored.agg(F.count("*").alias("machine_days"), F.countDistinct("scored_at").alias("stamps"),
                      F.min(F.col("scored_at").between(ntz_lit(began), ntz_lit(now()))).alias("within_the_run"))


_CUT_OLD = _dt.date(2024, 1, 15)
_CUT_NEW = _dt.date(2024, 1, 10)
define_cte("mpd_old", "SELECT * FROM mart_production_daily WHERE production_date < DATE '2024-01-15'",
           ["mart_production_daily"])
define_cte("mpd_new", "SELECT * FROM mart_production_daily WHERE production_date >= DATE '2024-01-10'",
           ["mart_production_daily"])
define_cte("loo_old", _LOO_SQL.format(src="mpd_old"), ["mpd_old"])
define_cte("loo_new", _LOO_SQL.format(src="mpd_new"), ["mpd_new"])


@register("upsert_scores", with_ctes("loo_old", "loo_new") + f"""
    SELECT * FROM ({z_sql('loo_old')}) WHERE production_date < DATE '2024-01-10'
    UNION ALL
    {z_sql('loo_new')}""")
def q_upsert_scores(spark, sf_dir):
    """Scores of days before Jan 15 written first, then scores of days from Jan 10 (each
    scored within its own window, forest included) upserted: overlapping days take the
    newer values, older days stay.  The forest columns have no SQL equivalent, so the
    comparison covers the baseline columns."""
    f = features(spark, sf_dir).checkpoint(eager=True)
    store = TableStore(spark, scratch_path(spark, "scores"))
    for part in (f.filter(F.col("production_date") < F.lit(_CUT_OLD)),
                 f.filter(F.col("production_date") >= F.lit(_CUT_NEW))):
        store.upsert(anomaly_scores(part, FIXED_SCORED_AT),
                     "anomaly_scores", ["machine_day_key"], C.ANOMALY_SCHEMA, by="production_date")
    out = rounded(store.read("anomaly_scores").select(*BASELINE_COLS), BASELINE_DOUBLES).checkpoint()
    drop_scratch(spark, store.root)
    return out
