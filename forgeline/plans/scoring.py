"""Anomaly scoring of machine-days: leave-one-out baseline first, forest on top.

Scores are written to their own table (never into the marts)."""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline import contracts as C
from forgeline.functions import ntz_lit, safe_ratio
from forgeline.operators.iforest import isolation_forest
from forgeline.operators.zscore import loo_zscore
from forgeline.sources.store import TableStore

log = logging.getLogger("forgeline.scoring")

FEATURES = ["total_quantity", "defect_rate_feature", "unit_inconsistency_count"]


def machine_day_features(mart: DataFrame) -> DataFrame:
    """Scoring features from the daily mart; the defect-rate feature is fail/checked with
    0.0 for unchecked days (unrounded, unlike the mart's NULL-when-unchecked rate)."""
    return mart.select(
        F.col("production_day_id").alias("machine_day_key"), "machine_id", "production_date",
        F.col("total_quantity").cast("bigint").alias("total_quantity"),
        "checked_count", "fail_count", "unit_inconsistency_count",
        safe_ratio("fail_count", "checked_count").alias("defect_rate_feature"),
    )


MOMENTS = "machine_moments"  # per machine: rows, sum and sum of squares of its daily quantities, kept by the refresh


def baseline_scores(features: DataFrame, threshold: float = C.BASELINE_Z_THRESHOLD, moments: DataFrame | None = None) -> DataFrame:
    return loo_zscore(features, "machine_id", "total_quantity", threshold, moments=moments)


def baseline_of_days(store: TableStore, days: list[str]) -> DataFrame:
    """Baseline scores of some days' machine-days against all days: reads those days of the mart, and the stored moments."""
    return baseline_scores(machine_day_features(store.read("mart_production_daily", parts=days)), moments=store.read(MOMENTS))


def anomaly_scores(features: DataFrame, scored_at: _dt.datetime | None = None, trees: int = C.FOREST_TREES,
                   max_samples: int = C.FOREST_MAX_SAMPLES, seed: int = C.FOREST_SEED,
                   min_rows: int = C.MIN_ROWS_FOR_FOREST) -> DataFrame:
    """Baseline + forest per machine-day in the anomaly table layout."""
    scored_at = scored_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    base = baseline_scores(features).checkpoint(eager=True)  # read for the count, the samples and the scores
    both = isolation_forest(base, "machine_day_key", FEATURES, trees, max_samples, seed, min_rows)
    return both.select(
        "machine_day_key", "machine_id", "production_date", "total_quantity",
        "baseline_mean", "baseline_stddev", "baseline_z_score", "is_baseline_anomaly",
        "isolation_forest_score", "is_isolation_forest_anomaly",
        ntz_lit(scored_at).alias("scored_at"),
    )


def score_summary(scores: DataFrame, min_rows: int = C.MIN_ROWS_FOR_FOREST) -> DataFrame:
    """One row: machine-days scored, baseline flags, forest flags, whether the forest ran."""
    return scores.agg(
        F.count(F.lit(1)).alias("machine_days_scored"),
        F.count_if("is_baseline_anomaly").alias("baseline_anomalies"),
        F.count_if("is_isolation_forest_anomaly").alias("isolation_forest_anomalies"),
        (F.count(F.lit(1)) >= min_rows).alias("isolation_forest_ran"),
    )


def score_anomalies(spark: SparkSession, store: TableStore) -> DataFrame:
    """Read the daily mart (missing mart: no rows, a warning), score, upsert, summarize."""
    if not store.exists("mart_production_daily"):
        log.warning("mart_production_daily does not exist yet; nothing scored")
        return spark.createDataFrame([(0, 0, 0, False)],
                                     "machine_days_scored long, baseline_anomalies long, "
                                     "isolation_forest_anomalies long, isolation_forest_ran boolean")
    # cut lineage: features are read several times (count, forest sample, scoring)
    features = machine_day_features(store.read("mart_production_daily")).checkpoint(eager=True)
    scores = anomaly_scores(features)
    store.upsert(scores, "anomaly_scores", ["machine_day_key"], C.ANOMALY_SCHEMA, by="production_date")
    written = store.read("anomaly_scores").join(features.select("machine_day_key"), "machine_day_key", "left_semi")
    return score_summary(written)
