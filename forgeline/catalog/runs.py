"""Catalog: CSV source/sink round trip, file-arrival streaming ingest, daily run (S1-S4, S11, L2)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline import contracts as C
from forgeline.catalog.base import define_cte, register, rounded, with_ctes
from forgeline.catalog.forest_sql import forest_sql
from forgeline.catalog.ingest import FIXED_SOURCE
from forgeline.catalog.scoring import BASELINE_COLS, BASELINE_DOUBLES, z_sql
from forgeline.operators.topk import latest_per_key, merge_latest
from forgeline.plans.daily import run_daily
from forgeline.plans.refresh import refresh_models
from forgeline.plans.scoring import FEATURES, baseline_of_days
from forgeline.session import drop_scratch, scratch_path, shuffled_by_size
from forgeline.sources import bindings as B
from forgeline.sources.csv import read_csv, read_dataset, write_csv
from forgeline.sources.store import TableStore
from forgeline.streaming.arrival import stream_ingest


ROWS_PER_FILE = 1_000_000  # a packed file is read by one task


def export_text_batch(spark: SparkSession, sf_dir: str, root: str, per_table_dirs: bool = False, unit: str | None = None, only: str | None = None) -> str:
    """Write the text batch as packed header CSV files, first copies in the first files: neither sorted nor shuffled.

    ``per_table_dirs``: ``root/<table>/part-*.csv`` (stream layout) instead of
    ``root/<table>.csv/part-*.csv`` (drop-folder layout).  ``unit``: the unit of all events.  ``only``: one table."""
    for table, df in B.text_tables(spark, sf_dir).items():
        if only not in (None, table):
            continue
        if unit and table == "production_events":
            df = df.withColumn("unit", F.lit(unit))
        if table == "production_events":  # the only one with copies
            df = df.where("_pos = 0").unionByName(df.where("_pos > 0"))
        write_csv(df.drop("_file", "_pos"), f"{root}/{table}" if per_table_dirs else f"{root}/{table}.csv", ROWS_PER_FILE)
    return root


def _roundtrip(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    root = export_text_batch(spark, sf_dir, scratch_path(spark, "csv"), only=table)
    back = read_csv(spark, f"{root}/{table}.csv", C.CSV_COLUMNS[table]).drop("_file", "_pos", "_extra").checkpoint()
    drop_scratch(spark, root)
    return back


@register("csv_roundtrip", with_ctes("checks_text") + "SELECT * FROM checks_text")
def q_csv_roundtrip(spark, sf_dir):
    """Checks exported as CSV and read back by header name: '' stays '', nothing lost."""
    return _roundtrip(spark, sf_dir, "quality_checks")


def _register_roundtrip(name: str, table: str, cte: str) -> None:
    @register(name, with_ctes(cte) + f"SELECT {', '.join(C.CSV_COLUMNS[table])} FROM {cte}")
    def query(spark, sf_dir):
        return _roundtrip(spark, sf_dir, table)
    query.__name__ = f"q_{name}"
    query.__doc__ = f"The {table} table exported as CSV and read back by header name."


_register_roundtrip("csv_roundtrip_machines", "machines", "machines_text")
_register_roundtrip("csv_roundtrip_events", "production_events", "dirty_production_events")
_register_roundtrip("csv_roundtrip_maintenance", "maintenance_events", "maintenance_text")


@register("drop_folder_rows", with_ctes("machines_text") + """
    SELECT 'machines' AS table_name, count(*) AS n_rows FROM machines_text
    UNION ALL SELECT t, 0::BIGINT FROM (VALUES ('production_events'), ('quality_checks'), ('maintenance_events')) v(t)""")
def q_drop_folder_rows(spark, sf_dir):
    """A drop folder with the machines, an events file of 0 bytes, a checks file with a header alone, and no maintenance file."""
    root = export_text_batch(spark, sf_dir, scratch_path(spark, "drop"), only="machines")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/production_events.csv")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path).close()
    write_csv(spark.createDataFrame([], ", ".join(f"{c} string" for c in C.CSV_COLUMNS["quality_checks"])), f"{root}/quality_checks.csv")
    out = None
    for table, df in read_dataset(spark, root).items():
        rows = df.agg(F.count("*").alias("n_rows")).select(F.lit(table).alias("table_name"), "n_rows")
        out = rows if out is None else out.unionByName(rows)
    out = out.checkpoint()
    drop_scratch(spark, root)
    return out


def _refreshed(spark: SparkSession, sf_dir: str, result) -> DataFrame:
    """A result of the store after two batches of the raw tables and a refresh after each.

    The second batch has the later events and, besides their checks, every third check of the first batch's events: they come
    late, and change the newest check of days that are stored."""
    store = TableStore(spark, scratch_path(spark, "refresh"))
    raw = {t: df.select(*C.RAW_SCHEMAS[t].fieldNames()) for t, df in B.raw_tables(spark, sf_dir).items()}
    early = raw["production_events"].where(F.col("event_timestamp") < F.lit("2024-01-15").cast("timestamp_ntz"))
    late = F.pmod(F.xxhash64("check_id"), F.lit(3)) == 0
    known = early.select(F.col("event_id").alias("production_event_id")).hint("shuffle_hash")
    checks, columns = raw["quality_checks"], C.RAW_SCHEMAS["quality_checks"].fieldNames()
    first = checks.where(~late).join(known, "production_event_id", "left_semi").select(*columns)
    # a check's id names its event, so the other batch has the other rows
    of_first = checks.where(late).unionByName(checks.where(~late).join(known, "production_event_id", "left_anti").select(*columns))
    odd = F.pmod(F.xxhash64("maintenance_id"), F.lit(2)) == 1
    for batch in ({"machines": raw["machines"], "production_events": early, "quality_checks": first, "maintenance_events": raw["maintenance_events"].where(odd)},
                  {"production_events": raw["production_events"].join(early.select("event_id"), "event_id", "left_anti").select(*early.columns), "quality_checks": of_first,
                   "maintenance_events": raw["maintenance_events"].where(~odd)}):
        for table, df in batch.items():
            store.append(df, table)
        refresh_models(store)
    out = result(store).checkpoint()
    drop_scratch(spark, store.root)
    return out


@register("refresh_production_daily", with_ctes("mart_production_daily") + "SELECT * FROM mart_production_daily")
def q_refresh_production_daily(spark, sf_dir):
    """The daily mart as two refreshes leave it: equal to a full rebuild."""
    return _refreshed(spark, sf_dir, lambda store: store.read("mart_production_daily"))


@register("refresh_quality_summary", with_ctes("mart_quality_summary") + "SELECT * FROM mart_quality_summary")
def q_refresh_quality_summary(spark, sf_dir):
    """Quality by product as the sum of the stored daily counts."""
    return _refreshed(spark, sf_dir, lambda store: store.read("mart_quality_summary"))


@register("refresh_machine_downtime", with_ctes("mart_machine_downtime") + """
    SELECT machine_id, machine_name, machine_type, maintenance_event_count, round(total_downtime_hours, 6) AS total_downtime_hours, last_maintenance_end
    FROM mart_machine_downtime""")
def q_refresh_machine_downtime(spark, sf_dir):
    """Downtime with the machines of the second batch made anew."""
    return rounded(_refreshed(spark, sf_dir, lambda store: store.read("mart_machine_downtime")), ["total_downtime_hours"])


@register("moments_loo_zscore", with_ctes("loo_frame") + f"SELECT * FROM ({z_sql('loo_frame')}) WHERE production_date >= DATE '2024-01-10' AND production_date < DATE '2024-02-10'")
def q_moments_loo_zscore(spark, sf_dir):
    """Baseline scores of a month's days from those days of the mart and each machine's stored moments over all days."""
    days = [str(_dt.date(2024, 1, 10) + _dt.timedelta(days=i)) for i in range(31)]
    return _refreshed(spark, sf_dir, lambda store: rounded(baseline_of_days(store, days).select(*BASELINE_COLS), BASELINE_DOUBLES))


@register("merge_latest_check", with_ctes("newest_check") + """
    SELECT production_event_id, check_id, check_timestamp, result, defect_type, n_checks FROM newest_check""")
def q_merge_latest_check(spark, sf_dir):
    """The newest check per event of three parts of the checks, reduced by themselves and merged one after the other."""
    checks, how = B.raw_tables(spark, sf_dir)["quality_checks"], dict(key="production_event_id", order_by=["check_timestamp", "check_id"], carry=["result", "defect_type"], count_alias="n_checks")
    part = F.pmod(F.xxhash64("check_id"), F.lit(3))
    with shuffled_by_size(spark, checks):  # each step is stored, so that a task sorts for one step at a time
        state = latest_per_key(checks.where(part == 0), **how).checkpoint()
        for i in (1, 2):
            batch = latest_per_key(checks.where(part == i), **how).checkpoint()
            state = merge_latest(state, batch, **how).checkpoint()
    return state


@register("stream_ingest", with_ctes("batch_stats") + "SELECT * FROM batch_stats")
def q_stream_ingest(spark, sf_dir):
    """Files dropped per table, picked up by file streams (availableNow), ingested in
    foreachBatch into a fresh store; counters equal a batch ingest of the same rows."""
    root = scratch_path(spark, "stream")
    export_text_batch(spark, sf_dir, f"{root}/drop", per_table_dirs=True)
    store = TableStore(spark, f"{root}/store")
    stats = stream_ingest(spark, store, f"{root}/drop", f"{root}/checkpoints", FIXED_SOURCE)
    drop_scratch(spark, root)
    return stats


_TOTALS = "CAST(sum(inserted) AS BIGINT) AS inserted, CAST(sum(skipped_duplicate) AS BIGINT) AS skipped_duplicate, CAST(sum(quarantined) AS BIGINT) AS quarantined"
define_cte("event_winners", """
    SELECT event_id, machine_id, CAST(parsed_ts AS DATE) AS day, CAST(parsed_quantity AS BIGINT) AS quantity, unit FROM events_classified
    WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ord) = 1""", ["events_classified"])
define_cte("winner_days", """
    SELECT machine_id, day, CAST(sum(quantity) AS HUGEINT) AS x FROM event_winners GROUP BY 1, 2""", ["event_winners"])
define_cte("winner_peers", """
    SELECT x, count(*) OVER w AS k, coalesce(sum(x) OVER w, 0) AS p, coalesce(sum(x * x) OVER w, 0) AS q FROM winner_days
    WINDOW w AS (PARTITION BY machine_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW)""", ["winner_days"])


define_cte("winner_checks", """
    SELECT production_event_id, check_id, result FROM checks_classified WHERE reason IS NULL
    QUALIFY row_number() OVER (PARTITION BY production_event_id ORDER BY parsed_ts DESC, check_id DESC) = 1""", ["checks_classified"])
define_cte("winner_features", """
    SELECT machine_id || '_' || CAST(day AS VARCHAR) AS machine_day_key, CAST(sum(quantity) AS BIGINT) AS total_quantity,
           CASE WHEN count(check_id) = 0 THEN 0.0 ELSE CAST(count(*) FILTER (result = 'fail') AS DOUBLE) / count(check_id) END AS defect_rate_feature,
           0 AS unit_inconsistency_count
    FROM event_winners e LEFT JOIN winner_checks c ON c.production_event_id = e.event_id GROUP BY machine_id, day""", ["event_winners", "winner_checks"])
define_cte("winner_forest", forest_sql("winner_features", "machine_day_key", FEATURES), ["winner_features"])


@register("daily_run", with_ctes("batch_stats", "event_winners") + f"""
    SELECT '2024-01-31' AS run_date, 'blocked_by_data_tests' AS status, {_TOTALS},
           (SELECT CAST(count(*) > 0 AS BIGINT) FROM event_winners WHERE unit NOT IN ('units', 'kg')) AS failed_error_tests,
           false AS gate_passed, CAST(0 AS BIGINT) AS machine_days_scored, CAST(0 AS BIGINT) AS baseline_anomalies,
           CAST(0 AS BIGINT) AS isolation_forest_anomalies, false AS isolation_forest_ran
    FROM batch_stats""")
def q_daily_run(spark, sf_dir) -> DataFrame:
    """Detect, ingest, build and write the marts, run the 48 data tests, gate, score.
    The batch carries a unit outside the accepted list, so the gate blocks scoring."""
    root = scratch_path(spark, "daily")
    export_text_batch(spark, sf_dir, f"{root}/drop")
    out = run_daily(spark, f"{root}/drop", f"{root}/store", "2024-01-31", raise_on_failed_tests=False)
    drop_scratch(spark, root)  # the summary is a row of its own
    return out


@register("daily_run_scored", with_ctes("batch_stats", "winner_peers", "winner_forest") + f"""
    SELECT '2024-01-31' AS run_date, 'scored' AS status, {_TOTALS}, CAST(0 AS BIGINT) AS failed_error_tests, true AS gate_passed,
           (SELECT count(*) FROM winner_days) AS machine_days_scored,
           (SELECT count(*) FROM winner_peers WHERE k >= 2 AND k * q - p * p > 0
               AND abs((x - CAST(p AS DOUBLE) / k) / (sqrt(CAST(k * q - p * p AS DOUBLE)) / k)) > 2.5) AS baseline_anomalies,
           (SELECT count(*) FROM winner_forest WHERE is_isolation_forest_anomaly) AS isolation_forest_anomalies,
           (SELECT count(*) >= 20 FROM winner_days) AS isolation_forest_ran
    FROM batch_stats""")
def q_daily_run_scored(spark, sf_dir) -> DataFrame:
    """The same batch with accepted units only: it passes the gate and is scored, by the baseline and by the forest."""
    root = scratch_path(spark, "daily")
    export_text_batch(spark, sf_dir, f"{root}/drop", unit="units")
    out = run_daily(spark, f"{root}/drop", f"{root}/store", "2024-01-31")
    drop_scratch(spark, root)
    return out
