"""Change propagation: the stored models follow the batches that the raw tables got since the last refresh.

The enriched events are kept by production day, each with the newest check it has had so far and the number of its checks.  That is
a state that merges: a batch's checks are reduced by themselves and meet the stored row of their event (``merge_latest``),
so old checks are never read again.  From a batch come the days it touches (those of its events, and of the stored events that
its checks name), and only these days of the enriched events, the daily mart and the daily quality counts are read and
replaced.  Quality by product is the sum of its daily counts; downtime is made anew for the machines that the batch names; the
moments of each machine's daily quantities, which the baseline scores need, lose the replaced days and gain the new ones.

All that a refresh wrote, and the raw batches it has seen, are committed at once.  A refresh that dies before leaves
the earlier models current, and the next one starts from the same batches again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline import contracts as C
from forgeline.operators.topk import merge_latest
from forgeline.plans import intermediate as I
from forgeline.plans import marts as M
from forgeline.plans import staging as S
from forgeline.operators.zscore import group_moments, merge_moments
from forgeline.plans.models import MARTS, build_models
from forgeline.plans.scoring import MOMENTS
from forgeline.sources.store import TableStore

SEEN = "models_seen"  # the raw batches that the models hold
ENRICHED = "int_production_enriched"
DAY = "production_date"
ENRICHED_SCHEMA = T.StructType([  # the model's columns and, last, what merges
    *(T.StructField(c, T.StringType()) for c in ("event_id", "machine_id", "machine_type")), T.StructField(DAY, T.DateType()), T.StructField("product_code", T.StringType()),
    T.StructField("quantity_produced", T.IntegerType()), T.StructField("unit", T.StringType()), T.StructField("has_unit_inconsistency", T.BooleanType()),
    *(T.StructField(c, T.StringType()) for c in ("shift", "check_id", "quality_result", "defect_type")),
    T.StructField("has_duplicate_quality_checks", T.BooleanType()), T.StructField("check_timestamp", T.TimestampNTZType()), T.StructField("n_checks", T.LongType())])
_EVENT = ["event_id", "machine_id", "machine_type", DAY, "product_code", "quantity_produced", "unit", "has_unit_inconsistency", "shift"]
_ORDER, _CARRY, _COUNT = ["check_timestamp", "check_id"], ["result", "defect_type"], "n_checks"


def fresh_batches(store: TableStore) -> dict[str, list[str]]:
    """The raw batches of each table that no refresh has seen."""
    seen = set(store.state(SEEN))
    return {t: [f for f in store.state(t) if f not in seen] for t in C.INGEST_ORDER}


def touched_days(events: DataFrame, checks: DataFrame, stored: DataFrame) -> list[str]:
    """The days of a batch's events, and of the stored events that its checks name (a scan of keys and days only)."""
    named = stored.select("event_id", DAY).join(checks.select(F.col("production_event_id").alias("event_id")), "event_id", "left_semi")
    days = events.select(DAY).unionByName(named.select(DAY)).distinct()
    return sorted(str(r[0]) for r in days.collect())  # a row for a day


def merged_events(stored: DataFrame, events: DataFrame, checks: DataFrame) -> DataFrame:
    """Stored enriched events and new ones, each with its newest check of either time and the number of its checks.

    checks: the batch's newest check per event, as latest_quality_check makes it."""
    key = "production_event_id"
    had = stored.where(f"{_COUNT} > 0").select(F.col("event_id").alias(key), *_ORDER, F.col("quality_result").alias("result"), "defect_type", _COUNT)
    newest = (merge_latest(had, checks, key, _ORDER, _CARRY, _COUNT)
              .select(F.col(key).alias("event_id"), "check_id", F.col("result").alias("quality_result"), "defect_type", "check_timestamp", _COUNT))
    return (stored.select(*_EVENT).unionByName(events.select(*_EVENT)).join(newest, "event_id", "left")
            .select(*_EVENT, "check_id", "quality_result", "defect_type", (F.coalesce(_COUNT, F.lit(0)) > 1).alias("has_duplicate_quality_checks"),
                    "check_timestamp", F.coalesce(_COUNT, F.lit(0)).alias(_COUNT)))


def refresh_models(store: TableStore) -> list[str]:
    """Bring the stored models up to the raw tables; returns the days that were replaced."""
    fresh = fresh_batches(store)
    if not any(fresh.values()):
        return []
    new = {t: store.read_folders(fresh[t], C.RAW_SCHEMAS[t]) for t in C.INGEST_ORDER}
    machines = S.stg_machines(store.read("machines", C.RAW_SCHEMAS["machines"]))
    events = S.stg_production_events(new["production_events"]).join(machines.select("machine_id", "machine_type"), "machine_id", "left")
    commits = [(SEEN, f, f) for t in C.INGEST_ORDER for f in fresh[t]]
    days = []
    if fresh["production_events"] or fresh["quality_checks"]:
        # written once: the batch's newest checks serve the days and the merge
        staged = store.write_data(I.latest_quality_check(S.stg_quality_checks(new["quality_checks"])), "_staging")
        checks = store.read_folders([staged])
        days = touched_days(events, checks, store.read(ENRICHED, ENRICHED_SCHEMA))
        made = store.write_parts(merged_events(store.read(ENRICHED, ENRICHED_SCHEMA, days), events, checks), ENRICHED, DAY)
        touched = store.read_folders([folder for _, _, folder in made])
        counts = store.write_parts(M.quality_counts(touched, DAY, "product_code"), "quality_by_day", DAY)
        daily = store.write_parts(M.mart_production_daily(I.daily_summary_from_enriched(touched)), "mart_production_daily", DAY)
        commits += made + counts + daily + [(MOMENTS, "", store.write_data(_moments(store, store.read_folders([folder for _, _, folder in daily]), days), MOMENTS))]
        every = store.parts("quality_by_day") | {part: folder for _, part, folder in counts}
        total = store.read_folders(list(every.values())).groupBy("product_code").agg(*(F.sum(c).alias(c) for c in M.QUALITY_COUNTS))
        commits.append(("mart_quality_summary", "", store.write_data(M.quality_rates(total), "mart_quality_summary")))
    if fresh["machines"] or fresh["maintenance_events"]:
        commits.append(("mart_machine_downtime", "", store.write_data(_downtime(store, machines, new), "mart_machine_downtime")))
    store.commit(commits)
    store.drop("_staging")
    return days


def _moments(store: TableStore, daily: DataFrame, days: list[str]) -> DataFrame:
    """The stored moments, without the days that are replaced, and with those that replace them."""
    made = group_moments(daily, "machine_id", "total_quantity")
    if not store.exists(MOMENTS):
        return made
    before = store.read("mart_production_daily", daily.schema, days)
    return merge_moments(store.read(MOMENTS), group_moments(before, "machine_id", "total_quantity", -1), made)


def _downtime(store: TableStore, machines: DataFrame, new: dict[str, DataFrame]) -> DataFrame:
    """The downtime mart: made anew for the machines that the batch names, kept for the others."""
    named = new["machines"].select("machine_id").unionByName(new["maintenance_events"].select("machine_id")).distinct()
    maintenance = S.stg_maintenance_events(store.read("maintenance_events", C.RAW_SCHEMAS["maintenance_events"]))
    # all maintenance is summed per machine before it meets the named ones: a row for a machine is shuffled, not one for an event
    made = M.mart_machine_downtime(machines.join(named, "machine_id", "left_semi"), maintenance)
    if not store.exists("mart_machine_downtime"):
        return made
    return store.read("mart_machine_downtime").join(named, "machine_id", "left_anti").unionByName(made)


def raw_from_store(store: TableStore) -> dict[str, DataFrame]:
    return {t: store.read(t, C.RAW_SCHEMAS[t]) for t in C.INGEST_ORDER}


def stored_models(store: TableStore) -> dict[str, DataFrame]:
    """The model graph over the stored raw tables, with the enriched events and the marts as last refreshed
    (as long as no batch had events, or machines, theirs are made from the raw tables)."""
    models = build_models(raw_from_store(store)) | {m: store.read(m) for m in MARTS if store.exists(m)}
    if store.exists(ENRICHED):
        models[ENRICHED] = store.read(ENRICHED).drop("check_timestamp", _COUNT)
        models["int_daily_machine_summary"] = I.daily_summary_from_enriched(models[ENRICHED])
    return models
