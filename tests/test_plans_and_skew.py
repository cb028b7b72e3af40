"""Physical-plan checks and hot-key (skew) correctness.

Plans: no cartesian or nested-loop joins, no row-at-a-time Python, pruned scans, and
map-side reduction (partial aggregate / partial window limit) before every shuffle of
a per-key operator.  Skew: one key holding a third of all rows, with AQE forced to
split skewed partitions and broadcasts disabled; results must equal brute force.
"""

import contextlib
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from forgeline import registry
from forgeline.operators.dedup import first_per_key, insert_if_absent
from forgeline.operators.quality import dq_relationships_count
from forgeline.operators.topk import count_per_key, latest_per_key
from forgeline.operators.validate import mark_known, named_keys
from forgeline.operators.zscore import loo_frame, loo_zscore

# queries whose construction writes tables or runs jobs (checked elsewhere)
SIDE_EFFECTS = {"ingest_dataset", "ingest_rerun", "stream_ingest", "daily_run", "daily_run_scored", "csv_roundtrip",
                "isolation_forest", "anomaly_scores", "score_summary", "upsert_scores", "forest_min_rows", "score_missing_mart", "scoring_time",
                "refresh_production_daily", "refresh_quality_summary", "refresh_machine_downtime", "drop_folder_rows", "moments_loo_zscore"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: _plan(fn(spark, SF_SMALL)) for k, fn in registry.QUERIES.items() if k not in SIDE_EFFECTS}


def test_no_cartesian_nested_loop_or_row_udf(plans):
    for name, p in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in p, f"{name} plans {bad}"


def test_latest_check_combines_map_side(plans):
    p = plans["latest_check"]
    assert "partial_max" in p and "partial_count" in p
    assert p.count("Exchange hashpartitioning") == 1
    assert "Window" not in p


def test_first_wins_dedup_limits_map_side(plans):
    for name in ("dedup_first_wins", "quarantine_dedup", "topk_per_group"):
        assert plans[name].count("WindowGroupLimit") >= 2, name  # partial + final


def test_loo_zscore_is_aggregate_not_window_or_self_join(plans):
    p = plans["loo_zscore"]
    assert "Window" not in p and "partial_sum" in p


def test_scans_read_only_needed_columns(plans):
    p = plans["latest_check"]
    schema = p[p.index("ReadSchema"):].split("\n")[0]
    for unused in ("l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_linestatus"):
        assert unused not in schema, schema


def test_pushed_filter_reaches_scan(spark):
    from forgeline.sources.bindings import read_table

    df = read_table(spark, SF_SMALL, "events").filter(F.col("user_id") == 7).select("event_id")
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in _plan(df)


# ---------------------------------------------------------------------------
# skew: a third of the rows on one key
# ---------------------------------------------------------------------------
@contextlib.contextmanager
def forced_skew_handling(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed_days(spark, n=3000):
    """Machine-days where machine HOT holds every third row."""
    return (spark.range(n).repartition(8)
            .withColumn("machine_id", F.when(F.col("id") % 3 == 0, F.lit("HOT"))
                        .otherwise(F.concat(F.lit("M"), (F.col("id") % 97).cast("string"))))
            .withColumn("total_quantity", (F.abs(F.xxhash64("id")) % 1000 + 1).cast("bigint"))
            .withColumn("machine_day_key", F.col("id").cast("string")))


def _loo_brute(pdf: pd.DataFrame) -> dict:
    out = {}
    for _, g in pdf.groupby("machine_id"):
        x = g["total_quantity"].to_numpy(dtype=float)
        for i, key in enumerate(g["machine_day_key"]):
            others = np.delete(x, i)
            if len(others) < 2:
                out[key] = (None, None)
                continue
            out[key] = (others.mean(), others.std())
    return out


def test_loo_zscore_with_hot_machine(spark):
    df = _skewed_days(spark)
    with forced_skew_handling(spark):
        got = {r["machine_day_key"]: r for r in loo_zscore(df, "machine_id", "total_quantity").collect()}
    want = _loo_brute(df.toPandas())
    assert len(got) == len(want) == 3000
    for key, (mean, sd) in want.items():
        r = got[key]
        if mean is None:
            assert r["baseline_mean"] is None
        else:
            assert r["baseline_mean"] == pytest.approx(mean, rel=1e-12)
            assert r["baseline_stddev"] == pytest.approx(sd, rel=1e-9)


def _skewed_checks(spark, n=6000):
    t0 = dt.datetime(2026, 1, 1)
    return (spark.range(n).repartition(8)
            .withColumn("production_event_id", F.when(F.col("id") % 3 == 0, F.lit("E-HOT"))
                        .otherwise(F.concat(F.lit("E"), (F.col("id") % 701).cast("string"))))
            .withColumn("check_timestamp", F.timestamp_add(
                "MINUTE", F.abs(F.xxhash64("id")) % 5000, F.lit(t0).cast("timestamp_ntz")))
            .withColumn("check_id", F.concat(F.lit("C"), F.col("id").cast("string")))
            .withColumn("result", F.when(F.col("id") % 7 == 0, "fail").otherwise("pass")))


def test_latest_check_with_hot_event(spark):
    df = _skewed_checks(spark)
    with forced_skew_handling(spark):
        got = {r["production_event_id"]: (r["check_id"], r["result"], r["n"])
               for r in latest_per_key(df, "production_event_id", ["check_timestamp", "check_id"],
                                       ["result"], "n").collect()}
    pdf = df.toPandas().sort_values(["check_timestamp", "check_id"], ascending=False)
    want = {}
    for ev, g in pdf.groupby("production_event_id", sort=False):
        top = g.iloc[0]
        want[ev] = (top["check_id"], top["result"], len(g))
    assert got == want and want["E-HOT"][2] == 2000


def test_count_per_key_and_first_per_key_with_hot_key(spark):
    df = _skewed_checks(spark).select("check_id", "production_event_id", "id")
    with forced_skew_handling(spark):
        counted = {r["check_id"]: r["c"] for r in count_per_key(df, "production_event_id", "c").collect()}
        first = {r["production_event_id"]: r["id"]
                 for r in first_per_key(df, ["production_event_id"], ["id"]).collect()}
    pdf = df.toPandas()
    sizes = pdf.groupby("production_event_id")["id"].transform("size")
    assert counted == dict(zip(pdf["check_id"], sizes))
    assert first == pdf.groupby("production_event_id")["id"].min().to_dict()


def test_relationship_count_with_hot_orphan_value(spark):
    child = _skewed_checks(spark).select("production_event_id")
    parent = spark.range(0, 701, 2).select(F.concat(F.lit("E"), F.col("id").cast("string")).alias("event_id"))
    with forced_skew_handling(spark):
        got = dq_relationships_count(child, "production_event_id", parent, "event_id").first()["violations"]
    pdf = child.toPandas()
    known = {f"E{i}" for i in range(0, 701, 2)}
    assert got == int((~pdf["production_event_id"].isin(known)).sum())


def test_fk_join_splits_hot_machine_partition(spark):
    """With broadcasts off, AQE splits the partition of a machine holding a third of
    the events (the final plan shows a skew sort-merge join)."""
    ev = (spark.range(300000).repartition(8)
          .withColumn("machine_id", F.when(F.col("id") % 3 == 0, F.lit("HOT"))
                      .otherwise(F.concat(F.lit("M"), (F.col("id") % 5000).cast("string")))))
    parents = spark.range(5000).select(F.concat(F.lit("M"), F.col("id").cast("string")).alias("machine_id"))
    with forced_skew_handling(spark):
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        out = mark_known(ev, "machine_id", parents, "machine_id", "ok")
        rows = out.collect()
        plan = _plan(out)
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == 300000
    assert sum(not r["ok"] for r in rows) == 100000  # the hot machine is not a known parent


def _hot(spark, n=300000):
    return (spark.range(n).repartition(8)
            .withColumn("k", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("M"), (F.col("id") % 5000).cast("string")))))


@contextlib.contextmanager
def small_skew_thresholds(spark):
    with forced_skew_handling(spark):
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        yield


def test_count_per_key_splits_the_hot_key(spark):
    with small_skew_thresholds(spark):
        out = count_per_key(_hot(spark), "k", "n")
        hot = [r["n"] for r in out.collect() if r["k"] == "HOT"]
        plan = _plan(out)
    assert hot == [100000] * 100000 and "SortMergeJoin(skew=true)" in plan


def test_machine_maintenance_join_splits_the_hot_machine(spark):
    """The shape of join_machine_maintenance: an inner join plus the machines without a match."""
    done, machines = _hot(spark), spark.range(4000).select(F.concat(F.lit("M"), F.col("id").cast("string")).alias("k")).union(
        spark.createDataFrame([("HOT",), ("NONE",)], "k string"))
    with small_skew_thresholds(spark):
        inner = machines.join(done, "k")
        out = inner.unionByName(machines.join(done.select("k"), "k", "left_anti"), allowMissingColumns=True)
        rows = out.groupBy((F.col("k") == "HOT").alias("hot"), F.col("id").isNull().alias("none")).count().collect()
        inner.collect()
        plan = _plan(inner)
    assert "SortMergeJoin(skew=true)" in plan
    assert {(r["hot"], r["none"]): r["count"] for r in rows}[(True, False)] == 100000


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, 3), (None, 4), (None, 8), ("b", 2)], "k string, x int")
    assert sorted(r["n"] for r in count_per_key(df, "k", "n").collect()) == [1, 2, 2, 3, 3, 3]
    got = sorted((r["x"], r["peer_count"], int(r["peer_sum"])) for r in loo_frame(df, "k", "x").collect())
    assert got == [(1, 1, 5), (2, 0, 0), (3, 2, 12), (4, 2, 11), (5, 1, 1), (8, 2, 7)]
    assert loo_zscore(df, "k", "x").count() == 6


def test_a_small_batch_does_not_shuffle_history(spark, tmp_path):
    """Only the batch fits the broadcast threshold: the stored keys are scanned, never exchanged."""
    spark.range(400000).selectExpr("concat('K', id) AS key").write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    spark.range(399900, 400100).selectExpr("concat('K', id) AS key", "id").write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        new = insert_if_absent(batch, stored, ["key"])
        assert new.count() == 100
        assert sum(r["ok"] for r in mark_known(batch, "key", stored, "key", "ok").collect()) == 100
        plan = _plan(new)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.splitlines()
    cut = next(i for i, x in enumerate(lines) if "LeftSemi" in x)  # the join that cuts the stored keys down
    scan = next(i for i in range(cut + 1, len(lines)) if "FileScan parquet" in lines[i])  # its streamed side: the stored keys
    assert "BroadcastHashJoin" in lines[cut] and "BuildRight" in lines[cut]
    assert "ReadSchema: struct<key:string>" in lines[scan] and not any("Exchange" in x for x in lines[cut:scan])


def test_a_batch_names_few_parents(spark, tmp_path):
    """The keys that an ingest marks against are those that its batch names, and a mark alone runs no job."""
    spark.range(100000).selectExpr("concat('K', id) AS key").write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    batch = spark.createDataFrame([(f"K{99990 + i % 20}", i) for i in range(500)] + [(None, 1)], "fk string, id long")
    assert sorted(r["key"] for r in named_keys(batch, "fk", stored, "key").collect()) == [f"K{99990 + i}" for i in range(10)]
    marked = mark_known(batch, "fk", named_keys(batch, "fk", stored, "key"), "key", "ok")
    assert marked.where("ok").count() == 250 and marked.count() == 501
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("marks", "marks")
    mark_known(batch, "fk", stored, "key", "ok")
    assert not tracker.getJobIdsForGroup("marks")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
