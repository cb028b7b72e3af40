import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from forgeline.operators.iforest import average_path_length, isolation_forest
from forgeline.plans.scoring import FEATURES, anomaly_scores, baseline_scores, score_summary

SCHEMA = ("machine_day_key string, machine_id string, production_date date, total_quantity bigint, "
          "checked_count long, fail_count long, unit_inconsistency_count long, defect_rate_feature double")


def _days(machine, quantities, start=dt.date(2026, 1, 1)):
    return [(f"{machine}_{start + dt.timedelta(days=i)}", machine, start + dt.timedelta(days=i), q, 10, 1, 0, 0.1)
            for i, q in enumerate(quantities)]


def _baseline(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["machine_day_key"]: r for r in baseline_scores(df).collect()}


def test_clear_outlier_is_flagged(spark):
    out = _baseline(spark, _days("M1", [500, 510, 490, 505, 2000]))
    last = out["M1_2026-01-05"]
    assert last["is_baseline_anomaly"] and last["baseline_z_score"] > 2.5
    assert sum(r["is_baseline_anomaly"] for r in out.values()) == 1


def test_normal_variation_not_flagged(spark):
    out = _baseline(spark, _days("M1", [500, 510, 495, 505]))
    assert not any(r["is_baseline_anomaly"] for r in out.values())


def test_single_day_has_no_baseline(spark):
    r = _baseline(spark, _days("M1", [500]))["M1_2026-01-01"]
    assert (r["baseline_mean"], r["baseline_stddev"], r["baseline_z_score"], r["is_baseline_anomaly"]) == \
        (None, None, None, False)


def test_two_days_too_few_three_days_enough(spark):
    two = _baseline(spark, _days("M1", [500, 600]))
    assert all(r["baseline_mean"] is None for r in two.values())
    three = _baseline(spark, _days("M2", [500, 600, 700]))
    assert three["M2_2026-01-01"]["baseline_mean"] == 650.0
    assert three["M2_2026-01-01"]["baseline_stddev"] == 50.0
    assert three["M2_2026-01-01"]["baseline_z_score"] == -3.0


def test_machines_are_independent(spark):
    out = _baseline(spark, _days("M1", [500, 510, 495]) + _days("M2", [5000, 5100, 4950]))
    assert out["M1_2026-01-01"]["baseline_mean"] == 502.5
    assert out["M2_2026-01-01"]["baseline_mean"] == 5025.0


def test_zero_spread_keeps_mean_and_no_z(spark):
    r = _baseline(spark, _days("M1", [500, 500, 500, 900]))["M1_2026-01-04"]
    assert (r["baseline_mean"], r["baseline_stddev"], r["baseline_z_score"], r["is_baseline_anomaly"]) == \
        (500.0, 0.0, None, False)


def test_threshold_is_strict(spark):
    # peers 0,0,10,10 -> mean 5, sd 5; x = 17.5 is not an integer, so use scaled values:
    # peers 0,0,20,20 -> mean 10, sd 10; x = 35 -> z = 2.5 exactly -> not flagged
    r = _baseline(spark, _days("M1", [0, 0, 20, 20, 35]))["M1_2026-01-05"]
    assert r["baseline_z_score"] == 2.5 and r["is_baseline_anomaly"] is False


def test_matches_python_statistics(spark):
    import random

    rng = random.Random(7)
    qs = [rng.randint(1, 10**6) for _ in range(40)]
    out = _baseline(spark, _days("M1", qs))
    for i, q in enumerate(qs):
        others = qs[:i] + qs[i + 1:]
        r = out[f"M1_{dt.date(2026, 1, 1) + dt.timedelta(days=i)}"]
        assert math.isclose(r["baseline_mean"], statistics.fmean(others), rel_tol=1e-15)
        assert math.isclose(r["baseline_stddev"], statistics.pstdev(others), rel_tol=1e-14)


def _forest_rows(n, outlier=None):
    rows = _days("M1", [500 + (i % 5) for i in range(n)])
    if outlier is not None:
        rows[outlier] = rows[outlier][:3] + (50000, 10, 9, 3, 0.9)
    return rows


def test_forest_skipped_under_minimum_rows(spark):
    df = spark.createDataFrame(_forest_rows(19), SCHEMA)
    out = isolation_forest(df, "machine_day_key", FEATURES).collect()
    assert all(r["isolation_forest_score"] is None and r["is_isolation_forest_anomaly"] is False for r in out)


def test_forest_scores_everything_at_minimum(spark):
    df = spark.createDataFrame(_forest_rows(24), SCHEMA)
    out = isolation_forest(df, "machine_day_key", FEATURES).collect()
    assert all(r["isolation_forest_score"] is not None for r in out)
    assert all(-0.5 < r["isolation_forest_score"] < 0.5 for r in out)


def test_forest_ranks_planted_outlier_first(spark):
    rows = _forest_rows(300, outlier=123)
    df = spark.createDataFrame(rows, SCHEMA)
    out = isolation_forest(df, "machine_day_key", FEATURES).orderBy("isolation_forest_score").first()
    assert out["machine_day_key"] == rows[123][0] and out["is_isolation_forest_anomaly"]


def test_forest_deterministic_and_partitioning_invariant(spark):
    import random

    rng = random.Random(3)
    rows = [(f"K{i}", "M1", dt.date(2026, 1, 1), rng.randint(1, 1000), 10, rng.randint(0, 10), rng.randint(0, 3),
             rng.random()) for i in range(700)]
    a = spark.createDataFrame(rows, SCHEMA).repartition(7)
    b = spark.createDataFrame(list(reversed(rows)), SCHEMA).coalesce(1)
    sa = {r[0]: r[1] for r in isolation_forest(a, "machine_day_key", FEATURES).select(
        "machine_day_key", "isolation_forest_score").collect()}
    sb = {r[0]: r[1] for r in isolation_forest(b, "machine_day_key", FEATURES).select(
        "machine_day_key", "isolation_forest_score").collect()}
    assert sa == sb


def test_average_path_length():
    assert list(average_path_length([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert math.isclose(average_path_length([256])[0], 2 * (math.log(255) + 0.5772156649015329) - 2 * 255 / 256)


def test_anomaly_table_and_summary(spark):
    df = spark.createDataFrame(_forest_rows(30, outlier=5), SCHEMA)
    scores = anomaly_scores(df, dt.datetime(2026, 1, 3))
    cols = ["machine_day_key", "machine_id", "production_date", "total_quantity", "baseline_mean",
            "baseline_stddev", "baseline_z_score", "is_baseline_anomaly", "isolation_forest_score",
            "is_isolation_forest_anomaly", "scored_at"]
    assert scores.columns == cols
    s = score_summary(scores).first()
    assert s["machine_days_scored"] == 30 and s["isolation_forest_ran"] is True
    assert s["baseline_anomalies"] >= 1 and s["isolation_forest_anomalies"] >= 1


def _brute_force_forest_scores(spark, df, key, features, trees, psi, seed):
    """Single-process reference: every row's draw for every tree, the psi smallest per
    tree, trees grown in-process, and a recursive walk per row."""
    import numpy as np

    from forgeline.operators.iforest import _draw, grow_tree

    draws = (df.select(key, *features, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
             .withColumn("u", _draw(seed, F.col("tree"), F.col(key))).toPandas())
    pdf = df.select(key, *features).toPandas()
    X_all = pdf[features].to_numpy(dtype=float)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    depth_sum = np.zeros(len(pdf))
    for t in range(trees):
        sample = draws[draws["tree"] == t].sort_values(["u", key]).head(psi)
        feat, thr, left, right, size = grow_tree(sample[features].to_numpy(dtype=float), seed, t, max_depth)

        def walk(x, node=0, depth=0):
            if feat[node] < 0:
                return depth + float(average_path_length([size[node]])[0])
            nxt = left[node] if x[feat[node]] <= thr[node] else right[node]
            return walk(x, nxt, depth + 1)

        depth_sum += np.array([walk(x) for x in X_all])
    c = float(average_path_length([psi])[0])
    scores = 0.5 - np.power(2.0, -(depth_sum / trees) / c)
    return dict(zip(pdf[key], scores))


def test_forest_equals_single_process_computation(spark):
    import random

    rng = random.Random(11)
    rows = [(f"K{i}", "M1", dt.date(2026, 1, 1), rng.randint(1, 1000), 10, rng.randint(0, 10), rng.randint(0, 3),
             rng.random()) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = {r[0]: r[1] for r in isolation_forest(df, "machine_day_key", FEATURES, trees=12, max_samples=64,
                                                seed=5).select("machine_day_key", "isolation_forest_score").collect()}
    want = _brute_force_forest_scores(spark, df, "machine_day_key", FEATURES, 12, 64, 5)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


# The sample's 15 machine-days (three days per machine) with the expected
# leave-one-out mean, population sd, z-score (6 decimals) and flag.
SAMPLE_GOLDEN = [
    ("M001", 1, 6263, 4531.5, 118.5, 14.611814, True),
    ("M001", 2, 4650, 5338.0, 925.0, -0.743784, False),
    ("M001", 3, 4413, 5456.5, 806.5, -1.293862, False),
    ("M002", 1, 5461, 5744.0, 229.0, -1.235808, False),
    ("M002", 2, 5973, 5488.0, 27.0, 17.962963, True),
    ("M002", 3, 5515, 5717.0, 256.0, -0.789062, False),
    ("M003", 1, 4841, 4379.5, 43.5, 10.609195, True),
    ("M003", 2, 4423, 4588.5, 252.5, -0.655446, False),
    ("M003", 3, 4336, 4632.0, 209.0, -1.416268, False),
    ("M004", 1, 4929, 5197.5, 27.5, -9.763636, True),
    ("M004", 2, 5170, 5077.0, 148.0, 0.628378, False),
    ("M004", 3, 5225, 5049.5, 120.5, 1.456432, False),
    ("M005", 1, 6523, 5125.0, 200.0, 6.990000, True),
    ("M005", 2, 4925, 5924.0, 599.0, -1.667780, False),
    ("M005", 3, 5325, 5724.0, 799.0, -0.499374, False),
]


def test_sample_machine_days_golden_values(spark):
    rows = []
    for machine, day, qty, *_ in SAMPLE_GOLDEN:
        rows += [r for r in _days(machine, [0, 0, 0]) if r[2].day == day]
        rows[-1] = rows[-1][:3] + (qty,) + rows[-1][4:]
    out = _baseline(spark, rows)
    assert len(out) == 15
    for machine, day, qty, mean, sd, z, flag in SAMPLE_GOLDEN:
        r = out[f"{machine}_2026-01-0{day}"]
        assert r["total_quantity"] == qty
        assert (r["baseline_mean"], r["baseline_stddev"]) == (mean, sd)
        assert round(r["baseline_z_score"], 6) == z and r["is_baseline_anomaly"] is flag
    assert sum(r["is_baseline_anomaly"] for r in out.values()) == 5


def test_forest_rows_are_drawn_without_a_lambda(spark):
    import hashlib

    from forgeline.operators.iforest import tree_samples

    df = spark.range(2000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").cast("int").alias("x"))
    samples = tree_samples(df, "key", ["x"], 5, 8, 2000, 42)
    assert "lambda" not in samples._jdf.queryExecution().analyzed().toString()
    want = {(t, k) for t in range(5) for k in sorted((f"k{i}" for i in range(2000)), key=lambda k: hashlib.md5(f"42|{t}|row|{k}".encode()).hexdigest())[:8]}
    assert {(r["tree"], r["key"]) for r in samples.collect()} == want
    redrawn = tree_samples(df, "key", ["x"], 5, 8, 2000, 42, only_trees=[3], prefilter=False)
    assert {(r["tree"], r["key"]) for r in redrawn.collect()} == {x for x in want if x[0] == 3}
