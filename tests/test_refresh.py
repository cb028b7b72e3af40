"""Change propagation: refreshed models equal a full rebuild, and only touched days are read and written."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from forgeline import contracts as C
from forgeline.operators.topk import latest_per_key, merge_latest
from forgeline.plans import refresh as R
from forgeline.plans.models import MARTS, build_models
from forgeline.plans.scoring import baseline_of_days, baseline_scores, machine_day_features
from forgeline.sources.store import TableStore

LINEAGE = (dt.datetime(2026, 1, 1), "f", "b")


def random_batches(seed, batches=4):
    """Batches with new machines, events, checks of events of any earlier batch (late ones, ties in time), and maintenance."""
    rng = random.Random(seed)
    machines, events, n = [], [], 0
    for b in range(batches):
        new = {t: [] for t in C.INGEST_ORDER}
        for _ in range(3 if b == 0 else rng.randint(0, 1)):
            machines.append(f"M{len(machines)}")
            new["machines"].append((machines[-1], "name", rng.choice(["press", "lathe"]), dt.date(2020, 1, 1), *LINEAGE))
        for _ in range(rng.randint(5, 15) if b != 2 else 0):
            events.append(f"E{len(events)}")
            at = dt.datetime(2026, 1, 1 + b * 2 + rng.randint(0, 2), rng.randint(0, 23))
            new["production_events"].append((events[-1], rng.choice(machines), at, rng.choice("PQR"), rng.randint(1, 99), rng.choice(["units", "kg"]), "day", *LINEAGE))
        for _ in range(rng.randint(5, 20)):
            n += 1
            at = dt.datetime(2026, 1, rng.randint(1, 9), 12)
            result = rng.choice(["pass", "fail"])
            new["quality_checks"].append((f"C{rng.randint(0, 9)}{n:04d}", rng.choice(events), at, result, rng.choice(C.DEFECT_TYPES) if result == "fail" else None, None, *LINEAGE))
        for _ in range(rng.randint(0, 3)):
            n += 1
            at = dt.datetime(2026, 1, 3, 6)
            new["maintenance_events"].append((f"T{n}", rng.choice(machines), at, at + dt.timedelta(minutes=rng.randint(1, 500)), "planned", "tech", *LINEAGE))
        yield new


def append(spark, store, new):
    for table, rows in new.items():
        if rows:
            store.append(spark.createDataFrame(rows, C.RAW_SCHEMAS[table]), table)


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_equals_a_rebuild(spark, store, seed):
    for new in random_batches(seed):
        append(spark, store, new)
        before = store.parts("mart_production_daily")
        days = R.refresh_models(store)
        after = store.parts("mart_production_daily")
        assert {d for d in after if after[d] != before.get(d)} == set(days)
        whole = build_models({t: store.read(t, C.RAW_SCHEMAS[t]) for t in C.INGEST_ORDER})
        stored = R.stored_models(store)
        for m in [*MARTS, "int_production_enriched", "int_daily_machine_summary"]:
            assert rows_of(stored[m]) == rows_of(whole[m]), m
        scores = rows_of(baseline_scores(machine_day_features(whole["mart_production_daily"])))
        assert rows_of(baseline_of_days(store, sorted(after))) == scores
        one = sorted(after)[len(after) // 2]
        assert rows_of(baseline_of_days(store, [one])) == [x for x in scores if one.replace("-", ", ").replace(", 0", ", ") in x]
        assert R.refresh_models(store) == [] and store.parts("mart_production_daily") == after


def test_a_refresh_that_died_is_repeated(spark, store, monkeypatch):
    first, second, *_ = random_batches(3)
    append(spark, store, first)
    R.refresh_models(store)
    append(spark, store, second)
    commit = store.commit
    monkeypatch.setattr(store, "commit", lambda rows: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        R.refresh_models(store)
    monkeypatch.setattr(store, "commit", commit)
    again = TableStore(spark, store.root)
    again.sweep()
    R.refresh_models(again)
    whole = build_models({t: again.read(t, C.RAW_SCHEMAS[t]) for t in C.INGEST_ORDER})
    stored = R.stored_models(again)
    assert all(rows_of(stored[m]) == rows_of(whole[m]) for m in [*MARTS, "int_production_enriched"])


def test_only_touched_days_and_new_checks_are_read(spark, store):
    """The merge scans the folders of the touched days and the batch's checks, and no stored check."""
    batches = list(random_batches(4))
    for new in batches[:3]:
        append(spark, store, new)
    R.refresh_models(store)
    old = {t: set(store.state(t)) for t in ("production_events", "quality_checks")}
    late = {t: [] for t in C.INGEST_ORDER} | {"quality_checks": [("C99999", "E0", dt.datetime(2026, 1, 9, 23), "fail", "scratch", None, *LINEAGE)]}
    append(spark, store, late)
    fresh = R.fresh_batches(store)
    assert not fresh["production_events"] and set(fresh["quality_checks"]).isdisjoint(old["quality_checks"])
    files = []
    read = store.read_folders
    store.read_folders = lambda folders, schema=None: files.extend(folders) or read(folders, schema)
    days = R.refresh_models(store)
    assert len(days) == 1
    assert not old["production_events"] & set(files) and not old["quality_checks"] & set(files)
    made = [f for f in files if f.startswith(R.ENRICHED)]
    stored_days = [f for f in made if f in store.state(R.ENRICHED)]
    assert all(f.endswith(days[0]) for f in made[-2:]) and len(set(made)) <= len(set(stored_days)) + 1
    top = store.read(R.ENRICHED).where("event_id = 'E0'").first()
    assert top["check_id"] == "C99999" and top["quality_result"] == "fail"


def test_merge_latest_equals_latest_of_all(spark):
    rng = random.Random(7)
    rows = [(f"E{rng.randint(0, 20)}", dt.datetime(2026, 1, rng.randint(1, 5)), f"C{i}", rng.choice(["pass", "fail"]), rng.choice([None, "scratch"])) for i in range(300)] + [(None, dt.datetime(2026, 1, 1), "C", "pass", None)]
    df = spark.createDataFrame(rows, "e string, t timestamp_ntz, id string, result string, defect string")
    how = dict(key="e", order_by=["t", "id"], carry=["result", "defect"])
    part = F.pmod(F.xxhash64("id"), F.lit(3))
    state = None
    for i in range(3):
        batch = latest_per_key(df.where(part == i), count_alias="n", **how)
        state = batch if state is None else merge_latest(state, batch, count_alias="n", **how)
    assert rows_of(state) == rows_of(latest_per_key(df, count_alias="n", **how))
