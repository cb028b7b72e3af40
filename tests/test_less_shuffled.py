"""Steps that shuffle keys instead of rows, and tasks whose memory does not grow with the input."""

import glob
import gzip
import os
import random

import pyarrow.parquet as pq
import pytest
from conftest import write_files
from plant_fixture import FILES
from pyspark.sql import functions as F

from forgeline import contracts as C
from forgeline.catalog import runs
from forgeline.functions import parse_timestamp
from forgeline.operators import dedup
from forgeline.operators.quality import dq_report
from forgeline.operators.validate import mark_known, named_keys
from forgeline.plans import refresh as R
from forgeline.plans.ingest import classify_maintenance_events, ingest_folder
from forgeline.plans import staging as S
from forgeline.plans.models import build_models
from forgeline.plans.tests_suite import SUITE
from forgeline.session import INITIAL_PARTITIONS, shuffled_by_size
from forgeline.sources.csv import _files, write_csv
from forgeline.sources.store import TableStore

ORDER = ["_file", "_pos"]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows_of(df) -> list:
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("few", [500_000, 3])
def test_first_per_stored_key_equals_first_per_key(spark, monkeypatch, few):
    monkeypatch.setattr(dedup, "FEW_KEYS", few)
    df = spark.createDataFrame([(f"k{i % 70}", "f", 100 - i, i) for i in range(100)], "k string, _file string, _pos long, v long")
    assert rows_of(dedup.first_per_stored_key(df, ["k"], ORDER)) == rows_of(dedup.first_per_key(df, ["k"], ORDER))


def test_rows_of_different_keys_meet_no_window_and_no_join(spark):
    df = spark.createDataFrame([(f"k{i}", "f", i) for i in range(50)], "k string, _file string, _pos long")
    first = dedup.first_per_stored_key(df, ["k"], ORDER)
    assert "Window" not in plan(first) and first.count() == 50
    other = spark.createDataFrame([("x",)], "k string")
    assert "Join" not in plan(dedup.insert_stored_if_absent(first, other, ["k"]))
    assert dedup.insert_stored_if_absent(first, df.select("k").union(other), ["k"]).count() == 0


@pytest.mark.parametrize("few", [500_000, 3])
def test_insert_stored_if_absent_equals_insert_if_absent(spark, monkeypatch, few):
    monkeypatch.setattr(dedup, "FEW_KEYS", few)
    df = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, v long")
    stored = spark.createDataFrame([(f"k{i % 20}",) for i in range(10, 40)], "k string")  # a stored key may come twice
    assert rows_of(dedup.insert_stored_if_absent(df, stored, ["k"])) == rows_of(dedup.insert_if_absent(df, stored, ["k"]))


def test_few_parents_are_broadcast_and_more_are_held_by_partition(spark):
    df = spark.createDataFrame([("a",), ("x",), (None,)], "fk string")
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    for n, how in [(2, "strategy=broadcast"), (600_000, "strategy=shuffle_hash")]:
        marked = mark_known(df, "fk", keys, "k", "ok", n_keys=n)
        assert how in plan(marked)
        assert {r["fk"]: r["ok"] for r in marked.collect()} == {"a": True, "x": False, None: False}


def test_exported_batch_is_packed_and_keeps_first_copies_first(spark, tmp_path):
    spark.createDataFrame([(i, float(i)) for i in range(200)], "event_id long, value double").select(
        "event_id", F.lit("2024-01-02 03:04:05").cast("timestamp").alias("ts"), F.lit(1).cast("long").alias("user_id"),
        F.lit("click").alias("event_type"), "value", F.lit("").alias("props")).write.parquet(str(tmp_path / "sf/events.parquet"))
    for name, cols in [("customer", "c_custkey long, c_name string, c_mktsegment string, c_nationkey int"),
                       ("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate date, l_returnflag string")]:
        spark.createDataFrame([], cols).write.parquet(str(tmp_path / f"sf/{name}.parquet"))
    root = runs.export_text_batch(spark, str(tmp_path / "sf"), str(tmp_path / "out"), only="production_events")
    assert glob.glob(f"{root}/production_events.csv/part-*.csv.gz") and not glob.glob(f"{root}/production_events.csv/part-*.csv")
    back = runs.read_csv(spark, f"{root}/production_events.csv", C.CSV_COLUMNS["production_events"])
    copies = {}
    for r in back.orderBy(*ORDER).collect():
        copies.setdefault(r["event_id"], []).append(r["quantity_produced"])
    assert len(copies) == 200 and copies["E7"] == ["8", "9999"] and copies["E57"] == ["58", "9999"]


def test_downtime_shuffles_sums_not_maintenance_rows(spark, store):
    raw = {t: spark.createDataFrame([], C.RAW_SCHEMAS[t]) for t in C.INGEST_ORDER}
    spark.range(1).select(*[F.lit("m").cast(f.dataType).alias(f.name) if f.dataType.simpleString() == "string" else F.lit(None).cast(f.dataType).alias(f.name)
                            for f in C.RAW_SCHEMAS["maintenance_events"].fields]).write.parquet(store.path("m"))
    store.append(spark.read.parquet(store.path("m")), "maintenance_events")
    new = raw | {"maintenance_events": store.read("maintenance_events")}
    machines = S.stg_machines(spark.createDataFrame([("m", "n", "t", None, None, "f", "b")], C.RAW_SCHEMAS["machines"].fieldNames() and
                                                    "machine_id string, machine_name string, machine_type string, install_date date, ingested_at timestamp_ntz, source_file string, batch_id string"))
    made = R._downtime(store, machines, new)
    assert plan(made).count("LeftSemi") == 1  # the machines only
    assert [(r["machine_id"], r["maintenance_event_count"]) for r in made.collect()] == [("m", 1)]


def test_partitions_follow_the_size_of_the_files(spark, tmp_path):
    spark.range(10_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    with shuffled_by_size(spark, df, bytes_per_partition=1000) as n:
        assert n > 30 and spark.conf.get(INITIAL_PARTITIONS) == str(n)
    assert spark.conf.get(INITIAL_PARTITIONS, None) == before


def test_report_stacks_rows_without_a_lambda(spark):
    raw = {t: spark.createDataFrame([], C.RAW_SCHEMAS[t]) for t in C.INGEST_ORDER}
    report = dq_report(SUITE, build_models(raw))
    stacks = [line for line in report._jdf.queryExecution().analyzed().toString().splitlines() if "Generate explode" in line and "domain" in line and "place" in line]
    assert stacks and not any("filter(array(" in line for line in stacks)
    assert report.count() == 48


def test_lines_of_a_file_are_looked_at_without_a_sort(spark, tmp_path):
    texts = {"plain": "a,b\n1,2\n", "quoted": 'a,b\n"",2\n"x ""y"" z",3\n', "spans": 'a,b\n1,"x\ny"\n', "header": '"a\nc",b\n1,2\n', "é": 'a,b\n"é",ü\n'}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    files = _files(spark, str(tmp_path))
    physical = files._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in physical and "Sort [" not in physical
    assert "contains" in plan(files).lower()  # most lines have no quote to count
    got = {(r["first"], r["spans"], r["split"]) for r in files.collect()}
    assert got == {("a,b", False, False), ("a,b", True, False), ('"a', True, False)}


def test_packed_export_is_quick_to_pack(spark, tmp_path):
    rng = random.Random(3)
    df = spark.createDataFrame([(f"L{i}-{rng.randrange(9999)}", f"2024-01-{1 + rng.randrange(28):02d}T00:00:00") for i in range(20_000)], "k string, at string").coalesce(1)
    write_csv(df, str(tmp_path / "out"), 1_000_000)
    [part] = glob.glob(str(tmp_path / "out/part-*.csv.gz"))
    text = gzip.decompress(open(part, "rb").read())
    assert len(text.splitlines()) == 20_001 and os.path.getsize(part) > 1.05 * len(gzip.compress(text, 6))


def test_plain_maintenance_times_are_read_without_the_lambda(spark):
    times = ["2024-01-02T03:04:05", "2024-01-02 03:04:05", "1999-12-31T23:59:59", "2024-02-30T00:00:00", "2024-01-02T25:00:00", "2024-01-02T03:04:05.25", "2024-01-02",
             "20240102T0304", "2024-01-02T03:04:05+02:00", "2024-01-02T03:04Z", " 2024-01-02T03:04:05", "0000-01-01T00:00:00", "", "x", None]
    df = spark.createDataFrame([(f"T{i}", "M1", a, b, "inspection", "TEC1") for i, a in enumerate(times) for b in (times[0], a)],
                               "maintenance_id string, machine_id string, start_time string, end_time string, maintenance_type string, technician_id string")
    made = classify_maintenance_events(df, spark.createDataFrame([("M1",)], "machine_id string"))
    assert plan(made).count("CASE WHEN RLIKE(start_time") + plan(made).count("CASE WHEN start_time") > 0
    want = df.select("maintenance_id", parse_timestamp("start_time").alias("s"), parse_timestamp("end_time").alias("e")).collect()
    assert sorted(map(str, made.select("maintenance_id", "_start", "_end").collect())) == sorted(str(r).replace("s=", "_start=", 1).replace(" e=", " _end=", 1) for r in want)


@pytest.fixture
def never_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_meet_no_stored_keys_where_there_are_none(spark, never_broadcast):
    rows = spark.range(20).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("the rows were computed"))).cast("string").alias("k"))
    none = spark.range(3).where("id > 5").select(F.col("id").cast("string").alias("k"))
    assert dedup.insert_stored_if_absent(rows, none, ["k"]) is rows


def test_many_rows_meet_stored_keys_without_a_sort(spark, monkeypatch, never_broadcast):
    monkeypatch.setattr(dedup, "FEW_KEYS", 3)
    rows = spark.range(50).select(F.concat(F.lit("k"), F.col("id")).alias("k"), "id")
    for stored in (["k1", "k2", "x", "y", "z"], ["k1"] * 3 + ["k2"] + [f"x{i}" for i in range(1000)]):
        met = []
        out = dedup.insert_stored_if_absent(rows, spark.createDataFrame([(k,) for k in stored], "k string"), ["k"], lambda df: met.append(df) or df)
        physical = met[0]._jdf.queryExecution().executedPlan().toString()
        assert ("ShuffledHashJoin" in physical) == (len(stored) < 10)  # more than all tasks hold are sorted
        assert sorted(r["id"] for r in out.collect()) == [0, *range(3, 50)]
    named = spark.createDataFrame([(f"k{i}",) for i in range(6)], "fk string")
    plans = []
    monkeypatch.setattr(type(rows), "checkpoint", lambda df, *a: plans.append(df) or df)
    assert {r["k"] for r in named_keys(named, "fk", rows.select("k"), "k", 6).collect()} == {f"k{i}" for i in range(6)}
    assert "ShuffledHashJoin" in plans[0]._jdf.queryExecution().executedPlan().toString()


def test_staged_rows_have_no_dictionaries(spark, tmp_path):
    class Kept(TableStore):
        def drop(self, relative):
            if not relative.startswith("_staging"):
                super().drop(relative)

    ingest_folder(spark, Kept(spark, str(tmp_path / "store")), write_files(tmp_path / "in", FILES), "day")
    files = glob.glob(str(tmp_path / "store/_staging/*-classified/*.parquet"))
    groups = [pq.ParquetFile(f).metadata.row_group(0) for f in files if pq.ParquetFile(f).metadata.num_row_groups]
    assert groups and not any("DICTIONARY" in e for g in groups for i in range(g.num_columns) for e in g.column(i).encodings)
