"""Key sketches: batches that hold none of the keys are not opened, and no key is ever missed."""

import pytest
from pyspark.sql import functions as F

from conftest import write_files
from plant_fixture import FILES
from forgeline import contracts as C
from forgeline.plans.ingest import ingest_folder
from forgeline.sources import sketch as K


@pytest.mark.parametrize("per_word", [0.5, 2.0, 1000.0, 1e9])
def test_no_key_is_missed(spark, per_word):
    """At any rate of false hits: the words may be crowded, or one."""
    sketches = None
    for b in range(4):
        keys = spark.range(b * 500, (b + 1) * 500).selectExpr("concat('K', id) AS k", "id AS part")
        one = K.sketch(keys, ["k", "part"], 500, f"batch{b}", per_word)
        sketches = one if sketches is None else sketches.unionByName(one)
    for ids, holding in (([7], {"batch0"}), ([499, 1999], {"batch0", "batch3"}), ([5000], set()), ([], set()), ([1000, None], {"batch2"})):
        rows = spark.createDataFrame([(i,) for i in ids], "part long").withColumn("k", F.concat(F.lit("K"), F.col("part").cast("string")))
        assert holding <= set(K.may_hold(sketches, rows, ["k", "part"]))


def test_false_hits_are_rare(spark):
    one = K.sketch(spark.range(20_000), ["id"], 20_000, "b").checkpoint()
    assert one.count() <= 2 ** K.size_of(20_000) <= 20_000
    probes = spark.range(100_000, 200_000)
    size = K.size_of(20_000)
    hits = probes.select(F.lit(size).alias("size"), K._word(["id"], size).alias("word"), K._places(["id"]).alias("places")).join(one, ["size", "word"])
    assert hits.where(F.col("bits").bitwiseAND(F.col("places")) == F.col("places")).count() < 2_000  # under 2 %


def test_size_of():
    assert [K.size_of(n, 2.0) for n in (0, 1, 2, 3, 4, 5, 100)] == [0, 0, 0, 1, 1, 2, 6]


def test_ingest_opens_only_batches_that_may_hold_its_keys(spark, store, tmp_path):
    header = FILES["production_events.csv"].split("\n")[0]
    event = "EVT-{b}{i},M001,2026-01-0{b}T08:00:00,PRD-A,70,units,day\n"
    for b in range(1, 6):
        files = {"machines.csv": FILES["machines.csv"]} if b == 1 else {}
        files["production_events.csv"] = header + "\n" + "".join(event.format(b=b, i=i) for i in range(3))
        ingest_folder(spark, store, write_files(tmp_path / f"d{b}", files), f"day{b}")
    assert len(store.state("production_events")) == 5
    opened = []
    read = store.read_folders
    store.read_folders = lambda folders, schema=None: opened.extend(folders) or read(folders, schema)
    third = store.state("production_events")[2]
    again = write_files(tmp_path / "again", {"production_events.csv": header + "\n" + event.format(b=3, i=1) + event.format(b=9, i=1)})
    stats = {r["table_name"]: r for r in ingest_folder(spark, store, again, "again").collect()}
    assert (stats["production_events"]["inserted"], stats["production_events"]["skipped_duplicate"]) == (1, 1)
    assert {f for f in opened if f.startswith("production_events/")} - set(store.state("production_events")[-1:]) == {third}
    opened.clear()
    checks = write_files(tmp_path / "checks", {"quality_checks.csv": FILES["quality_checks.csv"].split("\n")[0] + "\n" + "C1,EVT-21,2026-01-05T08:00:00,pass,,\nC2,EVT-77,2026-01-05T08:00:00,pass,,\n"})
    stats = {r["table_name"]: r for r in ingest_folder(spark, store, checks, "checks").collect()}
    assert (stats["quality_checks"]["inserted"], stats["quality_checks"]["quarantined"]) == (1, 1)
    assert {f for f in opened if f.startswith("production_events/")} == {store.state("production_events")[1]}
    assert store.read("production_events", C.RAW_SCHEMAS["production_events"]).count() == 16
