from conftest import write_files
from plant_fixture import DAILY, DOWNTIME, FILES, QUALITY

from forgeline.plans.ingest import ingest_folder
from forgeline.plans.models import build_models
from forgeline.plans.refresh import raw_from_store, refresh_models, stored_models


def _models(spark, store, tmp_path):
    ingest_folder(spark, store, write_files(tmp_path / "in", FILES), "data/sample")
    refresh_models(store)
    return stored_models(store)


def test_marts_from_ingested_batch(spark, store, tmp_path):
    m = _models(spark, store, tmp_path)
    daily = {(r["production_day_id"], r["machine_type"], r["event_count"], r["total_quantity"],
              r["checked_count"], r["fail_count"], r["defect_rate"], r["unit_inconsistency_count"])
             for r in m["mart_production_daily"].collect()}
    assert daily == DAILY
    quality = {tuple(r) for r in m["mart_quality_summary"].collect()}
    assert quality == QUALITY
    down = {(r["machine_id"], r["maintenance_event_count"], r["total_downtime_hours"])
            for r in m["mart_machine_downtime"].collect()}
    assert down == DOWNTIME
    last = {r["machine_id"]: r["last_maintenance_end"] for r in m["mart_machine_downtime"].collect()}
    assert last["M003"] is None and str(last["M001"]) == "2026-01-01 03:30:00"


def test_enriched_keeps_newest_check_and_flags_duplicates(spark, store, tmp_path):
    stored = _models(spark, store, tmp_path)["int_production_enriched"]
    rel = build_models(raw_from_store(store))["int_production_enriched"]
    assert sorted(map(repr, stored.select(rel.columns).collect())) == sorted(map(repr, rel.collect()))
    e = {r["event_id"]: r for r in rel.collect()}
    assert e["E1"]["check_id"] == "C2" and e["E1"]["quality_result"] == "fail"
    assert e["E1"]["has_duplicate_quality_checks"] is True
    assert e["E2"]["has_duplicate_quality_checks"] is False
    assert e["E3"]["check_id"] is None and e["E3"]["has_duplicate_quality_checks"] is False
    assert e["E2"]["has_unit_inconsistency"] is True


def test_tie_on_timestamp_broken_by_check_id(spark):
    import datetime as dt

    from forgeline.plans.intermediate import latest_quality_check

    t = dt.datetime(2026, 1, 1, 10)
    rows = [("C1", "E1", t, "pass", None), ("C3", "E1", t, "fail", "material"), ("C2", "E1", t, "pass", None)]
    df = spark.createDataFrame(rows, "check_id string, production_event_id string, check_timestamp timestamp_ntz, "
                                     "result string, defect_type string")
    r = latest_quality_check(df).first()
    assert (r["check_id"], r["result"], r["n_checks"]) == ("C3", "fail", 3)
