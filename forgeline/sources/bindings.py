"""Bind the driver's test tables (TPC-H-like star schema + events) to the plant relations.

Each binding exists twice, as a DataFrame builder and as equivalent SQL for the
DuckDB oracle; both are derived row-for-row from the full source tables.

Clean binding (typed raw tables, as if already ingested):
  machines            <- customer
  production_events   <- events
  quality_checks      <- lineitem
  maintenance_events  <- lineitem
Dirty binding (raw text rows + file order ``ord``) <- events, with rule-breaking values
(and a unit outside the accepted list) injected by key arithmetic, for the validation / quarantine / dedup operators.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.functions.scalar import ntz_lit

# Fixed lineage stamp for bound tables (deterministic, comparable with the oracle).
BOUND_INGESTED_AT = _dt.datetime(2026, 1, 1, 0, 0, 0)
BOUND_SOURCE = "testdata"
BOUND_BATCH = "testdata"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineage() -> list:
    return [
        ntz_lit(BOUND_INGESTED_AT).alias("ingested_at"),
        F.lit(BOUND_SOURCE).alias("source_file"),
        F.lit(BOUND_BATCH).alias("batch_id"),
    ]


def _s(c):
    return F.col(c).cast("string")


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("M"), _s("c_custkey")).alias("machine_id"),
        F.col("c_name").alias("machine_name"),
        F.col("c_mktsegment").alias("machine_type"),
        F.date_add(F.lit(_dt.date(2018, 1, 1)), F.col("c_nationkey")).alias("install_date"),
        *_lineage(),
    )


def _unit(event_id):
    return F.when(event_id % 20 == 0, F.lit("kg")).otherwise(F.lit("units"))


def _shift(ts):
    h = F.hour(ts)
    return F.when(h < 8, "night").when(h < 16, "morning").otherwise("afternoon")


def production_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("E"), _s("event_id")).alias("event_id"),
        F.concat(F.lit("M"), _s("user_id")).alias("machine_id"),
        F.col("ts").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("event_type").alias("product_code"),
        (F.floor("value") + 1).cast("int").alias("quantity_produced"),
        _unit(F.col("event_id")).alias("unit"),
        _shift(F.col("ts")).alias("shift"),
        *_lineage(),
    )


def _lineitem_id(prefix: str):
    return F.concat_ws(
        "-",
        F.concat(F.lit(prefix), _s("l_orderkey")),
        _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"),
        F.date_format("l_shipdate", "yyyyMMdd"),
    )


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    fail = F.col("l_returnflag") == "R"
    ln = F.col("l_linenumber") % 5
    defect = (F.when(ln == 0, "dimension").when(ln == 1, "surface_finish")
              .when(ln == 2, "assembly").when(ln == 3, "material"))
    return li.select(
        _lineitem_id("L").alias("check_id"),
        F.concat(F.lit("E"), _s("l_orderkey")).alias("production_event_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("check_timestamp"),
        F.when(fail, "fail").otherwise("pass").alias("result"),
        F.when(fail, defect).alias("defect_type"),
        F.when(F.col("l_suppkey") % 50 != 0,
               F.concat(F.lit("INS"), (F.col("l_suppkey") % 5).cast("string"))).alias("inspector_id"),
        *_lineage(),
    )


def maintenance_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    start = F.col("l_shipdate").cast("timestamp_ntz")
    ln3 = F.col("l_linenumber") % 3
    return li.select(
        _lineitem_id("T").alias("maintenance_id"),
        F.concat(F.lit("M"), _s("l_suppkey")).alias("machine_id"),
        start.alias("start_time"),
        F.timestamp_add("HOUR", (F.col("l_linenumber") % 6 + 1), start).alias("end_time"),
        F.when(ln3 == 0, "preventive").when(ln3 == 1, "corrective").otherwise("inspection")
        .alias("maintenance_type"),
        F.concat(F.lit("TEC"), (F.col("l_suppkey") % 3).cast("string")).alias("technician_id"),
        *_lineage(),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "machines": machines(spark, sf_dir),
        "production_events": production_events(spark, sf_dir),
        "quality_checks": quality_checks(spark, sf_dir),
        "maintenance_events": maintenance_events(spark, sf_dir),
    }


# ---------------------------------------------------------------------------
# Dirty production-event batch: CSV-shaped text columns plus ``ord`` (file order).
# ---------------------------------------------------------------------------
def dirty_production_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    i = F.col("event_id")
    qty = (F.floor("value") + 1).cast("bigint")
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    bad_ts = (F.when(i % 37 == 0, F.lit("not-a-date"))
              .when(i % 33 == 0, F.concat(F.lit("1900"), F.substring(ts_text, 5, 15)))
              .otherwise(ts_text))
    bad_qty = (F.when(i % 73 == 0, F.lit("n/a"))
               .when(i % 67 == 0, F.lit("0"))
               .when(i % 71 == 0, (-qty).cast("string"))
               .otherwise(qty.cast("string")))
    kind = F.col("_kind")
    return e.select("*", F.explode(_copies(i)).alias("_kind")).select(
        F.concat(F.lit("E"), _s("event_id")).alias("event_id"),
        F.when(i % 41 == 0, F.lit("M-UNKNOWN"))
        .otherwise(F.concat(F.lit("M"), _s("user_id"))).alias("machine_id"),
        F.when(kind == 2, ts_text).otherwise(bad_ts).alias("timestamp"),
        F.col("event_type").alias("product_code"),
        F.when(kind == 1, F.lit("9999")).otherwise(bad_qty).alias("quantity_produced"),
        F.when(i % 59 == 0, F.lit("pcs")).otherwise(_unit(i)).alias("unit"),
        _shift(F.col("ts")).alias("shift"),
        F.when(kind == 0, F.lit(0)).otherwise(F.lit(1)).alias("ord"),
    )


def _copies(i):
    """File copies per event: the original (0), a resend with a new quantity (1) for
    id % 50 = 7, and a corrected resend (2) for id % 66 = 0.  One scan, no union."""
    return F.filter(
        F.array(F.lit(0), F.lit(1), F.lit(2)),
        lambda k: (k == 0) | ((k == 1) & (i % 50 == 7)) | ((k == 2) & (i % 66 == 0) & (i % 50 != 7)),
    )


# ---------------------------------------------------------------------------
# The same bindings as DuckDB SQL (CTE bodies), for the oracle.
# ---------------------------------------------------------------------------
_LINEAGE_SQL = ("TIMESTAMP '2026-01-01 00:00:00' AS ingested_at, "
                "'testdata' AS source_file, 'testdata' AS batch_id")

SQL = {
    "machines": f"""
        SELECT 'M' || c_custkey AS machine_id, c_name AS machine_name,
               c_mktsegment AS machine_type,
               CAST(DATE '2018-01-01' + c_nationkey AS DATE) AS install_date, {_LINEAGE_SQL}
        FROM customer""",
    "production_events": f"""
        SELECT 'E' || event_id AS event_id, 'M' || user_id AS machine_id,
               CAST(ts AS TIMESTAMP) AS event_timestamp, event_type AS product_code,
               CAST(floor(value) + 1 AS INTEGER) AS quantity_produced,
               CASE WHEN event_id % 20 = 0 THEN 'kg' ELSE 'units' END AS unit,
               CASE WHEN hour(ts) < 8 THEN 'night' WHEN hour(ts) < 16 THEN 'morning'
                    ELSE 'afternoon' END AS shift, {_LINEAGE_SQL}
        FROM events""",
    "quality_checks": f"""
        SELECT 'L' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
                   || '-' || strftime(l_shipdate, '%Y%m%d') AS check_id,
               'E' || l_orderkey AS production_event_id,
               CAST(l_shipdate AS TIMESTAMP) AS check_timestamp,
               CASE WHEN l_returnflag = 'R' THEN 'fail' ELSE 'pass' END AS result,
               CASE WHEN l_returnflag = 'R' THEN
                    CASE l_linenumber % 5 WHEN 0 THEN 'dimension' WHEN 1 THEN 'surface_finish'
                         WHEN 2 THEN 'assembly' WHEN 3 THEN 'material' END END AS defect_type,
               CASE WHEN l_suppkey % 50 <> 0 THEN 'INS' || (l_suppkey % 5) END AS inspector_id,
               {_LINEAGE_SQL}
        FROM lineitem""",
    "maintenance_events": f"""
        SELECT 'T' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
                   || '-' || strftime(l_shipdate, '%Y%m%d') AS maintenance_id,
               'M' || l_suppkey AS machine_id,
               CAST(l_shipdate AS TIMESTAMP) AS start_time,
               CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_linenumber % 6 + 1 AS BIGINT)) AS end_time,
               CASE l_linenumber % 3 WHEN 0 THEN 'preventive' WHEN 1 THEN 'corrective'
                    ELSE 'inspection' END AS maintenance_type,
               'TEC' || (l_suppkey % 3) AS technician_id, {_LINEAGE_SQL}
        FROM lineitem""",
    "dirty_production_events": """
        WITH base AS (
            SELECT event_id AS _i, 'E' || event_id AS event_id,
                   CASE WHEN event_id % 41 = 0 THEN 'M-UNKNOWN' ELSE 'M' || user_id END AS machine_id,
                   CASE WHEN event_id % 37 = 0 THEN 'not-a-date'
                        WHEN event_id % 33 = 0 THEN '1900' || substr(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 5, 15)
                        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS timestamp,
                   event_type AS product_code,
                   CASE WHEN event_id % 73 = 0 THEN 'n/a'
                        WHEN event_id % 67 = 0 THEN '0'
                        WHEN event_id % 71 = 0 THEN CAST(-CAST(floor(value) + 1 AS BIGINT) AS VARCHAR)
                        ELSE CAST(CAST(floor(value) + 1 AS BIGINT) AS VARCHAR) END AS quantity_produced,
                   CASE WHEN event_id % 59 = 0 THEN 'pcs' WHEN event_id % 20 = 0 THEN 'kg'
                        ELSE 'units' END AS unit,
                   CASE WHEN hour(ts) < 8 THEN 'night' WHEN hour(ts) < 16 THEN 'morning'
                        ELSE 'afternoon' END AS shift,
                   strftime(ts, '%Y-%m-%dT%H:%M:%S') AS _good_ts
            FROM events)
        SELECT event_id, machine_id, timestamp, product_code, quantity_produced, unit, shift, 0 AS ord
        FROM base
        UNION ALL
        SELECT event_id, machine_id, timestamp, product_code, '9999', unit, shift, 1
        FROM base WHERE _i % 50 = 7
        UNION ALL
        SELECT event_id, machine_id, _good_ts, product_code, quantity_produced, unit, shift, 1
        FROM base WHERE _i % 66 = 0 AND _i % 50 <> 7""",
}


# ---------------------------------------------------------------------------
# Text (CSV-shaped) batch of all four tables, for the ingest path.  Machines carry
# injected missing names (key % 97 = 0) and unparsable install dates (key % 89 = 0);
# production events are the dirty batch above; checks and maintenance are the clean
# bindings written as text (ISO timestamps, '' for absent optional values).
# ``_file`` / ``_pos`` give the file order used for first-wins rules.
# ---------------------------------------------------------------------------
_ISO = "yyyy-MM-dd'T'HH:mm:ss"


def text_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    machines_txt = c.select(
        F.concat(F.lit("M"), _s("c_custkey")).alias("machine_id"),
        F.when(k % 97 == 0, F.lit("")).otherwise(F.col("c_name")).alias("machine_name"),
        F.col("c_mktsegment").alias("machine_type"),
        F.when(k % 89 == 0, F.lit("not-a-date"))
        .otherwise(F.date_add(F.lit(_dt.date(2018, 1, 1)), F.col("c_nationkey")).cast("string"))
        .alias("install_date"),
        F.lit("machines").alias("_file"), F.lit(0).cast("bigint").alias("_pos"),
    )
    ev = dirty_production_events(spark, sf_dir)
    events_txt = ev.select(
        *[x for x in ev.columns if x != "ord"],
        F.lit("production_events").alias("_file"), F.col("ord").cast("bigint").alias("_pos"))
    qc = quality_checks(spark, sf_dir)
    checks_txt = qc.select(
        "check_id", "production_event_id",
        F.date_format("check_timestamp", _ISO).alias("timestamp"), "result",
        F.coalesce("defect_type", F.lit("")).alias("defect_type"),
        F.coalesce("inspector_id", F.lit("")).alias("inspector_id"),
        F.lit("quality_checks").alias("_file"), F.lit(0).cast("bigint").alias("_pos"))
    mt = maintenance_events(spark, sf_dir)
    maint_txt = mt.select(
        "maintenance_id", "machine_id",
        F.date_format("start_time", _ISO).alias("start_time"),
        F.date_format("end_time", _ISO).alias("end_time"),
        "maintenance_type", "technician_id",
        F.lit("maintenance_events").alias("_file"), F.lit(0).cast("bigint").alias("_pos"))
    return {"machines": machines_txt, "production_events": events_txt,
            "quality_checks": checks_txt, "maintenance_events": maint_txt}


SQL["machines_text"] = """
    SELECT 'M' || c_custkey AS machine_id,
           CASE WHEN c_custkey % 97 = 0 THEN '' ELSE c_name END AS machine_name,
           c_mktsegment AS machine_type,
           CASE WHEN c_custkey % 89 = 0 THEN 'not-a-date'
                ELSE CAST(CAST(DATE '2018-01-01' + c_nationkey AS DATE) AS VARCHAR) END AS install_date
    FROM customer"""
SQL["checks_text"] = """
    SELECT check_id, production_event_id, strftime(check_timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp,
           result, coalesce(defect_type, '') AS defect_type, coalesce(inspector_id, '') AS inspector_id
    FROM quality_checks"""
SQL["maintenance_text"] = """
    SELECT maintenance_id, machine_id, strftime(start_time, '%Y-%m-%dT%H:%M:%S') AS start_time,
           strftime(end_time, '%Y-%m-%dT%H:%M:%S') AS end_time, maintenance_type, technician_id
    FROM maintenance_events"""
