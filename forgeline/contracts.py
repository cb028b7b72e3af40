"""Table contracts (schemas, keys) and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must stay exactly as written for results to agree with
# the behaviour being reproduced (reason texts, accepted values, thresholds).
# ---------------------------------------------------------------------------
REASON_MISSING_REQUIRED = "missing required field"
REASON_UNKNOWN_MACHINE = "unknown machine_id (foreign key would be violated)"
REASON_UNKNOWN_EVENT = "unknown production_event_id (foreign key would be violated)"
REASON_BAD_TIMESTAMP = "invalid or corrupted timestamp"
REASON_BAD_QUANTITY = "missing or unparsable quantity_produced"
REASON_NONPOSITIVE_QUANTITY = "physically impossible quantity_produced (<= 0)"
MIN_VALID_YEAR = 2000
ACCEPTED_UNITS = ["units", "kg"]
ACCEPTED_RESULTS = ["pass", "fail"]
BASE_UNIT = "units"
DEFECT_TYPES = ["dimension", "surface_finish", "assembly", "material"]
BASELINE_Z_THRESHOLD = 2.5
MIN_ROWS_FOR_FOREST = 20
FOREST_TREES = 100
FOREST_MAX_SAMPLES = 256
FOREST_SEED = 42
ROW_REFERENCE_PREFIX = "hash:"
ROW_REFERENCE_HEX_CHARS = 16

# Reasons added by this library for rows the original would reject with a failed
# INSERT (NOT NULL / type / range); evaluated after the rules above.
REASON_BAD_INSTALL_DATE = "invalid install_date"
REASON_QUANTITY_RANGE = "quantity_produced out of range"

INT32_MAX = 2**31 - 1

# ---------------------------------------------------------------------------
# Raw CSV layouts: every field arrives as text, columns are bound by name.
# ---------------------------------------------------------------------------
CSV_COLUMNS = {
    "machines": ["machine_id", "machine_name", "machine_type", "install_date"],
    "production_events": ["event_id", "machine_id", "timestamp", "product_code",
                          "quantity_produced", "unit", "shift"],
    "quality_checks": ["check_id", "production_event_id", "timestamp", "result",
                       "defect_type", "inspector_id"],
    "maintenance_events": ["maintenance_id", "machine_id", "start_time", "end_time",
                           "maintenance_type", "technician_id"],
}

# Parents first: each table's foreign keys point at tables earlier in this list.
INGEST_ORDER = ["machines", "production_events", "quality_checks", "maintenance_events"]

PRIMARY_KEY = {
    "machines": "machine_id",
    "production_events": "event_id",
    "quality_checks": "check_id",
    "maintenance_events": "maintenance_id",
}

LINEAGE_FIELDS = [
    T.StructField("ingested_at", T.TimestampNTZType(), False),
    T.StructField("source_file", T.StringType(), False),
    T.StructField("batch_id", T.StringType(), False),
]


def _struct(fields, lineage=True) -> T.StructType:
    return T.StructType(list(fields) + (LINEAGE_FIELDS if lineage else []))


RAW_SCHEMAS = {
    "machines": _struct([
        T.StructField("machine_id", T.StringType(), False),
        T.StructField("machine_name", T.StringType(), False),
        T.StructField("machine_type", T.StringType(), False),
        T.StructField("install_date", T.DateType(), False),
    ]),
    "production_events": _struct([
        T.StructField("event_id", T.StringType(), False),
        T.StructField("machine_id", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampNTZType(), False),
        T.StructField("product_code", T.StringType(), False),
        T.StructField("quantity_produced", T.IntegerType(), False),
        T.StructField("unit", T.StringType(), False),
        T.StructField("shift", T.StringType(), False),
    ]),
    "quality_checks": _struct([
        T.StructField("check_id", T.StringType(), False),
        T.StructField("production_event_id", T.StringType(), False),
        T.StructField("check_timestamp", T.TimestampNTZType(), False),
        T.StructField("result", T.StringType(), False),
        T.StructField("defect_type", T.StringType(), True),
        T.StructField("inspector_id", T.StringType(), True),
    ]),
    "maintenance_events": _struct([
        T.StructField("maintenance_id", T.StringType(), False),
        T.StructField("machine_id", T.StringType(), False),
        T.StructField("start_time", T.TimestampNTZType(), False),
        T.StructField("end_time", T.TimestampNTZType(), False),
        T.StructField("maintenance_type", T.StringType(), False),
        T.StructField("technician_id", T.StringType(), False),
    ]),
}

QUARANTINE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("row_reference", T.StringType(), False),
    T.StructField("reason", T.StringType(), False),
    T.StructField("raw_data", T.StringType(), False),
    T.StructField("source_file", T.StringType(), False),
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("quarantined_at", T.TimestampNTZType(), False),
])
QUARANTINE_KEY = ["table_name", "row_reference", "source_file"]

ANOMALY_SCHEMA = T.StructType([
    T.StructField("machine_day_key", T.StringType(), False),
    T.StructField("machine_id", T.StringType(), False),
    T.StructField("production_date", T.DateType(), False),
    T.StructField("total_quantity", T.LongType(), True),
    T.StructField("baseline_mean", T.DoubleType(), True),
    T.StructField("baseline_stddev", T.DoubleType(), True),
    T.StructField("baseline_z_score", T.DoubleType(), True),
    T.StructField("is_baseline_anomaly", T.BooleanType(), False),
    T.StructField("isolation_forest_score", T.DoubleType(), True),
    T.StructField("is_isolation_forest_anomaly", T.BooleanType(), False),
    T.StructField("scored_at", T.TimestampNTZType(), False),
])

STATS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("inserted", T.LongType(), False),
    T.StructField("skipped_duplicate", T.LongType(), False),
    T.StructField("quarantined", T.LongType(), False),
])
