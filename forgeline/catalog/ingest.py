"""Catalog: validation rules, routing, de-duplication, insert-if-absent, ingest (§2.2, J4, J5, U1, L1)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline import contracts as C
from forgeline.catalog.base import define_cte, register, with_ctes
from forgeline.functions import (
    is_blank,
    ntz_lit,
    parse_quantity,
    parse_timestamp,
    quantity_is_nonpositive,
    row_json,
    row_reference,
)
from forgeline.operators.dedup import append_union, first_per_key, insert_if_absent
from forgeline.operators.validate import mark_known, normalize_empty, route_quarantine, route_valid
from forgeline.plans import ingest as G
from forgeline.session import drop_scratch, scratch_path
from forgeline.sources import bindings as B
from forgeline.sources.store import TableStore

FIXED_SOURCE = "testdata/batch"
FIXED_BATCH = "batch-0001"
FIXED_LOADED_AT = _dt.datetime(2026, 1, 2, 0, 0, 0)
HISTORY_CUTOFF = _dt.datetime(2024, 1, 15)

# ---------------------------------------------------------------------------
# Oracle CTEs: the same classification in SQL
# ---------------------------------------------------------------------------
_TS_OK = r"regexp_full_match({c}, '\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}')"
# the whitespace Python's int() strips, in RE2 syntax (same set as functions.scalar)
_WS = r"[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WSF = _WS.replace("{", "{{").replace("}", "}}")  # braces escaped for str.format templates
# the text as int() reads it: edge whitespace removed, every decimal digit in ASCII
_DIGITS = [c for c in map(chr, range(0x80, 0x110000)) if c.isdecimal()]
_DIGITS_FROM, _DIGITS_TO = "".join(_DIGITS), "".join(str(int(c)) for c in _DIGITS)
_STRIP = ("translate(regexp_replace({c}, '^" + _WSF + "+|" + _WSF + "+$', '', 'g'), '"
          + _DIGITS_FROM + "', '" + _DIGITS_TO + "')")
_INT_OK = "coalesce(regexp_full_match(" + _STRIP + r", '[+-]?\d+(_\d+)*'), false)"


def _ts_sql(c: str) -> str:
    return (f"CASE WHEN {_TS_OK.format(c=c)} AND year(try_cast({c} AS TIMESTAMP)) >= 2000 "
            f"THEN try_cast({c} AS TIMESTAMP) END")


define_cte("machines_classified", r"""
    SELECT *, CASE
        WHEN coalesce(machine_id, '') = '' OR coalesce(machine_name, '') = ''
             OR coalesce(install_date, '') = '' THEN 'missing required field'
        WHEN NOT regexp_full_match(install_date, '\d{4}-\d{2}-\d{2}') OR try_cast(install_date AS DATE) IS NULL THEN 'invalid install_date'
        WHEN machine_type IS NULL THEN 'missing required field' END AS reason
    FROM machines_text""", ["machines_text"])
define_cte("accepted_machines",
           "SELECT DISTINCT machine_id FROM machines_classified WHERE reason IS NULL",
           ["machines_classified"])
define_cte("events_parsed", f"""
    SELECT d.*, a.machine_id IS NOT NULL AS fk_ok,
           {_ts_sql('d.timestamp')} AS parsed_ts,
           {_INT_OK.format(c='d.quantity_produced')} AS qty_is_int,
           CASE WHEN {_INT_OK.format(c='d.quantity_produced')}
                THEN try_cast(replace({_STRIP.format(c='d.quantity_produced')}, '_', '') AS DECIMAL(38,0)) END
               AS parsed_quantity
    FROM dirty_production_events d LEFT JOIN accepted_machines a ON d.machine_id = a.machine_id""",
           ["dirty_production_events", "accepted_machines"])
define_cte("events_classified", f"""
    SELECT *, CASE
        WHEN NOT fk_ok THEN 'unknown machine_id (foreign key would be violated)'
        WHEN parsed_ts IS NULL THEN 'invalid or corrupted timestamp'
        WHEN NOT qty_is_int THEN 'missing or unparsable quantity_produced'
        WHEN nonpositive THEN 'physically impossible quantity_produced (<= 0)'
        WHEN coalesce(parsed_quantity > 2147483647, true) THEN 'quantity_produced out of range'
        WHEN event_id IS NULL OR product_code IS NULL OR unit IS NULL OR shift IS NULL
             THEN 'missing required field' END AS reason
    FROM (SELECT *, qty_is_int AND coalesce(parsed_quantity <= 0,
                                            {_STRIP.format(c='quantity_produced')} LIKE '-%') AS nonpositive
          FROM events_parsed)""", ["events_parsed"])
define_cte("accepted_events",
           "SELECT DISTINCT event_id FROM events_classified WHERE reason IS NULL",
           ["events_classified"])
define_cte("checks_classified", f"""
    SELECT *, CASE
        WHEN NOT fk_ok THEN 'unknown production_event_id (foreign key would be violated)'
        WHEN parsed_ts IS NULL THEN 'invalid or corrupted timestamp'
        WHEN check_id IS NULL OR result IS NULL THEN 'missing required field' END AS reason
    FROM (SELECT t.*, a.event_id IS NOT NULL AS fk_ok, {_ts_sql('t.timestamp')} AS parsed_ts
          FROM checks_text t LEFT JOIN accepted_events a ON t.production_event_id = a.event_id)""",
           ["checks_text", "accepted_events"])
define_cte("maintenance_classified", f"""
    SELECT *, CASE
        WHEN NOT fk_ok THEN 'unknown machine_id (foreign key would be violated)'
        WHEN parsed_start IS NULL OR parsed_end IS NULL THEN 'invalid or corrupted timestamp'
        WHEN maintenance_id IS NULL OR maintenance_type IS NULL OR technician_id IS NULL
             THEN 'missing required field' END AS reason
    FROM (SELECT t.*, a.machine_id IS NOT NULL AS fk_ok, {_ts_sql('t.start_time')} AS parsed_start,
                 {_ts_sql('t.end_time')} AS parsed_end
          FROM maintenance_text t LEFT JOIN accepted_machines a ON t.machine_id = a.machine_id)""",
           ["maintenance_text", "accepted_machines"])


def _stats_sql(table: str, cte: str, key: str) -> str:
    return f"""
    SELECT '{table}' AS table_name,
           count(DISTINCT {key}) FILTER (WHERE reason IS NULL) AS inserted,
           count(*) FILTER (WHERE reason IS NULL)
             - count(DISTINCT {key}) FILTER (WHERE reason IS NULL) AS skipped_duplicate,
           count(DISTINCT {key}) FILTER (WHERE reason IS NOT NULL) AS quarantined
    FROM {cte}"""


define_cte("batch_stats", " UNION ALL ".join([
    _stats_sql("machines", "machines_classified", "machine_id"),
    _stats_sql("production_events", "events_classified", "event_id"),
    _stats_sql("quality_checks", "checks_classified", "check_id"),
    _stats_sql("maintenance_events", "maintenance_classified", "maintenance_id"),
]), ["machines_classified", "events_classified", "checks_classified", "maintenance_classified"])


def _json_sql(cols: list[str]) -> str:
    parts = []
    for i, c in enumerate(cols):
        sep = "{" if i == 0 else ","
        parts.append(f"'{sep}\"{c}\":' || coalesce(to_json({c}), 'null')")
    return " || ".join(parts) + " || '}'"


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def _text(spark, sf_dir):
    return B.text_tables(spark, sf_dir)


def machines_classified(spark, sf_dir) -> DataFrame:
    return G.classify_machines(_text(spark, sf_dir)["machines"])


def accepted_machine_ids(spark, sf_dir) -> DataFrame:
    return route_valid(machines_classified(spark, sf_dir)).select("machine_id")


def events_classified(spark, sf_dir) -> DataFrame:
    tx = _text(spark, sf_dir)
    return G.classify_production_events(tx["production_events"], accepted_machine_ids(spark, sf_dir))


def accepted_event_ids(spark, sf_dir) -> DataFrame:
    """Distinct ids of valid events (the event keys an empty store holds after the batch)."""
    return route_valid(events_classified(spark, sf_dir)).select("event_id").distinct()


def checks_classified(spark, sf_dir) -> DataFrame:
    return G.classify_quality_checks(_text(spark, sf_dir)["quality_checks"], accepted_event_ids(spark, sf_dir))


def maintenance_classified(spark, sf_dir) -> DataFrame:
    return G.classify_maintenance_events(_text(spark, sf_dir)["maintenance_events"],
                                         accepted_machine_ids(spark, sf_dir))


@register("validate_required", with_ctes("machines_text") + """
    SELECT machine_id,
           coalesce(machine_id, '') = '' OR coalesce(machine_name, '') = ''
           OR coalesce(install_date, '') = '' AS missing_required
    FROM machines_text""")
def q_validate_required(spark, sf_dir):
    m = _text(spark, sf_dir)["machines"]
    return m.select("machine_id", (is_blank("machine_id") | is_blank("machine_name")
                                   | is_blank("install_date")).alias("missing_required"))


@register("not_null_guard", with_ctes("machines_classified") + """
    SELECT machine_id, reason FROM machines_classified WHERE reason IS NOT NULL""")
def q_not_null_guard(spark, sf_dir):
    return route_quarantine(machines_classified(spark, sf_dir)).select(
        "machine_id", F.col("_reason").alias("reason"))


@register("validate_fk_machine", with_ctes("events_parsed") + """
    SELECT event_id, ord, fk_ok FROM events_parsed""")
def q_validate_fk_machine(spark, sf_dir):
    ev = _text(spark, sf_dir)["production_events"]
    return mark_known(ev, "machine_id", accepted_machine_ids(spark, sf_dir), "machine_id", "fk_ok").select(
        "event_id", F.col("_pos").cast("int").alias("ord"), "fk_ok")


@register("validate_fk_event", with_ctes("checks_classified") + """
    SELECT check_id, fk_ok FROM checks_classified""")
def q_validate_fk_event(spark, sf_dir):
    chk = _text(spark, sf_dir)["quality_checks"]
    return mark_known(chk, "production_event_id", accepted_event_ids(spark, sf_dir), "event_id",
                      "fk_ok").select("check_id", "fk_ok")


@register("parse_timestamp", with_ctes("events_parsed") + """
    SELECT event_id, ord, timestamp, parsed_ts FROM events_parsed""")
def q_parse_timestamp(spark, sf_dir):
    ev = _text(spark, sf_dir)["production_events"]
    return ev.select("event_id", F.col("_pos").cast("int").alias("ord"), "timestamp",
                     parse_timestamp("timestamp").alias("parsed_ts"))


@register("parse_quantity", with_ctes("events_parsed") + """
    SELECT event_id, ord, quantity_produced, parsed_quantity FROM events_parsed""")
def q_parse_quantity(spark, sf_dir):
    ev = _text(spark, sf_dir)["production_events"]
    return ev.select("event_id", F.col("_pos").cast("int").alias("ord"), "quantity_produced",
                     parse_quantity("quantity_produced").alias("parsed_quantity"))


@register("validate_positive", with_ctes("events_classified") + """
    SELECT event_id, ord, nonpositive FROM events_classified""")
def q_validate_positive(spark, sf_dir):
    ev = _text(spark, sf_dir)["production_events"]
    return ev.select("event_id", F.col("_pos").cast("int").alias("ord"),
                     quantity_is_nonpositive("quantity_produced").alias("nonpositive"))


@register("quarantine_reason", with_ctes("events_classified") + """
    SELECT event_id, ord, reason FROM events_classified""")
def q_quarantine_reason(spark, sf_dir):
    return events_classified(spark, sf_dir).select(
        "event_id", F.col("_pos").cast("int").alias("ord"), F.col("_reason").alias("reason"))


@register("route_valid", with_ctes("events_classified") + """
    SELECT event_id, machine_id, parsed_ts AS event_timestamp, product_code,
           CAST(parsed_quantity AS INTEGER) AS quantity_produced, unit, shift, ord
    FROM events_classified WHERE reason IS NULL""")
def q_route_valid(spark, sf_dir):
    return route_valid(events_classified(spark, sf_dir)).select(
        *G.typed_columns("production_events"), F.col("_pos").cast("int").alias("ord"))


@register("route_quarantine", with_ctes("events_classified") + """
    SELECT event_id, ord, reason FROM events_classified WHERE reason IS NOT NULL""")
def q_route_quarantine(spark, sf_dir):
    return route_quarantine(events_classified(spark, sf_dir)).select(
        "event_id", F.col("_pos").cast("int").alias("ord"), F.col("_reason").alias("reason"))


@register("normalize_empty", with_ctes("checks_text") + """
    SELECT check_id, nullif(defect_type, '') AS defect_type, nullif(inspector_id, '') AS inspector_id
    FROM checks_text""")
def q_normalize_empty(spark, sf_dir):
    chk = _text(spark, sf_dir)["quality_checks"]
    return normalize_empty(chk, ["defect_type", "inspector_id"]).select("check_id", "defect_type", "inspector_id")


_EV_COLS = C.CSV_COLUMNS["production_events"]


@register("row_reference", with_ctes("dirty_production_events") + f"""
    SELECT event_id, ord,
           'hash:' || substr(sha256({_json_sql(sorted(_EV_COLS))}), 1, 16) AS content_reference,
           coalesce(nullif(event_id, ''), 'hash:' || substr(sha256({_json_sql(sorted(_EV_COLS))}), 1, 16))
               AS row_reference
    FROM dirty_production_events""")
def q_row_reference(spark, sf_dir):
    ev = _text(spark, sf_dir)["production_events"]
    return ev.select("event_id", F.col("_pos").cast("int").alias("ord"),
                     row_reference(None, _EV_COLS).alias("content_reference"),
                     row_reference("event_id", _EV_COLS).alias("row_reference"))


@register("quarantine_json", with_ctes("events_classified") + f"""
    SELECT event_id, ord, reason, {_json_sql(_EV_COLS)} AS raw_data
    FROM events_classified WHERE reason IS NOT NULL""")
def q_quarantine_json(spark, sf_dir):
    return route_quarantine(events_classified(spark, sf_dir)).select(
        "event_id", F.col("_pos").cast("int").alias("ord"), F.col("_reason").alias("reason"),
        row_json(_EV_COLS).alias("raw_data"))


@register("dedup_first_wins", with_ctes("events_classified") + """
    SELECT event_id, ord, CAST(parsed_quantity AS INTEGER) AS quantity_produced
    FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ord) AS rn
          FROM events_classified WHERE reason IS NULL) WHERE rn = 1""")
def q_dedup_first_wins(spark, sf_dir):
    first = first_per_key(route_valid(events_classified(spark, sf_dir)), ["event_id"], G.ORDER_COLS)
    return first.select("event_id", F.col("_pos").cast("int").alias("ord"),
                        F.col("_qty").cast("int").alias("quantity_produced"))


@register("quarantine_dedup", with_ctes("events_classified") + """
    SELECT event_id AS row_reference, reason, ord
    FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ord) AS rn
          FROM events_classified WHERE reason IS NOT NULL) WHERE rn = 1""")
def q_quarantine_dedup(spark, sf_dir):
    rej = G.quarantine_rows(route_quarantine(events_classified(spark, sf_dir)), "production_events",
                            FIXED_SOURCE, FIXED_BATCH, FIXED_LOADED_AT)
    return first_per_key(rej, ["row_reference"], G.ORDER_COLS).select(
        "row_reference", "reason", F.col("_pos").cast("int").alias("ord"))


_HISTORY_SQL = """(SELECT event_id FROM production_events
                    WHERE event_timestamp < TIMESTAMP '2024-01-15 00:00:00')"""


def _history_events(spark, sf_dir) -> DataFrame:
    """Events stored by an earlier batch: the clean binding up to the cut-off time."""
    return B.production_events(spark, sf_dir).filter(F.col("event_timestamp") < ntz_lit(HISTORY_CUTOFF))


def _new_events(spark, sf_dir) -> DataFrame:
    first = first_per_key(route_valid(events_classified(spark, sf_dir)), ["event_id"], G.ORDER_COLS)
    return insert_if_absent(first, _history_events(spark, sf_dir).select("event_id"), ["event_id"])


@register("insert_if_absent", with_ctes("events_classified", "production_events") + f"""
    SELECT DISTINCT event_id FROM events_classified
    WHERE reason IS NULL AND event_id NOT IN {_HISTORY_SQL}""")
def q_insert_if_absent(spark, sf_dir):
    return _new_events(spark, sf_dir).select("event_id")


@register("append_union", with_ctes("events_classified", "production_events") + f"""
    SELECT event_id, event_timestamp, 'history' AS origin FROM production_events
    WHERE event_timestamp < TIMESTAMP '2024-01-15 00:00:00'
    UNION ALL
    SELECT event_id, parsed_ts, 'batch' FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ord) AS rn
        FROM events_classified WHERE reason IS NULL) f
    WHERE rn = 1 AND event_id NOT IN {_HISTORY_SQL}""")
def q_append_union(spark, sf_dir):
    hist = _history_events(spark, sf_dir).select("event_id", "event_timestamp", F.lit("history").alias("origin"))
    new = _new_events(spark, sf_dir).select("event_id", F.col("_ts").alias("event_timestamp"),
                                            F.lit("batch").alias("origin"))
    return append_union(hist, new)


@register("stamp_lineage", with_ctes("events_classified") + f"""
    SELECT DISTINCT event_id, '{FIXED_SOURCE}' AS source_file, '{FIXED_BATCH}' AS batch_id,
           TIMESTAMP '2026-01-02 00:00:00' AS ingested_at
    FROM events_classified WHERE reason IS NULL""")
def q_stamp_lineage(spark, sf_dir):
    first = first_per_key(route_valid(events_classified(spark, sf_dir)), ["event_id"], G.ORDER_COLS)
    return G.stamp_lineage(first.select("event_id"), FIXED_SOURCE, FIXED_BATCH, FIXED_LOADED_AT)


def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dry run: the counters an ingest of the text batch into an empty store reports,
    computed without writing anything.

    Per table one grouping on (key, valid): valid rows are keyed by their primary key,
    rejected rows by their quarantine reference.  The grouping combines map-side, so a
    key repeated many times reaches the shuffle once per map task, and no Expand
    (as two DISTINCT aggregates would plan) doubles the rows."""
    text, parts = _text(spark, sf_dir), []
    ok = F.col("_reason").isNull()

    def keyed(table: str, df: DataFrame) -> DataFrame:
        """_k (key or quarantine reference) and _ok of every row."""
        pk = C.PRIMARY_KEY[table]
        return df.select(F.when(ok, F.col(pk)).otherwise(row_reference(pk, C.CSV_COLUMNS[table])).alias("_k"), ok.alias("_ok"))

    # parents are classified once, and only their keys and verdicts are kept; the accepted keys serve every child
    machines = keyed("machines", G.classify_machines(text["machines"])).checkpoint()
    known_machines = machines.where("_ok").select(F.col("_k").alias("machine_id"))
    events = keyed("production_events", G.classify_production_events(text["production_events"], known_machines)).checkpoint()
    known_events = events.where("_ok").select(F.col("_k").alias("event_id")).distinct()
    for table, keys in [("machines", machines), ("production_events", events),
                        ("quality_checks", keyed("quality_checks", G.classify_quality_checks(text["quality_checks"], known_events))),
                        ("maintenance_events", keyed("maintenance_events", G.classify_maintenance_events(text["maintenance_events"], known_machines)))]:
        per_key = keys.groupBy("_k", "_ok").agg(F.count(F.lit(1)).alias("_rows"))
        known = F.col("_k").isNotNull()
        agg = per_key.agg(
            F.count_if(F.col("_ok") & known).alias("inserted"),
            F.coalesce(F.sum(F.when(F.col("_ok"), F.col("_rows"))), F.lit(0)).alias("valid"),
            F.count_if(~F.col("_ok") & known).alias("quarantined"),
        )
        parts.append(agg.select(F.lit(table).alias("table_name"), "inserted",
                                (F.col("valid") - F.col("inserted")).alias("skipped_duplicate"),
                                "quarantined"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("ingest_stats", with_ctes("batch_stats") + "SELECT * FROM batch_stats")
def q_ingest_stats(spark, sf_dir):
    return batch_stats(spark, sf_dir)


@register("run_log", with_ctes("batch_stats") + f"""
    SELECT table_name,
           '{{"event":"table_ingested","table":"' || table_name || '","batch_id":"{FIXED_BATCH}","inserted":'
           || inserted || ',"skipped_duplicate":' || skipped_duplicate || ',"quarantined":' || quarantined
           || '}}' AS event_json
    FROM batch_stats""")
def q_run_log(spark, sf_dir):
    return G.run_log(batch_stats(spark, sf_dir), FIXED_BATCH, FIXED_SOURCE, FIXED_LOADED_AT).select(
        "table_name", "event_json")


def _ingest_into(spark, sf_dir, store) -> DataFrame:
    return G.ingest_dataset(store, _text(spark, sf_dir), FIXED_SOURCE)


@register("ingest_dataset", with_ctes("batch_stats") + "SELECT * FROM batch_stats")
def q_ingest_dataset(spark, sf_dir):
    """Full ingest of the four tables into a fresh store under the shared checkpoint folder."""
    store = TableStore(spark, scratch_path(spark, "ingest"))
    stats = _ingest_into(spark, sf_dir, store)
    drop_scratch(spark, store.root)
    return stats


@register("ingest_rerun", with_ctes("batch_stats") + """
    SELECT table_name, CAST(0 AS BIGINT) AS inserted, inserted + skipped_duplicate AS skipped_duplicate,
           CAST(0 AS BIGINT) AS quarantined
    FROM batch_stats""")
def q_ingest_rerun(spark, sf_dir):
    """The same batch ingested twice: the second run inserts and quarantines nothing."""
    store = TableStore(spark, scratch_path(spark, "ingest-rerun"))
    _ingest_into(spark, sf_dir, store)
    stats = _ingest_into(spark, sf_dir, store)
    drop_scratch(spark, store.root)
    return stats


# J4 / J5: membership as semi- and anti-joins over the clean bindings
@register("semi_known_machine", with_ctes("dirty_production_events", "accepted_machines") + """
    SELECT event_id, ord FROM dirty_production_events
    WHERE machine_id IN (SELECT machine_id FROM accepted_machines)""")
def q_semi_known_machine(spark, sf_dir):
    ev = _text(spark, sf_dir)["production_events"]
    return ev.join(accepted_machine_ids(spark, sf_dir), "machine_id", "left_semi").select(
        "event_id", F.col("_pos").cast("int").alias("ord"))


@register("semi_known_event", with_ctes("quality_checks", "production_events") + """
    SELECT check_id FROM quality_checks
    WHERE production_event_id IN (SELECT event_id FROM production_events)""")
def q_semi_known_event(spark, sf_dir):
    return B.quality_checks(spark, sf_dir).join(
        B.production_events(spark, sf_dir).select(F.col("event_id").alias("production_event_id")),
        "production_event_id", "left_semi").select("check_id")


@register("anti_existing", with_ctes("quality_checks", "production_events") + """
    SELECT check_id, production_event_id FROM quality_checks
    WHERE production_event_id NOT IN (SELECT event_id FROM production_events)""")
def q_anti_existing(spark, sf_dir):
    return B.quality_checks(spark, sf_dir).join(
        B.production_events(spark, sf_dir).select(F.col("event_id").alias("production_event_id")),
        "production_event_id", "left_anti").select("check_id", "production_event_id")
