"""Query catalog machinery: registration, rounding, oracle CTE assembly.

Every query reads the driver tables of ``sf_dir`` in full through the bindings in
``forgeline.sources.bindings``; the oracle SQL derives the same relations from the
same tables.  Output columns carry identical names on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.sources import bindings as B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Round floating columns for order-insensitive value comparison."""
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# Oracle SQL building blocks
# ---------------------------------------------------------------------------
STG_SQL = {
    "stg_machines": "SELECT machine_id, machine_name, machine_type, install_date, ingested_at FROM machines",
    "stg_production_events": """
        SELECT event_id, machine_id, event_timestamp, CAST(event_timestamp AS DATE) AS production_date,
               product_code, quantity_produced, unit, unit <> 'units' AS has_unit_inconsistency,
               shift, ingested_at
        FROM production_events""",
    "stg_quality_checks": """
        SELECT check_id, production_event_id, check_timestamp, result, defect_type, inspector_id,
               inspector_id IS NULL AS is_missing_inspector, ingested_at
        FROM quality_checks""",
    "stg_maintenance_events": """
        SELECT maintenance_id, machine_id, start_time, end_time,
               datediff('microsecond', start_time, end_time) / 3600000000.0 AS duration_hours,
               maintenance_type, technician_id, ingested_at
        FROM maintenance_events""",
}

MODEL_SQL = {
    "newest_check": """
        SELECT production_event_id, n_checks, c.check_id, c.check_timestamp, c.result, c.defect_type
        FROM (SELECT production_event_id, count(*) AS n_checks,
                     list({'check_id': check_id, 'check_timestamp': check_timestamp, 'result': result, 'defect_type': defect_type}
                          ORDER BY check_timestamp DESC, check_id DESC)[1] AS c
              FROM stg_quality_checks GROUP BY production_event_id)""",
    "int_production_enriched": """
        SELECT p.event_id, p.machine_id, m.machine_type, p.production_date, p.product_code,
               p.quantity_produced, p.unit, p.has_unit_inconsistency, p.shift, q.check_id,
               q.result AS quality_result, q.defect_type,
               coalesce(q.n_checks, 0) > 1 AS has_duplicate_quality_checks
        FROM stg_production_events p
        LEFT JOIN stg_machines m ON p.machine_id = m.machine_id
        LEFT JOIN newest_check q
               ON q.production_event_id = p.event_id""",
    "int_daily_machine_summary": """
        SELECT machine_id || '_' || CAST(production_date AS VARCHAR) AS machine_day_key,
               machine_id, machine_type, production_date,
               count(*) AS event_count,
               CAST(sum(quantity_produced) AS BIGINT) AS total_quantity,
               count(check_id) AS checked_count,
               count(*) FILTER (WHERE quality_result = 'fail') AS fail_count,
               count(*) FILTER (WHERE has_unit_inconsistency) AS unit_inconsistency_count
        FROM int_production_enriched
        GROUP BY 1, 2, 3, 4""",
    "mart_production_daily": """
        SELECT machine_day_key AS production_day_id, machine_id, machine_type, production_date,
               event_count, total_quantity, checked_count, fail_count,
               CASE WHEN checked_count > 0
                    THEN CAST((fail_count * 20000 + checked_count) // (2 * checked_count) AS DOUBLE) / 10000
               END AS defect_rate,
               unit_inconsistency_count
        FROM int_daily_machine_summary""",
    "mart_quality_summary": """
        SELECT product_code,
               count(check_id) AS total_checks,
               count(*) FILTER (WHERE quality_result = 'pass') AS pass_count,
               count(*) FILTER (WHERE quality_result = 'fail') AS fail_count,
               CASE WHEN count(check_id) > 0 THEN
                    CAST((count(*) FILTER (WHERE quality_result = 'fail') * 20000 + count(check_id))
                         // (2 * count(check_id)) AS DOUBLE) / 10000 END AS defect_rate,
               count(*) FILTER (WHERE defect_type = 'dimension') AS defect_dimension_count,
               count(*) FILTER (WHERE defect_type = 'surface_finish') AS defect_surface_finish_count,
               count(*) FILTER (WHERE defect_type = 'assembly') AS defect_assembly_count,
               count(*) FILTER (WHERE defect_type = 'material') AS defect_material_count
        FROM int_production_enriched
        GROUP BY 1""",
    "mart_machine_downtime": """
        SELECT m.machine_id, m.machine_name, m.machine_type,
               count(x.maintenance_id) AS maintenance_event_count,
               coalesce(sum(x.duration_hours), 0) AS total_downtime_hours,
               max(x.end_time) AS last_maintenance_end
        FROM stg_machines m
        LEFT JOIN stg_maintenance_events x ON m.machine_id = x.machine_id
        GROUP BY 1, 2, 3""",
}

# dependency order of every CTE the oracle may use
_CTE_ORDER = ["machines", "production_events", "quality_checks", "maintenance_events",
              "dirty_production_events",
              "stg_machines", "stg_production_events", "stg_quality_checks", "stg_maintenance_events",
              "newest_check", "int_production_enriched", "int_daily_machine_summary",
              "mart_production_daily", "mart_quality_summary", "mart_machine_downtime"]
_CTE_DEPS = {
    "stg_machines": ["machines"], "stg_production_events": ["production_events"],
    "stg_quality_checks": ["quality_checks"], "stg_maintenance_events": ["maintenance_events"],
    "newest_check": ["stg_quality_checks"],
    "int_production_enriched": ["stg_production_events", "stg_machines", "newest_check"],
    "int_daily_machine_summary": ["int_production_enriched"],
    "mart_production_daily": ["int_daily_machine_summary"],
    "mart_quality_summary": ["int_production_enriched"],
    "mart_machine_downtime": ["stg_machines", "stg_maintenance_events"],
}
_CTE_BODY = {**B.SQL, **STG_SQL, **MODEL_SQL}


def define_cte(name: str, body: str, deps: list[str]) -> None:
    """Add an oracle CTE (after everything defined so far)."""
    _CTE_ORDER.append(name)
    _CTE_DEPS[name] = list(deps)
    _CTE_BODY[name] = body


for _n in ["machines_text", "checks_text", "maintenance_text"]:
    _CTE_ORDER.insert(_CTE_ORDER.index("dirty_production_events") + 1, _n)
_CTE_DEPS["checks_text"] = ["quality_checks"]
_CTE_DEPS["maintenance_text"] = ["maintenance_events"]


def with_ctes(*names: str, extra: str = "") -> str:
    """WITH clause holding ``names`` and everything they depend on."""
    need: set[str] = set()

    def add(n):
        if n in need:
            return
        need.add(n)
        for d in _CTE_DEPS.get(n, []):
            add(d)
    for n in names:
        add(n)
    parts = [f"{n} AS ({_CTE_BODY[n]})" for n in _CTE_ORDER if n in need]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


