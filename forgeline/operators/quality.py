"""Declarative data-quality tests.  Each test returns the offending rows (empty = pass);
``dq_report`` runs a whole suite and counts violations per test in one Spark job and one exchange of values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values occurring more than once, with their count (partial aggregate)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def dq_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no match in ``parent_column``."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def dq_relationships_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row: number of child rows whose non-NULL ``column`` has no parent.

    Child values are counted per value before the anti-join (partial aggregate), so a
    foreign-key value shared by a large share of the rows reaches the join as one row
    per map task, and the join shuffles distinct values instead of child rows."""
    per_value = (child.select(column).filter(F.col(column).isNotNull())
                 .groupBy(column).agg(F.count(F.lit(1)).alias("_n")))
    keys = parent.select(F.col(parent_column).alias(column))
    return (per_value.join(keys, column, "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations")))


def dq_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value lies outside ``values``; NULL passes."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))


def _rate_out_of_bounds():
    return F.col("defect_rate").isNotNull() & ((F.col("defect_rate") < 0) | (F.col("defect_rate") > 1))


def _no_total():
    return F.col("total_quantity") <= 0


def dq_defect_rate_bounds(mart: DataFrame) -> DataFrame:
    return mart.filter(_rate_out_of_bounds()).select("production_day_id", "machine_id", "defect_rate")


def dq_positive_total(mart: DataFrame) -> DataFrame:
    return mart.filter(_no_total()).select("production_day_id", "machine_id", "total_quantity")


@dataclass(frozen=True)
class DQTest:
    kind: str                 # unique | not_null | relationships | accepted_values | singular
    relation: str
    column: str | None = None
    severity: str = "error"
    tags: tuple = ()
    to: str | None = None     # relationships: parent relation
    field: str | None = None  # relationships: parent column
    values: tuple = ()        # accepted_values
    name_override: str | None = None

    @property
    def name(self) -> str:
        return self.name_override or f"{self.kind}_{self.relation}_{self.column}"


REPORT_SCHEMA = T.StructType([
    T.StructField("test_name", T.StringType(), False),
    T.StructField("test_type", T.StringType(), False),
    T.StructField("relation", T.StringType(), False),
    T.StructField("column_name", T.StringType(), True),
    T.StructField("severity", T.StringType(), False),
    T.StructField("tags", T.StringType(), False),
    T.StructField("violations", T.LongType(), False),
])

#: The rows that violate a singular assertion.
SINGULAR = {
    "assert_defect_rate_within_bounds": _rate_out_of_bounds,
    "assert_positive_total_quantity": _no_total,
}


def _violates(t: DQTest):
    """Does a row violate a test that looks at one row at a time?"""
    if t.kind == "singular":
        return SINGULAR[t.name]()
    c = F.col(t.column)
    return c.isNull() if t.kind == "not_null" else c.isNotNull() & ~c.isin(list(t.values))


def _domains(tests: list[DQTest]) -> list[list[tuple[str, str]]]:
    """The key columns (relation, column) of the unique and relationship tests; columns that a relationship ties share a list."""
    domain: dict[tuple[str, str], list] = {}
    for t in tests:
        if t.kind in ("unique", "relationships"):
            own = domain.setdefault((t.relation, t.column), [(t.relation, t.column)])
            if t.kind == "relationships":
                other = domain.setdefault((t.to, t.field), [(t.to, t.field)])
                if own is not other:
                    own += other
                    domain |= dict.fromkeys(other, own)
    return list({id(d): d for d in domain.values()}.values())


def dq_report(tests: list[DQTest], relations: dict[str, DataFrame]) -> DataFrame:
    """Violation count per test, as one DataFrame (one Spark job).

    Every relation is read once and stacked into rows (domain, value, place): a row for each value of a key column, and one for
    each violation of a test that looks at one row at a time.  Key columns that relationships tie form a domain, in which each
    has a place.  One aggregate over all relations counts a domain's values by place, combined before it is shuffled, so a value
    that a large share of the rows has is one row of each task.  A value with a count over 1 violates the uniqueness of its
    place, and the rows of a child's place violate a relationship where the parent's place has none."""
    domains = _domains(tests)
    place = {column: (d, i) for d, columns in enumerate(domains) for i, column in enumerate(columns)}
    stacks: dict[str, list] = {}
    row = lambda domain, value, at: F.struct(F.lit(domain).alias("domain"), value.cast("string").alias("value"), F.lit(at).alias("place"))
    for (relation, column), (d, i) in place.items():
        stacks.setdefault(relation, []).append(F.when(F.col(column).isNotNull(), row(d, F.col(column), i)))
    per_domain: list[tuple[int, int, str]] = []  # domain, test, its violations among the domain's values
    for t, test in enumerate(tests):
        d = len(domains) + t
        if test.kind in ("unique", "relationships"):
            d, i = place[test.relation, test.column]
            per_domain.append((d, t, f"count_if(n{i} > 1)" if test.kind == "unique" else f"sum(if(n{place[test.to, test.field][1]} = 0, n{i}, 0))"))
        else:
            stacks.setdefault(test.relation, []).append(F.when(_violates(test), row(d, F.lit(None), 0)))
            per_domain.append((d, t, "sum(n0)"))
    stacked = None
    for relation, entries in stacks.items():
        part = relations[relation].select(F.explode(F.array(*entries)).alias("x")).where("x IS NOT NULL").select("x.*")
        stacked = part if stacked is None else stacked.unionByName(part)
    places = range(max([len(d) for d in domains], default=1))
    values = stacked.groupBy("domain", "value").agg(*(F.count_if(F.col("place") == i).alias(f"n{i}") for i in places))
    measures = sorted({m for _, _, m in per_domain})
    counts = values.groupBy("domain").agg(*(F.expr(m).alias(f"m{i}") for i, m in enumerate(measures)))
    found = F.array(*(F.struct(F.lit(d).alias("of"), F.lit(t).alias("test"), F.col(f"m{measures.index(m)}").alias("violations")) for d, t, m in per_domain))
    by_test = counts.select(F.explode(F.filter(found, lambda x: x["of"] == F.col("domain"))).alias("x")).select("x.test", "x.violations")
    meta = relations[tests[0].relation].sparkSession.createDataFrame(
        [(i, t.name, t.kind, t.relation, t.column, t.severity, ",".join(t.tags)) for i, t in enumerate(tests)],
        "test int, test_name string, test_type string, relation string, column_name string, severity string, tags string")
    return (meta.join(F.broadcast(by_test), "test", "left")  # a row for a test
            .select(*(F.col(f.name) if f.name != "violations" else F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations") for f in REPORT_SCHEMA.fields)))


def dq_gate(report: DataFrame) -> DataFrame:
    """One row: tests run, failing error-severity tests, and whether later stages may run."""
    failing = (F.col("severity") == "error") & (F.col("violations") > 0)
    return report.agg(
        F.count(F.lit(1)).alias("tests_run"),
        F.count_if(failing).alias("failed_error_tests"),
        F.count_if((F.col("severity") != "error") & (F.col("violations") > 0)).alias("warnings"),
    ).withColumn("gate_passed", F.col("failed_error_tests") == 0)


class QualityGateError(RuntimeError):
    pass


def enforce_gate(report: DataFrame) -> DataFrame:
    """Raise when an error-severity test failed; otherwise return the gate row."""
    gate = dq_gate(report)
    row = gate.first()
    if not row["gate_passed"]:
        failed = [r["test_name"] for r in report.filter(
            (F.col("severity") == "error") & (F.col("violations") > 0)).select("test_name").collect()]
        raise QualityGateError(f"{row['failed_error_tests']} data test(s) failed: {failed}")
    return gate
