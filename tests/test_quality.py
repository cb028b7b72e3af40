import random

import pytest

from forgeline.operators import quality as Q
from forgeline.plans.tests_suite import SUITE


def test_suite_shape():
    kinds = [t.kind for t in SUITE]
    assert len(SUITE) == 48
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("relationships"),
            kinds.count("accepted_values"), kinds.count("singular")) == (13, 25, 6, 2, 2)


def test_generic_tests_find_planted_violations(spark):
    child = spark.createDataFrame([("a", "p1", "units"), ("a", "p2", "kg"), ("b", None, "pcs"), (None, "p9", None)],
                                  "id string, parent string, unit string")
    parent = spark.createDataFrame([("p1",), ("p2",)], "pid string")
    assert [tuple(r) for r in Q.dq_unique(child, "id").collect()] == [("a", 2)]
    assert Q.dq_not_null(child, "id").count() == 1
    assert [r["parent"] for r in Q.dq_relationships(child, "parent", parent, "pid").collect()] == ["p9"]
    assert [r["unit"] for r in Q.dq_accepted_values(child, "unit", ["units", "kg"]).collect()] == ["pcs"]


def test_singular_assertions(spark):
    mart = spark.createDataFrame([("d1", "M1", 1.5, 10), ("d2", "M1", None, 0), ("d3", "M2", 0.5, 5)],
                                 "production_day_id string, machine_id string, defect_rate double, total_quantity long")
    assert [r[0] for r in Q.dq_defect_rate_bounds(mart).collect()] == ["d1"]
    assert [r[0] for r in Q.dq_positive_total(mart).collect()] == ["d2"]


def test_report_and_gate(spark):
    t = spark.createDataFrame([("a", "x"), ("a", None)], "id string, v string")
    tests = [Q.DQTest("unique", "t", "id"), Q.DQTest("not_null", "t", "v"),
             Q.DQTest("not_null", "t", "id", severity="warn"),
             Q.DQTest("accepted_values", "t", "v", values=("x",))]
    rep = {r["test_name"]: r["violations"] for r in Q.dq_report(tests, {"t": t}).collect()}
    assert rep == {"unique_t_id": 1, "not_null_t_v": 1, "not_null_t_id": 0, "accepted_values_t_v": 0}
    gate = Q.dq_gate(Q.dq_report(tests, {"t": t})).first()
    assert (gate["tests_run"], gate["failed_error_tests"], gate["gate_passed"]) == (4, 2, False)
    with pytest.raises(Q.QualityGateError):
        Q.enforce_gate(Q.dq_report(tests, {"t": t}))
    ok = Q.enforce_gate(Q.dq_report(tests[2:], {"t": t})).first()
    assert ok["gate_passed"]


def test_report_equals_the_single_tests(spark):
    """Columns tied by relationships in a chain, values with a third of the rows, parents that are missing, null, or repeated."""
    rng = random.Random(4)
    pick = lambda n: rng.choice([None, "hot", "hot", *(f"k{i}" for i in range(n))])
    frames = {"a": [(pick(30), rng.choice(["x", "y", None]), 1) for _ in range(200)], "b": [(pick(40), pick(35), 2) for _ in range(300)], "c": [(pick(60), pick(20), 3) for _ in range(100)], "none": []}
    relations = {n: spark.createDataFrame(rows, "k string, v string, total_quantity int") for n, rows in frames.items()}
    tests = [Q.DQTest("unique", "a", "k"), Q.DQTest("unique", "b", "v"), Q.DQTest("unique", "none", "k"), Q.DQTest("relationships", "b", "k", to="a", field="k"),
             Q.DQTest("relationships", "c", "k", to="b", field="k"), Q.DQTest("relationships", "c", "v", to="b", field="v"), Q.DQTest("relationships", "a", "v", to="none", field="k"),
             Q.DQTest("not_null", "b", "k"), Q.DQTest("accepted_values", "a", "v", values=("x",)), Q.DQTest("not_null", "none", "k"),
             Q.DQTest("singular", "c", None, name_override="assert_positive_total_quantity")]
    got = {r["test_name"]: r["violations"] for r in Q.dq_report(tests, relations).collect()}
    for t in tests:
        df = relations[t.relation]
        single = {"unique": lambda: Q.dq_unique(df, t.column).count(), "not_null": lambda: Q.dq_not_null(df, t.column).count(),
                  "relationships": lambda: Q.dq_relationships(df, t.column, relations[t.to].dropDuplicates([t.field]), t.field).count(),
                  "accepted_values": lambda: Q.dq_accepted_values(df, t.column, list(t.values)).count(), "singular": lambda: Q.dq_positive_total(df.selectExpr("*", "k AS production_day_id", "v AS machine_id")).count()}
        assert got[t.name] == single[t.kind](), t.name
    assert len(got) == len(tests) and sum(got.values()) > 100


def test_report_plans_one_exchange_of_values(spark, tmp_path):
    """Over stored relations: the stacked values are exchanged once, however many tests there are."""
    for name in ("a", "b", "c"):
        spark.range(100).selectExpr("cast(id AS string) AS k", "cast(id % 7 AS string) AS v").write.parquet(str(tmp_path / name))
    relations = {n: spark.read.parquet(str(tmp_path / n)) for n in ("a", "b", "c")}
    tests = [Q.DQTest(kind, r, c, to="a", field="k", values=("1",)) for r in "abc" for c in "kv" for kind in ("unique", "not_null", "accepted_values", "relationships") if (r, c) != ("a", "k") or kind == "unique"]
    report = Q.dq_report(tests, relations)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert first.count("Exchange hashpartitioning") == 2 and first.count("FileScan") == 3  # the values, and a row for a domain
