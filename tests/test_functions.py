import datetime as dt
from decimal import Decimal

from forgeline.functions import (
    defect_rate,
    duration_hours,
    machine_day_key,
    parse_quantity,
    parse_timestamp,
    quantity_is_integer,
    quantity_is_nonpositive,
    row_reference,
    safe_ratio,
)

TS_CASES = [
    ("2026-01-01T07:14:00", dt.datetime(2026, 1, 1, 7, 14)),
    ("2026-01-01 07:14:00", dt.datetime(2026, 1, 1, 7, 14)),
    ("2026-01-01", dt.datetime(2026, 1, 1)),
    ("2026-01-01T07", dt.datetime(2026, 1, 1, 7)),
    ("2026-01-01T07:14:09.5", dt.datetime(2026, 1, 1, 7, 14, 9, 500000)),
    ("2026-01-01T01:00:00+02:00", dt.datetime(2025, 12, 31, 23)),
    ("2026-01-01T07:00:00Z", dt.datetime(2026, 1, 1, 7)),
    ("20260101", dt.datetime(2026, 1, 1)),
    ("20260101T071400", dt.datetime(2026, 1, 1, 7, 14)),
    ("2000-01-01T00:00:00", dt.datetime(2000, 1, 1)),
    ("1999-12-31T23:59:59", None),          # year before 2000: corrupted
    ("1900-01-01T07:14:00", None),
    ("not-a-date", None),
    ("", None),
    (None, None),
    ("2026", None),                          # reduced precision rejected
    ("2026-01", None),
    ("2026-1-1", None),
    (" 2026-01-01", None),                   # padded text rejected
    ("12026-01-01", None),
    ("2026-02-30T00:00:00", None),
    ("2026-01-01T24:00:00", None),
]


def test_parse_timestamp(spark):
    df = spark.createDataFrame([(s,) for s, _ in TS_CASES], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert got == [e for _, e in TS_CASES]


def test_parse_timestamp_independent_of_session_zone(spark):
    df = spark.createDataFrame([("2026-01-01T01:00:00+02:00",), ("2026-01-01T05:00:00",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2025, 12, 31, 23), dt.datetime(2026, 1, 1, 5)]


QTY_CASES = [
    ("42", True, Decimal(42), False),
    (" 42 ", True, Decimal(42), False),
    ("+5", True, Decimal(5), False),
    ("1_000", True, Decimal(1000), False),
    ("0", True, Decimal(0), True),
    ("-1", True, Decimal(-1), True),
    ("-0", True, Decimal(0), True),
    ("429.5", False, None, False),
    ("1e3", False, None, False),
    ("", False, None, False),
    ("n/a", False, None, False),
    (None, False, None, False),
    ("-" + "9" * 50, True, None, True),     # too long for DECIMAL(38,0), still negative
]


def test_parse_quantity(spark):
    df = spark.createDataFrame([(q,) for q, *_ in QTY_CASES], "q string")
    rows = df.select(quantity_is_integer("q"), parse_quantity("q"), quantity_is_nonpositive("q")).collect()
    for (q, ok, val, nonpos), r in zip(QTY_CASES, rows):
        assert (r[0], r[1], r[2]) == (ok, val, nonpos), q


def test_defect_rate_half_up_and_null_when_unchecked(spark):
    df = spark.createDataFrame([(1, 16), (1, 8), (0, 0), (3, 17), (1, 3), (2, 3), (5, 8)], "f long, c long")
    got = [r[0] for r in df.select(defect_rate("f", "c")).collect()]
    assert got == [0.0625, 0.125, None, 0.1765, 0.3333, 0.6667, 0.625]


def test_defect_rate_exact_for_all_small_counts(spark):
    from fractions import Fraction

    pairs = [(f, c) for c in range(1, 120) for f in range(0, c + 1)]
    df = spark.createDataFrame(pairs, "f long, c long")
    got = [r[0] for r in df.select(defect_rate("f", "c")).collect()]
    for (f, c), g in zip(pairs, got):
        want = float(int(Fraction(f, c) * 10000 + Fraction(1, 2))) / 10000
        assert g == want, (f, c)


def test_safe_ratio_zero_when_unchecked(spark):
    df = spark.createDataFrame([(0, 0), (1, 4)], "f long, c long")
    assert [r[0] for r in df.select(safe_ratio("f", "c")).collect()] == [0.0, 0.25]


def test_machine_day_key_null_propagates(spark):
    df = spark.createDataFrame([("M1", dt.date(2026, 1, 2)), (None, dt.date(2026, 1, 2))], "m string, d date")
    assert [r[0] for r in df.select(machine_day_key("m", "d")).collect()] == ["M1_2026-01-02", None]


def test_duration_hours_exact_and_signed(spark):
    rows = [(dt.datetime(2026, 1, 1, 0), dt.datetime(2026, 1, 1, 2, 30)),
            (dt.datetime(2026, 1, 1, 2), dt.datetime(2026, 1, 1, 1)),
            (dt.datetime(2026, 1, 1, 0), dt.datetime(2026, 1, 1, 0, 0, 0, 360000))]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    assert [r[0] for r in df.select(duration_hours("s", "e")).collect()] == [2.5, -1.0, 0.0001]


def test_row_reference_natural_id_or_content_hash(spark):
    df = spark.createDataFrame([("E1", "a"), ("", "a"), (None, "a"), ("", "b")], "id string, x string")
    refs = [r[0] for r in df.select(row_reference("id", ["id", "x"])).collect()]
    assert refs[0] == "E1"
    assert refs[1].startswith("hash:") and len(refs[1]) == 21
    assert refs[1] != refs[2]  # '' and NULL are different rows
    assert refs[1] != refs[3]
    again = [r[0] for r in df.select(row_reference("id", ["x", "id"])).collect()]
    assert again == refs     # key order does not matter


def _python_rule(value):
    """The original rule: datetime.fromisoformat, then the written year must be >= 2000;
    an offset is normalized to UTC wall-clock time (the stored column has no zone)."""
    try:
        ts = dt.datetime.fromisoformat(value)
    except (ValueError, TypeError):
        return None
    if ts.year < 2000:
        return None
    if ts.tzinfo is not None:
        ts = ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return ts


def test_parse_timestamp_matches_python_on_generated_forms(spark):
    dates = ["2026-01-15", "2000-01-01", "1999-12-31", "1900-06-01", "2026-02-29", "2024-02-29",
             "2026-13-01", "2026-00-10", "2026-1-15", "12026-01-15", "2026-01", "2026"]
    seps = ["T", " ", "x", "+"]
    times = ["", "10", "10:30", "10:30:45", "10:30:45.5", "10:30:45.123456", "10:30:45,25", "00:00:00",
             "23:59:59.999999", "24:00:00", "10:61:00", "7:30"]
    offsets = ["", "", "Z", "+02:00", "-05:30", "+0200", "+02", "-00:00"]
    values = ["20260115", "20260115T10", "20260115T1030", "20260115T103045", "19991231", "2026011",
              "20261315", "", "not-a-date", " 2026-01-15", "2026-01-15 ", "2026/01/15", "2026-01-15T", "T10:00"]
    values += sorted({d + (s + t + o if t else "") for d in dates for s in seps for t in times for o in offsets})
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = {r["s"]: r["p"] for r in df.select("s", parse_timestamp("s").alias("p")).collect()}
    mismatches = {v: (got[v], _python_rule(v)) for v in values if got[v] != _python_rule(v)}
    assert not mismatches


def test_parse_timestamp_documented_narrowing(spark):
    """Forms Python accepts but the guard rejects (quarantined by design)."""
    narrowed = ["2026-W03-4", "2026-01-15T1030", "20260115T103045+02:00", "2026-01-15T10:30:45+02:00:30",
                "2026-01-15T10:30:45.1234567891"]
    assert all(_python_rule(v) is not None for v in narrowed)
    df = spark.createDataFrame([(v,) for v in narrowed], "s string")
    assert all(r[0] is None for r in df.select(parse_timestamp("s")).collect())


def test_parse_quantity_matches_python_int_on_grid(spark):
    """Signs x bodies x leading/trailing whitespace (Python's own set, incl. NBSP; the
    information separators are not stripped) against int(), non-ASCII digits included."""
    signs = ["", "+", "-", "--", "+-"]
    bodies = ["42", "0", "007", "1_000", "1__0", "_1", "1_", "429.5", "1e3", "", "n/a", "9" * 20, "9" * 40,
              "1 2", "0x1A", "٤٢", "४_२", "𝟏𝟐", "4٢", "٤.٢"]
    spaces = ["", " ", "\t", "\n", "\r\n", "\x0b", "\xa0", " ", "\x1f", "　"]
    values = sorted({a + s + b + z for s in signs for b in bodies for a in spaces for z in spaces})

    def expected(v):
        try:
            n = int(v)
        except ValueError:
            return (False, None, False)
        return (True, Decimal(n) if abs(n) < 10**38 else None, n <= 0)

    df = spark.createDataFrame([(v,) for v in values], "q string")
    got = {r["q"]: (r["i"], r["p"], r["n"]) for r in df.select(
        "q", quantity_is_integer("q").alias("i"), parse_quantity("q").alias("p"),
        quantity_is_nonpositive("q").alias("n")).collect()}
    assert {v: got[v] for v in values if got[v] != expected(v)} == {}
