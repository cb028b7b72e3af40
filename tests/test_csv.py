import csv
import io
import random
from contextlib import contextmanager

import pytest
from conftest import write_files
from pyspark.sql import functions as F

from forgeline.sources.csv import _files, read_csv, read_dataset, shape_text, spanning_records, with_file_order, write_csv

COLS = ["check_id", "production_event_id", "timestamp", "result", "defect_type", "inspector_id"]


def _rows(df):
    return [tuple(r) for r in df.drop("_file", "_pos", "_extra").collect()]


def test_missing_and_empty_files_are_empty_tables(spark, tmp_path):
    folder = write_files(tmp_path / "in", {"quality_checks.csv": ""})
    assert read_csv(spark, f"{folder}/nope.csv", COLS).count() == 0
    empty = read_csv(spark, f"{folder}/quality_checks.csv", COLS)
    assert empty.count() == 0 and empty.columns[:6] == COLS


def test_columns_bound_by_header_name(spark, tmp_path):
    folder = write_files(tmp_path / "in", {"c.csv": "result,check_id,production_event_id,timestamp\n"
                                                    "pass,C1,E1,2026-01-01T00:00:00\n"})
    assert _rows(read_csv(spark, f"{folder}/c.csv", COLS)) == [("C1", "E1", "2026-01-01T00:00:00", "pass", None, None)]


def test_empty_field_is_empty_text_and_short_row_is_null(spark, tmp_path):
    text = ("check_id,production_event_id,timestamp,result,defect_type,inspector_id\n"
            "C1,E1,2026-01-01T00:00:00,pass,,INS1\n"
            "C2,E1,2026-01-01T00:00:00,fail\n"
            'C3,E1,2026-01-01T00:00:00,fail,"multi\nline",""\n')
    folder = write_files(tmp_path / "in", {"c.csv": text})
    got = _rows(read_csv(spark, f"{folder}/c.csv", COLS))
    assert got == [("C1", "E1", "2026-01-01T00:00:00", "pass", "", "INS1"),
                   ("C2", "E1", "2026-01-01T00:00:00", "fail", None, None),
                   ("C3", "E1", "2026-01-01T00:00:00", "fail", "multi\nline", "")]


def test_file_order_is_kept(spark, tmp_path):
    lines = "".join(f"C{i},E{i % 3},2026-01-01T00:00:00,pass,,\n" for i in range(200))
    folder = write_files(tmp_path / "in", {"c.csv": ",".join(COLS) + "\n" + lines})
    df = read_csv(spark, f"{folder}/c.csv", COLS)
    ids = [r[0] for r in df.orderBy("_file", "_pos").select("check_id").collect()]
    assert ids == [f"C{i}" for i in range(200)]


def test_write_then_read_round_trip(spark, tmp_path):
    rows = [("C1", "E1", "t", "pass", "", "INS1"), ("C2", "E2", "t", "fail", 'say "hi"', "")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS))
    write_csv(df, str(tmp_path / "out.csv"))
    back = read_csv(spark, str(tmp_path / "out.csv"), COLS)
    assert sorted(_rows(back)) == sorted(rows)


def test_read_dataset_has_all_four_tables(spark, tmp_path):
    folder = write_files(tmp_path / "in", {"machines.csv": "machine_id,machine_name,machine_type,install_date\n"})
    ds = read_dataset(spark, folder)
    assert set(ds) == {"machines", "production_events", "quality_checks", "maintenance_events"}
    assert all(df.count() == 0 for df in ds.values())


def test_file_order_is_kept_when_files_are_split(spark, tmp_path):
    """Single-line mode splits each file across tasks; (_file, _pos) must still follow
    the line order within every file."""
    files = {}
    for f in range(3):
        lines = "".join(f"C{f}-{i:05d},E{i % 7},2026-01-01T00:00:00,pass,,INS{i % 4}\n" for i in range(4000))
        files[f"part{f}.csv"] = ",".join(COLS) + "\n" + lines
    folder = write_files(tmp_path / "split", files)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_csv(spark, folder, COLS, multi_line=False)
        assert df.rdd.getNumPartitions() > 6
        rows = [(r["_file"], r["check_id"]) for r in df.orderBy("_file", "_pos").select("_file", "check_id").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 12000
    for f in range(3):
        ids = [c for path, c in rows if path.endswith(f"part{f}.csv")]
        assert ids == [f"C{f}-{i:05d}" for i in range(4000)]


def test_long_row_keeps_named_fields(spark, tmp_path):
    text = ("check_id,production_event_id,timestamp,result,defect_type,inspector_id\n"
            "C1,E1,2026-01-01T00:00:00,pass,,INS1,extra,more\n"
            "C2,E1,2026-01-01T00:00:00,fail,material,INS2\n"
            'C3,"E,1",2026-01-01T00:00:00,fail,,"a,""b"",c",x\n'
            'C4,"E,1","2026,01",fail\n')
    folder = write_files(tmp_path / "in", {"c.csv": text})
    got = _rows(read_csv(spark, f"{folder}/c.csv", COLS))
    assert got == [("C1", "E1", "2026-01-01T00:00:00", "pass", "", "INS1"),
                   ("C2", "E1", "2026-01-01T00:00:00", "fail", "material", "INS2"),
                   ("C3", "E,1", "2026-01-01T00:00:00", "fail", "", 'a,"b",c'),
                   ("C4", "E,1", "2026,01", "fail", None, None)]


def test_auto_mode_splits_plain_files_and_keeps_quoted_newlines(spark, tmp_path):
    plain = ",".join(COLS) + "\n" + "".join(f'C{i},E1,2026-01-01T00:00:00,pass,"a, ""b""",INS1\n' for i in range(3000))
    multi = ",".join(COLS) + "\n" + 'C1,E1,2026-01-01T00:00:00,fail,"two\nlines",INS1\nC2,E1,t,pass,,\n'
    folder = write_files(tmp_path / "in", {"plain.csv": plain, "multi.csv": multi})
    spans = {r["file"].rsplit("/", 1)[-1]: r["spans"] for r in _files(spark, folder).collect()}
    assert spans == {"plain.csv": False, "multi.csv": True}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        both = read_csv(spark, folder, COLS)
        assert both.rdd.getNumPartitions() > 2 and both.count() == 3002  # only the one file is not split
        df = read_csv(spark, f"{folder}/plain.csv", COLS)
        assert df.rdd.getNumPartitions() > 1  # split across tasks
        ids = [r[0] for r in df.orderBy("_file", "_pos").select("check_id").collect()]
        got = _rows(read_csv(spark, f"{folder}/multi.csv", COLS))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ids == [f"C{i}" for i in range(3000)]
    assert got == [("C1", "E1", "2026-01-01T00:00:00", "fail", "two\nlines", "INS1"), ("C2", "E1", "t", "pass", "", "")]


def test_matches_python_dictreader_on_random_text(spark, tmp_path):
    """Random rows (commas, doubled quotes, embedded newlines, empty fields, short and
    long rows) written with standard quoting; named fields must equal what Python's
    csv.DictReader returns ('' for empty, None for fields a short row lacks)."""
    rng = random.Random(17)
    pool = ["plain", "", "a,b", 'say "hi"', "two\nlines", " padded ", "x", "1,2,3", '"', "\r\nz"]

    def field():
        v = rng.choice(pool)
        return '"' + v.replace('"', '""') + '"' if any(ch in v for ch in ',"\n\r') else v

    lines = [",".join(COLS)]
    for i in range(300):
        n = rng.choice([6, 6, 6, 4, 5, 7, 8])
        lines.append(",".join([f"C{i}"] + [field() for _ in range(n - 1)]))
    text = "\n".join(lines) + "\n"
    folder = write_files(tmp_path / "in", {"c.csv": text})
    want = [tuple(r.get(c) for c in COLS) for r in csv.DictReader(io.StringIO(text, newline=""))]
    got = [tuple(r) for r in read_csv(spark, f"{folder}/c.csv", COLS).orderBy("_file", "_pos")
           .drop("_file", "_pos", "_extra").collect()]
    assert got == want


def test_each_file_has_its_own_header(spark, tmp_path):
    other = [*reversed(COLS), "shift_lead"]
    folder = write_files(tmp_path / "in", {
        "a.csv": ",".join(COLS) + "\nC1,E1,t1,pass,,INS1\n", "b.csv": ",".join(other) + "\nINS2,scratch,fail,t2,E2,C2,ann\n", "c.csv": "",
        "d.csv": "check_id,\"pro\nduct\"\nC3,x\n"})
    got = {r["check_id"]: r for r in read_csv(spark, folder, COLS).collect()}
    assert tuple(got["C1"])[:6] == ("C1", "E1", "t1", "pass", "", "INS1") and got["C1"]["_extra"] is None
    assert tuple(got["C2"])[:6] == ("C2", "E2", "t2", "fail", "scratch", "INS2") and got["C2"]["_extra"] == {"shift_lead": "ann"}
    assert got["C3"]["result"] is None and got["C3"]["_extra"] == {"pro\nduct": "x"}


def test_long_quoted_field_in_a_short_row(spark, tmp_path):
    long = "x" * 1_000_000 + ',""' + "y" * 1000
    folder = write_files(tmp_path / "in", {"c.csv": ",".join(COLS) + f'\nC1,"{long}",t\n'})
    row = read_csv(spark, f"{folder}/c.csv", COLS).first()
    assert row["production_event_id"] == long.replace('""', '"') and row["timestamp"] == "t" and row["result"] is None


def test_quarantine_keeps_the_whole_row(spark, store, tmp_path):
    import json

    from forgeline.plans.ingest import ingest_folder

    folder = write_files(tmp_path / "in", {"machines.csv": "site,machine_id,machine_name,machine_type,install_date\nnorth,M1,,press,2020-01-01\n"})
    ingest_folder(spark, store, folder, "x")
    raw = json.loads(store.read("quarantine").first()["raw_data"])
    assert raw == {"machine_id": "M1", "machine_name": "", "machine_type": "press", "install_date": "2020-01-01", "site": "north"}


@contextmanager
def small_splits(spark, size="16k"):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_large_file_with_quoted_newlines_is_read_by_many_tasks(spark, tmp_path, end):
    """Random records, quoted line breaks of either kind and one field longer than several splits among them: equal
    to Python's csv in every field and in order, and no task parses the file alone."""
    rng = random.Random(23)
    pool = ["plain", "", "a,b", 'say "hi"', "two\nlines", "three\r\nmore\n\nlines", " padded ", '"', "\r\nz", "\n", "é\u2028ü"]

    def field():
        v = rng.choice(pool)
        return '"' + v.replace('"', '""') + '"' if any(ch in v for ch in ',"\n\r') else v

    lines = ["", ",".join([*COLS, "shift"])]
    for i in range(2500):
        n = rng.choice([7, 7, 7, 4, 6, 8])
        lines.append(",".join([f"C{i}"] + [field() for _ in range(n - 1)]))
        if i % 400 == 7:
            lines += ["", f'C{i}x,"' + "long\n" * 4000 + '",t', f'C{i}y,{"w" * 9000},t']
    text = end.join(lines) + end
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a.csv", "b.csv"):
        (folder / name).write_bytes(text.encode())
    want = [tuple(r.get(c) for c in COLS) + (r.get("shift"),) for r in csv.DictReader(io.StringIO(text[len(end):], newline=""))]
    with small_splits(spark):
        got = read_csv(spark, str(folder), COLS)
        rows = got.orderBy("_file", "_pos").collect()
        files = _files(spark, str(folder)).collect()
        plan = got._jdf.queryExecution().toString()
    assert all(f["spans"] and f["split"] for f in files) and "FileScan csv" not in plan
    own = [tuple(r)[:6] + (r["_extra"]["shift"],) for r in rows]
    assert len(want) > 2500 and own == want * 2
    assert [r["_file"].rsplit("/", 1)[-1] for r in rows] == ["a.csv"] * len(want) + ["b.csv"] * len(want)


def test_irregular_quotes_are_left_to_the_parser(spark, tmp_path):
    """Files whose quotes do not tell where records end are parsed from the start, those beside them are not."""
    good = "".join(f'C{i},E1,t,fail,"two\nlines",INS1\n' for i in range(600))
    head = ",".join(COLS) + "\n"
    folder = write_files(tmp_path / "in", {
        "good.csv": head + good, "stray.csv": head + good + 'S1,E1,5" pipe,fail,x,INS1\nS2,E1,6" pipe,fail,x,INS1\n' + good,
        "open.csv": head + good + 'O1,E1,t,fail,"never closed\n', "mark.csv": head + good + "M1,E1,\ue000,fail,x,INS1\n"})
    with small_splits(spark):
        records, others = spanning_records(spark, [str(p) for p in sorted((tmp_path / "in").glob("*.csv"))])
        got = read_csv(spark, folder, COLS)
        by_file = {r["_file"].rsplit("/", 1)[-1]: r["n"] for r in got.groupBy("_file").agg(F.count("*").alias("n")).collect()}
        stray = [tuple(r)[:6] for r in got.where("check_id in ('S1', 'S2', 'M1')").orderBy("check_id").collect()]
    assert [o.rsplit("/", 1)[-1] for o in others] == ["mark.csv", "open.csv", "stray.csv"] and records.count() == 600
    assert by_file == {"good.csv": 600, "stray.csv": 1202, "open.csv": 601, "mark.csv": 601}
    assert stray == [("M1", "E1", "\ue000", "fail", "x", "INS1"), ("S1", "E1", '5" pipe', "fail", "x", "INS1"), ("S2", "E1", '6" pipe', "fail", "x", "INS1")]


def test_plain_files_are_split_as_the_parser_would(spark, tmp_path):
    """Files without quotes are read without the CSV parser, which reads the same rows from them."""
    rng = random.Random(11)
    pieces = ["a", "é", "漢", " ", "  ", "\t", "\x01", "\x1f", "\x0b", "\x85", "\u2028", "'", "\\", ";", "#", "|", "\ufeff", "1.5", "x y", "", ""]
    head = ",".join([*COLS, "more"])

    def line():
        return ",".join("".join(rng.choice(pieces) for _ in range(rng.randrange(4))) for _ in range(rng.choice([7, 7, 7, 1, 3, 9])))

    def text(end):
        return (end.join([head, *(line() for _ in range(1500)), "", " ", "\t\x01", "solo", ",,,,,,"]) + end).encode()

    folder = tmp_path / "in"
    folder.mkdir()
    for name, data in {"a": text("\n"), "b": text("\r\n"), "again": text("\n") + f"{head}\nC1,E1\n".encode(), "quoted": text("\n") + b'C2,"E,2"\n', "zero": text("\n") + b"C3,\0,x\n",
                       "bytes": text("\n") + b"C4,\xff\xc3,x\n", "blank": b"\n" + text("\n"), "other": b"check_id,result\nC5,pass\n", "open": text("\n")[:-1]}.items():
        (folder / f"{name}.csv").write_bytes(data)
    plain = {r["file"].rsplit("/", 1)[-1][:-4] for r in _files(spark, str(folder), head).collect() if r["plain"]}
    assert plain == {"a", "b", "open"}
    columns = [*COLS, "lacking"]
    with small_splits(spark):
        got = read_csv(spark, str(folder), columns)
        schema = ", ".join(f"{c} string" for c in [*COLS, "more", "_corrupt_record"])
        for name in plain:
            parsed = shape_text(spark.read.schema(schema).options(header=True, escape='"', columnNameOfCorruptRecord="_corrupt_record").csv(f"{folder}/{name}.csv"), [*COLS, "more"], columns)
            want = with_file_order(parsed).orderBy("_pos").drop("_file", "_pos").collect()
            assert len(want) > 1300 and got.where(F.col("_file").endswith(f"/{name}.csv")).orderBy("_pos").drop("_file", "_pos").collect() == want
        physical = read_csv(spark, f"{folder}/a.csv", columns)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in physical
    assert got.where("check_id in ('C1', 'check_id', 'C2', 'C3', 'C5')").count() == 5


def test_empty_text_is_exported_without_quotes(spark, tmp_path):
    rows = [("", None, "x"), (None, None, None), ("a,b", "", "")]
    write_csv(spark.createDataFrame(rows, "a string, b string, c string").coalesce(1), str(tmp_path / "out.csv"))
    [part] = (tmp_path / "out.csv").glob("part-*.csv")
    assert sorted(part.read_text().splitlines()) == ['"a,b",,', ",,", ",,x", "a,b,c"]
    write_csv(spark.createDataFrame([("",), ("x",)], "a string"), str(tmp_path / "one.csv"))
    assert sorted(_rows(read_csv(spark, str(tmp_path / "one.csv"), ["a"]))) == [("",), ("x",)]
