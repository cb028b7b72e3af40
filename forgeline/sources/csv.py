"""CSV source (header row, every field text, columns bound by name) and CSV sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.contracts import CSV_COLUMNS

_CORRUPT = "_corrupt_record"
EXTRA = "_extra"  # fields of a row beyond the wanted columns, by header name
_BLANKS = "".join(map(chr, range(33)))  # a line of nothing else holds no record


def _empty(spark: SparkSession, columns: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns]
                          + [T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType()), True),
                             T.StructField("_file", T.StringType(), True),
                             T.StructField("_pos", T.LongType(), True)])
    return spark.createDataFrame([], schema)


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("escape", '"')
            .option("multiLine", multi_line).option("mode", "PERMISSIVE"))


def _first_line(spark: SparkSession, paths: str | list[str]) -> str | None:
    first = spark.read.text(paths).first()
    return first and first["value"]


def _files(spark: SparkSession, paths: str | list[str], header: str | None = None) -> DataFrame:
    """Each non-empty file: its first line, whether some record of it spans lines, whether several tasks read it, and whether it
    is plain: it begins with the line ``header``, which does not come again, and its commas alone tell the fields of its lines.

    Quotes inside a field are doubled, so a physical line holds an odd number of '"'
    exactly when a quoted field opens or closes a line break there.  One splittable text scan
    answers it for every file; only lines with a quote are counted, and no line is sorted (a set of what ``spans``
    may be lets the aggregate hold the first line, too)."""
    line, plain = F.monotonically_increasing_id(), F.lit(False)
    if header and header.strip(_BLANKS):
        special = F.col("value").contains('"') | F.col("value").contains("\0") | ~F.is_valid_utf8("value")
        plain = (F.min(F.struct("line", "value"))["value"] == header) & (F.count_if(F.col("value") == header) == 1) & (F.count_if(special) == 0)
    odd = F.col("value").contains('"') & ((F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1)
    return (spark.read.text(paths).select(F.input_file_name().alias("file"), F.expr("input_file_block_start()").alias("split"), line.alias("line"), "value")
            .groupBy("file").agg(F.min(F.struct("line", "value"))["value"].alias("first"), F.array_contains(F.collect_set(odd), True).alias("spans"), (F.max("split") > 0).alias("split"), plain.alias("plain")))


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str], multi_line: bool | str = "auto") -> DataFrame:
    """Read CSV files or folders as text columns ``columns`` (by each file's own header) plus the
    other columns (``_extra``) and the file order (``_file``, ``_pos``).  A missing or empty file
    yields an empty table.

    Empty fields read as '' and only fields missing from a short row read as NULL:
    files are grouped by header, then parsed with that header as an all-text
    schema plus a corrupt-record column that marks rows with the wrong field count.

    ``multi_line``: True parses every file in multi-line mode, which keeps quoted newlines intact
    but reads a file by one task, however large; False reads lines.  ``"auto"`` (default) reads
    lines unless some record of a file spans them; such a file is parsed in multi-line mode
    if it fits one task, else its records are put together from its lines (``spanning_records``).
    Where files are read by lines and hold no quote, their lines are split at the commas (``plain_lines``).
    ``_pos`` follows file order in every mode.
    """
    try:
        first = _first_line(spark, path)
        files = _files(spark, path, first).collect()  # a row per file
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return _empty(spark, columns)
        raise
    groups: dict[tuple, list[str]] = {}
    large: dict[tuple, list[str]] = {}
    plain: dict[tuple, list[str]] = {}
    headers: dict[tuple[str, bool], tuple[str, ...]] = {}
    for f in sorted(files):
        key = (f["first"], f["first"].count('"') % 2 == 1)
        if key[1] or key not in headers:  # a header that spans lines is read from each file
            headers[key] = tuple(_reader(spark, True).csv(f["file"]).columns)
        parsed = f["spans"] if multi_line == "auto" else bool(multi_line)
        if multi_line == "auto" and f["spans"] and f["split"]:
            large.setdefault(headers[key], []).append(f["file"])
        elif f["plain"] and not parsed:
            plain.setdefault(headers[key], []).append(f["file"])
        else:
            groups.setdefault((headers[key], parsed), []).append(f["file"])
    out = None
    for header, names in large.items():
        records, others = spanning_records(spark, names)
        if others:
            groups.setdefault((header, True), []).extend(others)
        if len(others) < len(names):
            df = parse_records(records, list(header), columns)
            out = df if out is None else out.unionByName(df)
    for header, names in plain.items():
        df = with_file_order(plain_lines(spark, names, first, list(header), columns))
        out = df if out is None else out.unionByName(df)
    for (header, parsed), names in groups.items():
        df = (_reader(spark, parsed).schema(text_schema(list(header)))
              .option("columnNameOfCorruptRecord", _CORRUPT).csv(names))
        df = with_file_order(shape_text(df, list(header), columns))
        out = df if out is None else out.unionByName(df)
    return _empty(spark, columns) if out is None else out


def spanning_records(spark: SparkSession, names: list[str]) -> tuple[DataFrame, list[str]]:
    """The records (file, pos, record) of files with quoted line breaks, read by many tasks, and the files it cannot cut so.

    The lines of every split are read apart.  Each split tells whether it holds an odd number of quotes and where its last
    record starts if it is entered outside or inside a quoted field; the quotes of a file's earlier splits then decide
    which of the two holds, and which record its first lines belong to.  Lines that are records of their own go no
    further; only those of records over several lines are brought together.

    The header and blank lines are left out.  A file is cut by its quotes only if every record so found is regular
    (quotes only around whole fields, doubled within); the others, with stray or open quotes or bare carriage returns,
    are named for a parser that reads them from the start.
    """
    odd = (F.length("value") - F.length(F.translate("value", '"', ""))) % 2
    lines = (spark.read.option("lineSep", "\n").text(names)
             .select(F.input_file_name().alias("file"), F.expr("input_file_block_start()").alias("split"),
                     F.monotonically_increasing_id().alias("line"), "value", odd.alias("odd")))
    within = Window.partitionBy("file", "split").orderBy("line")
    before = F.coalesce(F.sum("odd").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumn("odd_before", before)
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumns({f"start{i}": F.last(F.when(F.col("odd_before") == i, F.col("line")), ignorenulls=True).over(so_far) for i in (0, 1)})
    lines = lines.checkpoint()  # one reading of the splits for all that follows

    bare = F.col("value").rlike("\r.")  # a carriage return that ends no line
    splits = lines.groupBy("file", "split").agg(
        (F.sum("odd") % 2).alias("odd"), F.max("start0").alias("start0"), F.max("start1").alias("start1"),
        F.min(F.when(~F.col("value").isin("", "\r"), F.col("line"))).alias("head"), F.max(bare).alias("bare"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    splits = (splits.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
              .withColumn("last", F.when(F.col("inside") == 0, F.col("start0")).otherwise(F.col("start1")))
              .select("file", "split", "inside", F.last("last", ignorenulls=True).over(earlier).alias("entered"), F.min("head").over(whole).alias("head"),
                      (F.max("bare").over(whole) | (F.sum("odd").over(whole) % 2 == 1)).alias("broken")))
    regular = lines.select("file", "split", "line", "value", "odd", "odd_before", "start0", "start1").join(splits, ["file", "split"]).where(~F.col("broken"))
    own = F.when(F.col("inside") == 0, F.col("start0")).otherwise(F.col("start1"))
    regular = regular.withColumn("pos", F.coalesce(own, F.col("entered"))).where("pos <> head")
    alone = (F.col("inside") == F.col("odd_before")) & (F.col("odd") == 0)
    joined = (regular.where(~alone).groupBy("file", "pos").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("lines"))
              .select("file", "pos", F.array_join(F.col("lines.value"), "\n").alias("record")))
    records = (regular.where(alone).select("file", "pos", F.col("value").alias("record")).unionByName(joined)
               .withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''"))

    # a quoted section becomes one mark; a regular field is marks alone or holds none
    marked = F.regexp_replace("record", '"[^"]*+"', "\ue000")
    irregular = marked.rlike('"|[^,\ue000]\ue000|\ue000[^,\ue000]') | F.col("record").contains("\ue000")
    others = splits.where("broken").select("file").union(records.where(irregular).select("file")).distinct().collect()  # file names
    others = sorted(r["file"] for r in others)
    return (records.where(~F.col("file").isin(others)) if others else records), others


def parse_records(records: DataFrame, header: list[str], columns: list[str]) -> DataFrame:
    """The columns of ``read_csv`` from whole records as text."""
    ddl = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in [*header, _CORRUPT])
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    shaped = shape_text(records.select(F.from_csv("record", ddl, options).alias("r"), F.struct("file", "pos").alias("_at")).select("r.*", "_at"),
                        header, columns, keep="_at")
    return shaped.withColumns({"_file": F.col("_at.file"), "_pos": F.col("_at.pos")}).drop("_at")


def plain_lines(spark: SparkSession, names: list[str], first: str, header: list[str], columns: list[str]) -> DataFrame:
    """The columns of ``read_csv`` from plain files that begin with the line ``first``: the text between a line's commas."""
    line = F.col("value")
    fields = F.split(line, ",", -1)
    lines = spark.read.text(names).where((line != first) & (line.contains(",") | line.rlike(r"[^\x00-\x20]")))
    return shape_fields(lines, lambda c: F.get(fields, F.lit(header.index(c))), header, columns)


def text_schema(header: list[str]) -> T.StructType:
    """All-text schema in header order plus the corrupt-record marker column."""
    return T.StructType([T.StructField(h, T.StringType(), True) for h in header]
                        + [T.StructField(_CORRUPT, T.StringType(), True)])


def shape_text(df: DataFrame, header: list[str], columns: list[str], keep: str | None = None) -> DataFrame:
    """Select ``columns`` by name: '' for empty fields, NULL for fields a short row lacks
    or columns the header lacks; the header's other columns go to ``_extra`` (NULL if there are none); ``keep`` stays as it is."""
    # a malformed record is short (missing trailing fields) or long (extra fields).  Count
    # its fields (commas outside quoted sections): the columns at or past that count are
    # missing; every other empty field is ''.  Doubled quotes are adjacent sections; the
    # possessive pattern does not recurse on long fields.
    unquoted = F.regexp_replace(F.col(_CORRUPT), r'"[^"]*+"', "")
    n_fields = F.length(unquoted) - F.length(F.translate(unquoted, ",", "")) + 1

    def text(c):
        missing = F.col(_CORRUPT).isNotNull() & (n_fields <= header.index(c))
        return F.when(missing, F.lit(None).cast("string")).otherwise(F.coalesce(F.col(f"`{c}`"), F.lit("")))

    return shape_fields(df, text, header, columns, keep)


def shape_fields(df: DataFrame, text: Callable[[str], Column], header: list[str], columns: list[str], keep: str | None = None) -> DataFrame:
    """``columns`` by name, NULL for those the header lacks, and the header's other columns; ``text`` tells a header column's text."""
    others = [c for c in header if c not in columns]
    extra = F.create_map(*[x for c in others for x in (F.lit(c), text(c))]) if others else F.lit(None)
    return df.select(*[(text(c) if c in header else F.lit(None).cast("string")).alias(c) for c in columns], extra.cast("map<string,string>").alias(EXTRA),
                     *([keep] if keep else []))


def with_file_order(df: DataFrame) -> DataFrame:
    """File path and a position increasing in file order (split files included)."""
    return df.withColumns({"_file": F.input_file_name(), "_pos": F.monotonically_increasing_id()})


def read_dataset(spark: SparkSession, data_dir: str, multi_line: bool | str = "auto") -> dict[str, DataFrame]:
    """The four plant files of a drop folder as text tables."""
    base = data_dir.rstrip("/")
    return {t: read_csv(spark, f"{base}/{t}.csv", cols, multi_line) for t, cols in CSV_COLUMNS.items()}


def write_csv(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Header CSV export, a part file for each partition; with ``rows_per_file``, gzip files (of the fast level) of at most so many rows.

    Empty text and NULL are written as nothing; in a file of one column, whose line would be blank, empty text is quoted."""
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": rows_per_file} if rows_per_file else {}
    if len(df.columns) > 1:
        packed["emptyValue"] = ""
    df.write.mode("overwrite").options(header=True, escape='"', **packed).csv(path)
