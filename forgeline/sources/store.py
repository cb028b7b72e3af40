"""Parquet tables under one shared root folder: batch folders written by Spark, and one small table of the committed ones.

Every write goes to a fresh folder.  A row (table, part, folder) of ``_committed`` makes it visible; the newest row of a
table's part counts.  The parts of an append-only table are its batches, a table that is rewritten whole has one, and
a table split by a column has one for each value, so that a run replaces those it touched and leaves the files of the others.
All rows of one commit are one file that Spark writes, so several tables switch at once, and a half-written
folder is never read.  What no row names any more is removed when the next run starts (``sweep``).

One writing run at a time is assumed; a store object reads ``_committed`` once and adds its own commits.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.sources import sketch as K

PACKED = "zstd"  # the codec of stored Parquet: fewer bytes to write and to read than the default's
COMMITTED = "at long, table string, part string, folder string"
Commit = tuple[str, str, str]  # table, part, folder


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: list[tuple[int, str, str, str]] | None = None
        self._lock = threading.RLock()  # steps of one run commit from several threads

    # -- folders (Hadoop FS, so any shared storage works) ------------------------------
    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, relative: str) -> list[str]:
        fs, p = self._fs(self.path(relative))
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def path(self, relative: str) -> str:
        return f"{self.root}/{relative}"

    def drop(self, relative: str) -> None:
        """Remove a folder under the root (data no longer read by anyone)."""
        fs, p = self._fs(self.path(relative))
        if fs.exists(p):
            fs.delete(p, True)

    # -- committed folders ---------------------------------------------------------------
    def _rows(self) -> list[tuple[int, str, str, str]]:
        with self._lock:
            if self._known is not None:
                return self._known
            found = self.spark.read.schema(COMMITTED).parquet(self.path("_committed")).orderBy("at").collect() if self._names("_committed") else []
            self._known = [tuple(r) for r in found]
        return self._known

    def commit(self, rows: list[Commit]) -> None:
        """Make the folders of several parts current at once."""
        with self._lock:
            known = self._rows()
            at = max(int(time.time() * 1e6), known[-1][0] + 1 if known else 0)
            new = [(at, *r) for r in rows]
            self.spark.createDataFrame(new, COMMITTED).coalesce(1).write.mode("append").parquet(self.path("_committed"))
            self._known = known + new

    def parts(self, table: str) -> dict[str, str]:
        """The current folder of each part of a table."""
        return {part: folder for _, t, part, folder in self._rows() if t == table}

    def state(self, table: str) -> list[str]:
        """The folders of the table's current content; equal states hold equal rows."""
        return list(self.parts(table).values())

    def exists(self, table: str) -> bool:
        return bool(self.parts(table))

    def sweep(self) -> None:
        """Remove what no committed row names: folders of failed writes, and parts that were replaced."""
        used = {folder for table in {r[1] for r in self._rows()} for folder in self.state(table)}
        for table in self._names(""):
            if table.startswith("_"):
                continue
            for batch in (f"{table}/{n}" for n in self._names(table)):
                if batch in used:
                    continue
                split = [f"{batch}/{n}" for n in self._names(batch) if n.startswith("_part=")]
                kept = [x for x in split if x in used]
                for x in [y for y in split if y not in used] if kept else [batch]:
                    self.drop(x)
        self.drop("_staging")

    # -- reading -----------------------------------------------------------------------
    def read_folders(self, folders: list[str], schema: T.StructType | None = None) -> DataFrame:
        return self.spark.read.parquet(*map(self.path, folders)) if folders else self.spark.createDataFrame([], schema)

    def read(self, table: str, schema: T.StructType | None = None, parts: list[str] | None = None) -> DataFrame:
        """Current content of a table, or of some of its parts; what is absent is empty (with ``schema``)."""
        have = self.parts(table)
        folders = list(have.values()) if parts is None else [have[p] for p in parts if p in have]
        if not folders and schema is None:
            raise FileNotFoundError(f"table {table} does not exist under {self.root}")
        return self.read_folders(folders, schema)

    def keys(self, table: str, cols: list[str], schema: T.StructType | None = None, among: DataFrame | None = None) -> DataFrame:
        """Key-only scan (column pruning reads just these columns).

        ``among``: rows whose keys (columns of the same names) are asked for; batches whose sketch holds none of them are
        not opened.  A few batches are scanned without asking."""
        folders = self.state(table)
        if among is not None and len(folders) > 1:
            folders = self._may_hold(folders, among, cols)
        return self.read_folders(folders, schema).select(*cols)

    def _may_hold(self, folders: list[str], among: DataFrame, cols: list[str]) -> list[str]:
        sketched = [f for f in folders if K.FOLDER in self._names(f)]
        held = K.may_hold(self.spark.read.schema(K.WORDS).parquet(*(self.path(f"{f}/{K.FOLDER}") for f in sketched)), among, cols) if sketched else []
        return [f for f in folders if f in held or f not in sketched]

    # -- writing -----------------------------------------------------------------------
    def write_data(self, df: DataFrame, table: str) -> str:
        """Write a folder that no reader sees until it is committed."""
        folder = f"{table}/batch-{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
        df.write.mode("errorifexists").option("compression", PACKED).parquet(self.path(folder))
        return folder

    def write_parts(self, df: DataFrame, table: str, by: str) -> list[Commit]:
        """Write a folder for each value of a column (a date or the like), and return the rows that commit them.

        The rows of a value are brought together first; AQE splits a value that has very many."""
        folder = f"{table}/batch-{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
        part = F.col(by).cast("string")
        df.withColumn("_part", part).hint("rebalance", "_part").write.mode("errorifexists").option("compression", PACKED).partitionBy("_part").parquet(self.path(folder))
        return [(table, n[len("_part="):], f"{folder}/{n}") for n in self._names(folder) if n.startswith("_part=")]

    def append(self, df: DataFrame, table: str, rows: Callable[[], int] | None = None, key: list[str] | None = None) -> None:
        """Add rows to a table.  ``rows`` tells, after the write, how many there were: none changes nothing.

        ``key``: the columns to sketch, where the number of rows is known."""
        folder = self.write_data(df, table)
        if rows is not None and not rows():
            self.drop(folder)
            return
        if rows is not None and key:
            K.sketch(self.read_folders([folder]), key, rows(), folder).write.parquet(self.path(f"{folder}/{K.FOLDER}"))
        self.commit([(table, folder, folder)])

    def overwrite(self, df: DataFrame, table: str) -> None:
        """Rewrite a table of one part."""
        self.commit([(table, "", self.write_data(df, table))])

    def upsert(self, new: DataFrame, table: str, key: list[str], schema: T.StructType, by: str | None = None) -> None:
        """Rows of ``new`` replace stored rows with the same key; other stored rows stay.

        With ``by``, a column that the key determines, only the parts that ``new`` has rows of are read and replaced.
        ``new`` is written first, so it is computed once for all of its uses."""
        staged = self.write_data(new.select(*self.read(table, schema).columns), "_staging")
        new = self.read_folders([staged])
        touched = None if by is None else [r[0] for r in new.select(F.col(by).cast("string")).distinct().collect()]
        old = self.read(table, new.schema, touched)
        merged = old.join(new.select(*key), key, "left_anti").unionByName(new)
        self.commit([(table, "", self.write_data(merged, table))] if by is None else self.write_parts(merged, table, by))
        self.drop(staged)
