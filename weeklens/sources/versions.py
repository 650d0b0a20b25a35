"""Versioned stage tables: atomic promotion, snapshots without copies, weeks rewritten one by one (IO2, IO6, IO7, U2).

A store is a folder with ``data`` (folders that are written once and never
changed) and ``manifests`` (a small table, one row per version). A version
names, for every table and part of it, the folder that holds it. Committing
appends one manifest file in one job, which its committer puts in place by one
rename: readers see the old version or the new one, for all tables named
together, never a mixture; a job that dies before leaves unnamed folders only.
Parts a commit does not name stay as they are, so an intake that touches one
week writes one week's folder, and a snapshot is a version with a tag: it
copies nothing. A reader that holds a version number keeps reading that
version whatever is committed after it.

A grid may be written folded: a row stands for one customer and week, with the numbers of the products bought
and the number of a product list that lies beside the folders of the same write. ``read`` pairs every row
with its list again and gives the same rows as the grid written out.

One writer at a time is assumed (the weekly job); of two that commit the same
number the one with the larger id wins as a whole.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = ("version long, id string, tag string, "
            "entries array<struct<name:string,part:string,folder:string,part_column:string>>")
WHOLE = ""
# columns of a folded row: its list, and the entries of the list (by their first column) that are marked
LIST, MARKED = "_list", "_bought"
# column of the lists: the name that the mark has in the table
MARK = "_mark"


class Versions:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    # ------------------------------------------------------------- manifests

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifests")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _row(self, version: int | None = None, tag: str | None = None):
        m = self._manifests()
        if m is None:
            return None
        if version is not None:
            m = m.where(F.col("version") == version)
        if tag is not None:
            m = m.where(F.col("tag") == tag)
        return m.orderBy(F.desc("version"), F.desc("id")).limit(1).first()

    def current(self) -> int | None:
        """The newest version, or None before the first commit."""
        row = self._row()
        return None if row is None else row.version

    def entries(self, version: int | None = None, tag: str | None = None) -> dict[str, dict[str, str]]:
        """{table: {part: folder}} of a version (default: the newest), {} before the first commit."""
        row = self._row(version, tag)
        if row is None:
            if version is not None or tag is not None:
                raise KeyError(f"no version {version if tag is None else tag!r}")
            return {}
        out: dict = {}
        for e in row.entries:
            out.setdefault(e.name, {})[e.part] = e.folder
        return out

    def tagged(self, prefix: str) -> list[int]:
        """Numbers of the tags that start with ``prefix``, in order."""
        m = self._manifests()
        if m is None:
            return []
        return sorted(int(r.tag[len(prefix):]) for r in m.where(F.col("tag").startswith(prefix)).select("tag").collect())

    # --------------------------------------------------------------- writing

    def new_folder(self, name: str) -> str:
        return f"data/{name}/v={uuid.uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.base}/{folder}"

    def write(self, name: str, df: DataFrame, part: str | None = None) -> dict[str, str]:
        """Write ``df`` to a new folder, one sub-folder per value of ``part`` (a date or timestamp column, kept as
        a date there); returns {part: folder}, which no reader sees before a commit names it."""
        folder = self.new_folder(name)
        path = self.path(folder)
        if part is None:
            df.write.parquet(path)
            return {WHOLE: folder}
        df.withColumn(part, F.col(part).cast("date")).write.partitionBy(part).parquet(path)
        values = [r[0] for r in self.spark.read.parquet(path).select(part).distinct().collect()]  # one per folder
        return {str(v): f"{folder}/{part}={v}" for v in values if v is not None}

    def write_folded(self, name: str, rows: DataFrame, lists: DataFrame, part: str, parts: list[str], mark: str) -> dict[str, str]:
        """Write a table whose rows are those of ``rows`` (with ``LIST`` and ``MARKED``), each with every entry of
        its list, and ``mark`` = 1 where the entry's first column is in ``MARKED``, else 0. ``lists`` has ``LIST``
        and the entries' columns; the driver reads it, so it must be short. ``parts`` are the dates of column
        ``part`` that occur. Returns {part: folder} as ``write``."""
        v = uuid.uuid4().hex
        entry = [c for c in lists.columns if c != LIST]
        lists.select(LIST, F.lit(mark).alias(MARK), *entry).coalesce(1).write.parquet(self.path(f"data/{name}/lists/v={v}"))
        folder = f"data/{name}/folded/v={v}"
        rows = rows.drop(*entry, mark).withColumn(part, F.col(part).cast("date"))
        rows.write.partitionBy(part).parquet(self.path(folder))
        return {x: f"{folder}/{part}={x}" for x in parts}

    def read_folded(self, folders: list[str]) -> tuple[DataFrame, DataFrame]:
        """(rows, lists) of folders of one folded write; the part column is a date and comes last."""
        base = folded_base(folders[0])
        rows = self.spark.read.option("basePath", self.path(base)).parquet(*[self.path(f) for f in folders])
        return rows, self.spark.read.parquet(self.path(base.replace("/folded/v=", "/lists/v=")))

    def commit(self, changes: dict[str, dict[str, str | None]], tag: str | None = None, whole: bool = True,
               part_columns: dict[str, str] | None = None) -> int:
        """Make ``changes`` ({table: {part: folder}}) the next version. ``whole`` replaces each table named by the
        parts given; otherwise only these parts change, and a folder of None drops its part."""
        row = self._row()
        held: dict = {}
        columns = dict(part_columns or {})
        if row is not None:
            for e in row.entries:
                held.setdefault(e.name, {})[e.part] = e.folder
                columns.setdefault(e.name, e.part_column)
        for name, parts in changes.items():
            kept = {} if whole else held.get(name, {})
            held[name] = {k: f for k, f in {**kept, **parts}.items() if f is not None}
        version = 0 if row is None else row.version + 1
        entries = [(n, p, f, columns.get(n)) for n, parts in held.items() for p, f in parts.items()]
        one = self.spark.createDataFrame([(version, uuid.uuid4().hex, tag, entries)], MANIFEST)
        one.coalesce(1).write.mode("append").parquet(f"{self.base}/manifests")
        return version

    def promote(self, source: str, target: str, version: int | None = None) -> dict:
        """The changes that make table ``target`` the same folders as ``source``: no data is copied."""
        return {target: dict(self.entries(version)[source])}

    def snapshot(self, tag: str) -> int:
        """IO7: the newest version under a name of its own. Existing names are refused."""
        if self._manifests() is None:
            raise KeyError("nothing to take a snapshot of")
        if self._row(tag=tag) is not None:
            raise ValueError(f"snapshot {tag!r} exists")
        return self.commit({}, tag=tag)

    # --------------------------------------------------------------- reading

    def read(self, name: str, version: int | None = None, tag: str | None = None) -> DataFrame | None:
        """A table of a version; None if the version has no such table. A part column comes back as a timestamp
        (its folders carry dates), columns that a part lacks as null."""
        row = self._row(version, tag)
        held = [e for e in (row.entries if row is not None else []) if e.name == name]
        if not held:
            return None
        column = next((e.part_column for e in held if e.part != WHOLE), None)
        roots: dict = {}  # a promoted table lies where it was written
        for e in held:
            base = folded_base(e.folder)
            roots.setdefault(base or e.folder.split("/v=")[0], []).append(e.folder)
        df = None
        for root, folders in sorted(roots.items()):
            if folded_base(folders[0]):
                one = unfold(*self.read_folded(folders))
            else:
                one = (self.spark.read.option("mergeSchema", True).option("basePath", self.path(root))
                       .parquet(*[self.path(f) for f in folders]).drop("v"))
            df = one if df is None else df.unionByName(one, allowMissingColumns=True)
        return df if column is None else df.withColumn(column, F.col(column).cast("timestamp"))

    def folders(self, name: str, version: int | None = None) -> set[str]:
        return set(self.entries(version).get(name, {}).values())


def folded_base(folder: str) -> str | None:
    """The folder of the write that ``folder`` (of a part) belongs to if it was written folded, else None."""
    return folder.rsplit("/", 1)[0] if "/folded/v=" in folder else None


def unfold(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Every row with every entry of its list: the entries go to the tasks as literals, no row is moved."""
    fields = [f for f in lists.schema.fields if f.name not in (LIST, MARK)]
    held: dict = {}
    for r in lists.collect():  # short, as their writer sees to
        held.setdefault(r[LIST], []).append(r)
        mark = r[MARK]
    key, kind = fields[0].name, T.ArrayType(T.StructType(fields))
    entries = [F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in fields])
                         for r in sorted(held[i], key=lambda r: r[key])]).cast(kind) for i in sorted(held)]
    one = entries[0] if len(entries) == 1 else F.get(F.array(*entries), F.col(LIST))
    marked = F.coalesce(F.array_contains(MARKED, F.col(f"_entry.{key}")), F.lit(False)).cast("int").alias(mark)
    own = [c for c in rows.columns if c not in (LIST, MARKED)]
    return (rows.withColumn("_entry", F.explode(one))
            .select(own[0], F.col(f"_entry.{key}"), marked, *own[1:-1], *[F.col(f"_entry.{f.name}") for f in fields[1:]], own[-1]))
