"""Helpers shared by the operators: stage tables, row ids, gapless numbering."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weeklens.session import checkpoint_dir


VECTOR_ROWS = 1 << 15  # rows of a file that one bit map (4 KB) covers
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
VECTORS = 1 << 14  # bit maps sent to all tasks at most: 64 MB


def stage_path(spark, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage (a lost executor costs no recomputation beyond this
    point), gives later joins true sizes, and takes less disk than a row
    checkpoint. With ``tidy`` the shuffle files behind the table go as soon as
    it is written, and not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    if tidy:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy and before is None:
            spark.conf.unset(CLEANUP)
        elif tidy:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def column(df: DataFrame, name: str, cast: str, default: Column | None = None) -> Column:
    """Column ``name`` of ``df`` cast to ``cast``, or ``default`` (null) if absent."""
    if name in df.columns:
        return F.col(f"`{name}`").cast(cast)
    return (F.lit(None) if default is None else default).cast(cast)


def _is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a Parquet scan with rows left out or columns worked on at most."""
    nodes = [df._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() not in ("Project", "Filter", "SubqueryAlias", "LogicalRelation"):
            return False
        below = node.children()
        nodes += [below.apply(i) for i in range(below.size())]
    try:
        df.select(df.metadataColumn("_metadata")["row_index"]).schema
    except AnalysisException:  # no file source, or one without row places
        return False
    return True


def settled(df: DataFrame) -> DataFrame:
    """``df`` if its rows can be numbered by file and place, else written once and read back."""
    return df if _is_scan(df) else stage(df, "rows")


def with_row_id(df: DataFrame, name: str = "_rid") -> DataFrame:
    """Number the rows of a Parquet scan by file (in the order of paths) and place in the file.

    The number does not depend on how the scan is split, so it is the same when a later job comes back to
    the texts of chosen rows, on whatever executors and cores are left then; it tells apart rows that agree
    in every column. Where two jobs number the same rows, frames of other kinds must pass ``settled``
    before the first: here they get the place in their partition.
    """
    if not _is_scan(df):
        return df.withColumn(name, F.monotonically_increasing_id())
    place = df.metadataColumn("_metadata")
    paths = sorted(r[0] for r in df.select(place["file_path"]).distinct().collect())  # one per file
    if len(paths) < 2:
        return df.withColumn(name, place["row_index"])
    path, at, key, no = (f"_{c}{uuid.uuid4().hex}" for c in ("path", "at", "key", "no"))
    files = df.sparkSession.createDataFrame(list(zip(paths, range(len(paths)))), f"{key} string, {no} long")
    return (df.select("*", place["file_path"].alias(path), place["row_index"].alias(at))
            .join(F.broadcast(files), F.col(path) == F.col(key))
            .withColumn(name, F.shiftleft(no, 40).bitwiseOR(F.col(at))).drop(path, at, key, no))


def _vectors(chosen: DataFrame) -> DataFrame:
    """Rows (_vector, _bits): bit maps of the numbers in column _rid, each over ``VECTOR_ROWS`` rows of a file."""
    rid = F.col("_rid")
    return stage(chosen.select(rid).groupBy(F.shiftright(rid, 15).alias("_vector"))
                 .agg(F.bitmap_construct_agg(rid.bitwiseAND(F.lit(VECTOR_ROWS - 1))).alias("_bits")), "row-vectors")


def _in_vectors(numbered: DataFrame, name: str, cells: DataFrame, flag: str) -> DataFrame:
    """``numbered`` with ``flag``: whether the number in column ``name`` is in the bit maps, sent to all tasks."""
    vector, bits = (f"_{c}{uuid.uuid4().hex}" for c in ("vector", "bits"))
    cells = cells.select(F.col("_vector").alias(vector), F.col("_bits").alias(bits))
    place = F.col(name).bitwiseAND(F.lit(VECTOR_ROWS - 1)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod(place, F.lit(8))).bitwiseAND(F.lit(1))
    joined = numbered.join(F.broadcast(cells), F.shiftright(F.col(name), 15) == F.col(vector), "left")
    return joined.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).drop(vector, bits)


def without_rows(docs: DataFrame, gone: DataFrame, vectors: int = VECTORS) -> DataFrame:
    """``docs`` without the rows whose ``with_row_id`` number is in column _rid of ``gone``.

    ``docs`` must have passed ``settled`` before it was numbered first. Columns stay as given, whatever their names.
    The dropped rows become deletion vectors, bit maps over the rows of a file. Where these are few (counted first)
    they go to all tasks and no document leaves its scan; beyond ``vectors`` the numbers are joined by a shuffle.
    """
    name = "_rid"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    cells, numbered = _vectors(gone), with_row_id(docs, name)
    if cells.count() > vectors:
        other = gone.select(F.col("_rid").alias("_gone"))
        return numbered.join(other.hint("shuffle_hash"), numbered[name] == other["_gone"], "left_anti").drop(name)
    flag = f"_gone{uuid.uuid4().hex}"
    return _in_vectors(numbered, name, cells, flag).filter(~F.col(flag)).drop(name, flag)


def only_rows(numbered: DataFrame, name: str, chosen: DataFrame, vectors: int = VECTORS) -> DataFrame:
    """``numbered`` without rows whose number (column ``name``) is not in column _rid of ``chosen``, where these
    take few bit maps; else ``numbered`` as it is. For use before a join with ``chosen``."""
    cells = _vectors(chosen)
    if cells.count() > vectors:
        return numbered
    flag = f"_held{uuid.uuid4().hex}"
    return _in_vectors(numbered, name, cells, flag).filter(F.col(flag)).drop(flag)


def split_rows(numbered: DataFrame, name: str, chosen: DataFrame, vectors: int = VECTORS):
    """``numbered`` in two: the rows whose number (column ``name``) is in column _rid of ``chosen``, and the others.
    Where the numbers take too many bit maps, all rows and None."""
    cells = _vectors(chosen)
    if cells.count() > vectors:
        return numbered, None
    flag = f"_held{uuid.uuid4().hex}"
    told = _in_vectors(numbered, name, cells, flag)
    return told.filter(F.col(flag)).drop(flag), told.filter(~F.col(flag)).drop(flag)


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                  rows: int, per_bucket: int = 100_000) -> DataFrame:
    """Add ``out`` = 0, 1, 2, ... (no gaps) over the rows of each key.

    A key may hold any share of the rows: its rows are dealt by a hash of
    ``order`` into buckets of about ``per_bucket`` rows, numbered inside the
    bucket, and shifted by the sizes of the buckets before. ``rows`` is the row
    count of ``df`` (it sets the bucket count only). ``df`` must be a written
    stage. Rows that tie in ``order`` get distinct numbers.
    """
    buckets = max(1, -(-rows // per_bucket))
    keys = list(keys)
    b = df.withColumn("_bk", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)))
    sizes = b.groupBy(*keys, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    if not keys:
        # one row per bucket of 100,000 rows: a short table
        before = Window.partitionBy(F.lit(0)).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bk").alias("_kb"),
                        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, "_bk").orderBy(*order)
    cond = F.col("_bk") == F.col("_kb")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    numbered = b.withColumn("_rn", F.row_number().over(inside))
    return (numbered.join(offs, cond, "left")
            .withColumn(out, (F.col("_off") + F.col("_rn") - 1).cast("long"))
            .drop("_bk", "_kb", "_off", "_rn", *[f"_k{i}" for i in range(len(keys))]))
