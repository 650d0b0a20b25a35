"""Sinks and file sources (IO2-IO7). Paths are on the shared file system;
nothing goes through the driver except one-row reports."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.session import scratch_path

# The ten columns of a scoring file and their types.
SCORING_FILE_SCHEMA = T.StructType([
    T.StructField("customer_type", T.StringType()),
    T.StructField("Y", T.DoubleType()),
    T.StructField("X", T.DoubleType()),
    T.StructField("num_deliver_per_week", T.IntegerType()),
    T.StructField("brand", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("package", T.StringType()),
    T.StructField("size", T.DoubleType()),
    T.StructField("week_num", T.IntegerType()),
])


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """IO2: a stage table as parquet; a grid goes partitioned by ``week`` so
    split and history filters prune whole folders."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def new_stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, f"stages/{name}-{uuid.uuid4().hex[:12]}")


def write_ranked_csv(df: DataFrame, path: str, by: str = "probabilidad_compra") -> str:
    """IO3: header, no index, highest score first. The sort is a range
    partitioning, so part files are in order and no single task writes all."""
    (df.orderBy(F.col(by).desc(), "customer_id", "product_id")
       .write.mode("overwrite").option("header", True).csv(path))
    return path


def missing_columns(spark: SparkSession, path: str, required: Sequence[str]) -> list[str]:
    """IO4 check: required columns absent from the CSV header (reads the
    header line only)."""
    have = spark.read.option("header", True).csv(path).columns
    return [c for c in required if c not in have]


CORRUPT = "_corrupt_record"


def read_scoring_parts(spark: SparkSession, path: str,
                       schema: T.StructType = SCORING_FILE_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """IO4 with a channel for bad rows: (good rows with the types of
    ``schema``, rejected rows as (line, reasons)).

    A row is rejected if it has more or fewer cells than the header, or a
    cell that is not empty and not of its column's type; ``reasons`` names all
    of them as ``column: cell``. An empty cell is a null. Every row is in
    exactly one of the two. Raises listing the missing columns before any full
    read; other columns of the file are only part of its lines."""
    miss = missing_columns(spark, path, schema.fieldNames())
    if miss:
        raise ValueError(f"missing required columns: {miss}")
    header = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    raw = (spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))

    def wrong(f):
        cell = F.col(f"`{f.name}`")
        bad = cell.isNotNull() & cell.try_cast(f.dataType).isNull()
        return F.when(bad, F.concat(F.lit(f"{f.name}: "), cell))

    size = F.when(F.col(CORRUPT).isNotNull(), F.lit("number of cells"))
    checked = raw.withColumn("reasons", F.when(size.isNotNull(), F.array(size)).otherwise(
        F.array_compact(F.array(*[wrong(f) for f in schema.fields]))))
    line = F.coalesce(F.col(CORRUPT), F.array_join(F.array(*[F.col(f"`{c}`") for c in header]), ",", ""))
    good = checked.where(F.size("reasons") == 0).select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return good, checked.where(F.size("reasons") > 0).select(line.alias("line"), "reasons")


def read_scoring_csv(spark: SparkSession, path: str,
                     schema: T.StructType = SCORING_FILE_SCHEMA) -> DataFrame:
    """IO4: a scoring file with the required columns; raises listing the
    missing ones before any full read. Good rows only: ``read_scoring_parts``
    gives the rejected ones too."""
    return read_scoring_parts(spark, path, schema)[0]


def write_json_report(spark: SparkSession, report: dict, path: str) -> str:
    """IO5: a (one-row) report as JSON text."""
    spark.createDataFrame([(json.dumps(report, default=str, sort_keys=True),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)
    return path


def read_json_report(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def promote_baseline(spark: SparkSession, current: str, baseline: str) -> str:
    """IO6: the current grid becomes the drift reference. Reading and
    overwriting one path in one job would lose data, so the paths must differ."""
    if os.path.abspath(current) == os.path.abspath(baseline):
        raise ValueError("baseline must be a different path from the current grid")
    df = spark.read.parquet(current)
    parts = ["week"] if "week" in df.columns else []
    return write_stage(df, baseline, parts)


def snapshot(df: DataFrame, base: str, stamp: str) -> str:
    """IO7: a timestamped copy; the caller passes the stamp."""
    path = f"{base.rstrip('/')}/snapshot={stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path
