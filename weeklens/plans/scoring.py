"""Scoring jobs: next week from a grid (M6) and a scoring file (M7)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weeklens.functions.tiers import score_tiers
from weeklens.operators import model as MD
from weeklens.operators import scoring as SC
from weeklens.sources import io as IO

# ISO week ``w`` of 2020, a year of 53 weeks, starts on 2019-12-30 + 7 (w - 1)
# days; any Monday of an ISO week gives the same week-of-year feature.
ISO_ANCHOR = "2019-12-30"


def export_scoring_file(frame: DataFrame, path: str) -> str:
    """Write pairs in the ten-column file layout (absent columns empty)."""
    cols = []
    for f in IO.SCORING_FILE_SCHEMA.fields:
        if f.name == "week_num":
            cols.append(F.weekofyear("week").alias("week_num"))
        elif f.name in frame.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    frame.select(*cols).write.mode("overwrite").option("header", True).csv(path)
    return path


def file_to_frame(df: DataFrame) -> DataFrame:
    """P12 re-aimed: the file's week number becomes a ``week`` timestamp in that
    ISO week, the form the fitted features read."""
    monday = F.date_add(F.lit(ISO_ANCHOR).cast("date"), (F.col("week_num") - 1) * 7)
    return df.withColumn("week", monday.cast("timestamp")).drop("week_num")


def scored_rows(spark: SparkSession, model: PipelineModel, path: str, features=None,
                above: float | None = None, head: int | None = None) -> DataFrame:
    """IO4 + P12 + M5: the good rows of a scoring file with their probability, or (``above``) those that score
    higher. With the ``FittedFeatures`` the file is read once and rows that the forest does not tell apart are
    scored once; model inputs the file does not carry arrive as nulls and are imputed."""
    df = file_to_frame(IO.read_scoring_csv(spark, path))
    if features is not None:
        spec = features.spec
        for c in [*spec.numeric, *spec.discretize]:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("double"))
        for c in spec.categorical:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
    if head is not None:
        df = df.limit(head)
    if features is None:
        scored = MD.score(model, df)
        return scored if above is None else scored.where(F.col("probabilidad_compra") > F.lit(above))
    rows = df.withColumn("_cell", MD.forest_cell([(model, features)], df.columns))
    rows = IO.read_stage(spark, IO.write_stage(rows, IO.new_stage_path(spark, "file-rows")))
    return MD.score_cells(model, features, rows, above=above)


def ranked_rows(tiered: DataFrame) -> DataFrame:
    """W3 of scored file rows: highest first, then by the file's columns and the week."""
    return tiered.orderBy(F.col("probabilidad_compra").desc(),
                          *[c for c in IO.SCORING_FILE_SCHEMA.fieldNames() if c in tiered.columns], "week")


def score_file(spark: SparkSession, model: PipelineModel, path: str, features=None,
               threshold: float = 0.5, head: int | None = None) -> DataFrame:
    """M7: IO4 + P12 + M5 + tiers + P11 + W3. Model inputs the file does not
    carry arrive as nulls and are imputed by the fitted features (pass the
    ``FittedFeatures``). ``head`` (off by default) keeps the first rows only,
    as the bulk form of the interface does. The positives are written before
    they are sorted, as a global sort reads its input twice."""
    positives = scored_rows(spark, model, path, features, threshold, head)
    positives = IO.read_stage(spark, IO.write_stage(positives, IO.new_stage_path(spark, "file-positives")))
    return ranked_rows(score_tiers(positives, threshold=threshold))


def score_file_parts(spark: SparkSession, model: PipelineModel, path: str, features=None,
                     threshold: float = 0.5):
    """M7 with its bad rows: (ranked positives, rejected lines with reasons,
    one row of totals: rows of the file, scored, rejected, positives and the mean
    and largest score of the positives)."""
    _, rejected = IO.read_scoring_parts(spark, path)
    scored = score_tiers(scored_rows(spark, model, path, features), threshold=-1.0)
    kept = IO.new_stage_path(spark, "scored-file")
    scored = IO.read_stage(spark, IO.write_stage(scored, kept))
    ranked = ranked_rows(scored.where(F.col("probabilidad_compra") > F.lit(threshold)))
    p = F.when(F.col("probabilidad_compra") > F.lit(threshold), F.col("probabilidad_compra"))
    bad = rejected.count()
    totals = scored.agg((F.count("*") + bad).alias("rows"), F.count("*").alias("scored"), F.lit(bad).cast("long").alias("rejected"),
                        F.count(p).alias("positives"), F.coalesce(F.avg(p), F.lit(0.0)).alias("mean_score"),
                        F.coalesce(F.max(p), F.lit(0.0)).alias("max_score"))
    return ranked, rejected, totals


def score_next_week(model: PipelineModel, grid: DataFrame, out_csv: str | None = None,
                    threshold: float = 0.5, features=None):
    """M6: returns (ranked positives, one-row summary); optionally writes the
    ranked CSV (IO3). The scored pairs feed both: they are written once to the
    shared folder, keys and probability only. With the ``FittedFeatures``
    customers that the forest does not tell apart are scored once."""
    pairs = SC.scoring_frame(grid)
    frame = pairs.df
    path = IO.new_stage_path(grid.df.sparkSession if hasattr(grid, "df") else grid.sparkSession, "scored")
    scored = MD.score(model, frame) if features is None else MD.score_pairs(model, features, pairs)
    IO.write_stage(scored.select("customer_id", "product_id", "week", "probabilidad_compra"), path)
    scored = IO.read_stage(frame.sparkSession, path)
    positives = scored.where(F.col("probabilidad_compra") > F.lit(threshold))
    if out_csv:
        IO.write_ranked_csv(positives, out_csv)
    ranked = positives.orderBy(F.col("probabilidad_compra").desc(), "customer_id", "product_id")
    return ranked, SC.prediction_summary(scored, threshold=threshold)
