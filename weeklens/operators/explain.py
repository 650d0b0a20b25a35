"""Model explanations (M8-M10): forest importance, permutation importance,
partial dependence.

The latter two take a sample of rows by default, as their reference does, and
all rows with ``n=None``. Permutation importance pairs every row with another
one by a keyed permutation of the row numbers and one equi-join for all columns
and repeats. Partial dependence folds the rows to distinct feature vectors with
counts before the grid points multiply them. In both, everything is scored by
one pass of the forest and folded to a few sums."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weeklens.operators.features import feature_names
from weeklens.operators.model import KEYS, LABEL, cap_rows, indexer_labels, weighted_rows
from weeklens.operators.ordered import quantiles
from weeklens.operators.sampling import permute
from weeklens.session import reliable_checkpoint

SAMPLE = 1000
REPEATS = 5
PDP_POINTS = 20
PDP_TOP = 4


def importance(spark: SparkSession, model: PipelineModel, ff, k: int = 20) -> DataFrame:
    """M8: forest importances with expanded feature names (F11), top ``k``."""
    names = feature_names(ff, indexer_labels(model))
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(names, imp), key=lambda t: (-t[1], t[0]))[:k]
    return spark.createDataFrame([(i + 1, n, float(v)) for i, (n, v) in enumerate(rows)],
                                 "rank int, feature_name string, importance double")


def numbered_rows(df: DataFrame, n: int | None = SAMPLE, seed: int = 42, total: int | None = None) -> tuple[DataFrame, int]:
    """Up to ``n`` rows (None: all) with a gapless number ``_rid`` from 0, written once; and how many they are.

    A sample is numbered in the order of its hash (a window over ``n`` rows); all rows by the row counts of the
    partitions they were written in, of which the driver sees one number per partition. ``total`` (the row count, if
    known) speeds up the sample."""
    if n is not None:
        order = Window.orderBy(F.xxhash64(*KEYS, F.lit(seed)))
        out = reliable_checkpoint(cap_rows(df, n, seed, total=total).withColumn("_rid", F.row_number().over(order) - 1))
        return out, out.count()
    out = reliable_checkpoint(df.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = {r[0]: r[1] for r in out.groupBy(part.alias("p")).count().collect()}
    starts, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    first = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), part.cast("int") + 1) if starts else F.lit(0)
    return out.withColumn("_rid", first + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at"), total


def _probability(model: PipelineModel, ff, df: DataFrame, out: str, features: Column | None = None) -> DataFrame:
    """``df`` with the probability vector ``out`` of its raw columns (or of a feature array)."""
    forest = model.stages[-1].copy()
    forest.setFeaturesCol("_features").setProbabilityCol(out).setPredictionCol("").setRawPredictionCol("")
    x = ff.vector(indexer_labels(model)) if features is None else features
    return forest.transform(df.withColumn("_features", array_to_vector(x))).drop("_features")


def permutation_importance(model: PipelineModel, ff, val: DataFrame, repeats: int = REPEATS,
                           seed: int = 42, n: int | None = SAMPLE, total: int | None = None) -> DataFrame:
    """M9: accuracy drop when one raw input column is shuffled, ``repeats``
    shuffles per column, on a sample of at most ``n`` validation rows (None:
    on all of them).

    Shuffle r of column j gives row i the value of the row that the permutation
    keyed by (j, r) sends to i: every row offers its values to columns x repeats
    rows, by one equi-join on row numbers. ``total``, the number of rows of ``val`` if
    known, speeds up the sample and does not change it."""
    cols = [c for c in val.columns if c not in (LABEL, "customer_id", "product_id")]
    kinds = {f.name: f.dataType for f in val.schema.fields}
    base, total = numbered_rows(val.select(*KEYS, LABEL, *[c for c in cols if c not in KEYS]), n, seed, total)
    if not total:
        return base.sparkSession.createDataFrame([], "feature string, importance_mean double, importance_std double, rank int")
    turns = F.array(*[F.struct(F.lit(j).alias("_j"), F.lit(r).alias("_r")) for j in range(len(cols)) for r in range(repeats)])
    gifts = base.select("_rid", *cols).withColumn("_turn", F.explode(turns)).select("*", "_turn.*").drop("_turn")
    gifts = permute(gifts, F.col("_rid"), total, F.lit(seed * 1000) + F.col("_j") * repeats + F.col("_r"), "_to")
    # of a gift only its own column travels
    gifts = gifts.select("_j", "_r", "_to", *[F.when(F.col("_j") == j, F.col(c)).cast(kinds[c]).alias(f"_new_{c}")
                                              for j, c in enumerate(cols)])
    mixed = base.join(gifts, F.col("_rid") == F.col("_to")).select(
        "_j", "_r", LABEL, *[F.when(F.col("_j") == j, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for j, c in enumerate(cols)])
    plain = base.select(F.lit(-1).alias("_j"), F.lit(-1).alias("_r"), LABEL, *cols)
    p = vector_to_array(F.col("_p"))
    right = (p[1] > p[0]).cast("int") == F.col(LABEL)
    hits = reliable_checkpoint(_probability(model, ff, plain.unionByName(mixed), "_p").groupBy("_j", "_r")
                               .agg(F.sum(right.cast("long")).alias("hits")))  # columns x repeats rows
    plainly = hits.where("_j < 0").first().hits
    drops = hits.where("_j >= 0").withColumn("_d", (F.lit(plainly) - F.col("hits")) / total)
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_j") + 1)
    out = (drops.groupBy(name.alias("feature"))
           .agg(F.avg("_d").alias("importance_mean"), F.stddev_pop("_d").alias("importance_std")))
    return out.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("importance_mean").desc(), "feature")))


def partial_dependence(spark: SparkSession, model: PipelineModel, ff, val: DataFrame,
                       top: int = PDP_TOP, points: int = PDP_POINTS, seed: int = 42,
                       n: int | None = SAMPLE, total: int | None = None) -> DataFrame:
    """For the ``top`` most important transformed features, the mean
    predicted probability with that feature set to each of ``points`` grid
    values (5th to 95th percentile, or the distinct values when fewer);
    features with a single value are skipped. ``val`` holds labelled rows, of
    which up to ``n`` are drawn (None: all; ``total``, their number if known, speeds that up), or ``Grid.judged_rows``.

    Rows that share a feature vector are one row with a count, so that grid
    points multiply distinct vectors only."""
    labels = indexer_labels(model)
    names = feature_names(ff, labels)
    imp = model.stages[-1].featureImportances.toArray().tolist()
    order = sorted(range(len(imp)), key=lambda i: (-imp[i], i))[:top]
    rows = weighted_rows(val if n is None else cap_rows(val, n, seed, total=total))
    folded = reliable_checkpoint(rows.where("_n > 0").groupBy(ff.vector(labels).alias("_x")).agg(F.sum("_n").alias("_n")))
    held = F.array(*[F.struct(F.lit(str(i)).alias("name"), F.col("_x")[i].alias("v")) for i in order])
    hist = reliable_checkpoint(folded.select(F.explode(held).alias("u"), "_n").groupBy("u.name", "u.v").agg(F.sum("_n").alias("n")))
    # one row per feature; of its values only the least ones travel, no more than there are grid points
    least = F.slice(F.sort_array(F.collect_list("v")), 1, points)
    ranked = hist.withColumn("_k", F.count("*").over(Window.partitionBy("name")))
    few = {r.name: r.v for r in ranked.where(F.col("_k") < points).groupBy("name").agg(least.alias("v")).collect()}
    ends = {r.name: r.q for r in quantiles(hist, [0.05, 0.95], checkpointed=True).collect()}
    grids = []
    for i in order:
        vals = few.get(str(i))
        if vals is None and str(i) in ends:
            lo, hi = ends[str(i)]
            vals = [lo + (hi - lo) * k / (points - 1) for k in range(points)]
        if vals and len(vals) > 1:
            grids.append((i, vals))
    if not grids:
        return spark.createDataFrame([], "feature string, grid_index int, value double, "
                                         "avg_probability double")
    entries = [F.struct(F.lit(i).alias("i"), F.lit(g).alias("g"), F.lit(float(v)).alias("v"))
               for i, vals in grids for g, v in enumerate(vals)]
    crossed = folded.select("_x", "_n", F.explode(F.array(*entries)).alias("_p"))
    moved = F.transform("_x", lambda x, k: F.when(k == F.col("_p.i"), F.col("_p.v")).otherwise(x))
    scored = _probability(model, ff, crossed.select("_n", "_p", moved.alias("_moved")), "_prob", F.col("_moved"))
    p = vector_to_array(F.col("_prob"))[1]
    name = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("_p.i") + 1)
    return (scored.groupBy("_p").agg((F.sum(p * F.col("_n")) / F.sum("_n")).alias("avg_probability"))
            .select(name.alias("feature"), F.col("_p.g").alias("grid_index"),
                    F.col("_p.v").alias("value"), "avg_probability"))
