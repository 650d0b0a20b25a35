import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from conftest import ts
from weeklens.operators import features as FE
from weeklens.operators import metrics as M
from weeklens.operators.ordered import running_sums


def test_fit_and_transform_quirks(spark):
    rows = [(1.0, 2, "a", ts(2024, 1, 1)), (None, 2, "b", ts(2024, 1, 8)),
            (3.0, 2, "b", ts(2024, 12, 30)), (5.0, 2, None, ts(2024, 1, 8)),
            (7.0, 2, "a", ts(2024, 1, 15))]
    df = spark.createDataFrame(rows, "Y double, num_deliver_per_week int, brand string, week timestamp")
    spec = FE.FeatureSpec(["Y", "num_deliver_per_week"], ["num_deliver_per_week"], ["brand"], True)
    ff = FE.fit_features(df, spec)
    assert ff.median["Y"] == 4.0                       # 1, 3, 5, 7
    # constant column: upper moves to lower + 1e-6, deviation 0 -> scale 1
    assert ff.upper["num_deliver_per_week"] == pytest.approx(2.0 + 1e-6)
    assert ff.scale["num_deliver_per_week"] == 1.0
    assert ff.edges["num_deliver_per_week"] == [2.0, 2.0]   # repeated edges merged
    assert ff.mode["brand"] == "a"                          # tie a/b -> smallest
    model = Pipeline(stages=ff.stages()).fit(df)
    new = spark.createDataFrame([(None, 2, "zzz", ts(2024, 12, 30))],
                                "Y double, num_deliver_per_week int, brand string, week timestamp")
    row = model.transform(new).select("__ohe_brand", "__week", "__disc_num_deliver_per_week").first()
    assert row["__ohe_brand"].toArray().tolist() == [0.0, 0.0]   # unknown -> all zeros
    assert row["__disc_num_deliver_per_week"] == 0.0
    # ISO week: 2024-12-30 is week 1
    assert spark.range(1).select(F.weekofyear(F.lit(ts(2024, 12, 30)))).first()[0] == 1


def test_quantile_bins_left_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "x double")
    spec = FE.FeatureSpec([], ["x"], [], False, n_bins=2)
    ff = FE.fit_features(df, spec)
    assert ff.edges["x"] == [1.0, 5.5, 10.0]
    out = Pipeline(stages=ff.stages()).fit(df).transform(
        spark.createDataFrame([(5.5,), (5.4,), (100.0,)], "x double"))
    assert [r[0] for r in out.select("__disc_x").collect()] == [1.0, 0.0, 1.0]


def test_feature_name_suffix():
    ff = FE.FittedFeatures(FE.FeatureSpec(["Y", "num_deliver_per_week"], ["num_deliver_per_week"],
                                          ["brand"], True))
    names = FE.feature_names(ff, {"brand": ["a", "b"]})
    assert names == ["Y", "num_deliver_per_week", "num_deliver_per_week_1", "brand_a", "brand_b",
                     "week"]


def groups(spark, y, s):
    return M.as_groups(spark.createDataFrame(list(zip(y, s)), "comprado int, score double"))


def test_average_precision_step_form(spark):
    g = groups(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    assert M.average_precision(g).first()[0] == pytest.approx(0.8333333333)
    # ties share one threshold
    g2 = groups(spark, [1, 0, 1, 0], [0.5, 0.5, 0.2, 0.1])
    assert M.average_precision(g2).first()[0] == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)


def test_threshold_metrics_edges(spark):
    g = groups(spark, [1, 0, 0], [0.5, 0.2, 0.1])     # 0.5 is not > 0.5
    m = M.threshold_metrics(g).first()
    assert (m.precision, m.recall, m.f1_score) == (0.0, 0.0, 0.0)
    none = groups(spark, [0, 0], [0.9, 0.1])
    assert M.average_precision(none).first()[0] == 0.0
    m2 = M.threshold_metrics(none).first()
    assert m2.recall == 0.0 and m2.precision == 0.0 and m2.score_median == pytest.approx(0.5)


def test_running_sums_match_plain_window(spark):
    from pyspark.sql import Window
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"),
                                  (F.col("id") % 5).alias("x"))
    got = running_sums(df, ["g"], "v", ["x"], buckets=7)
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("e", F.sum("x").over(w))
    bad = got.join(exp, ["g", "v"]).where(F.col("cum_x") != F.col("e")).count()
    assert bad == 0 and got.count() == 3000
    single = running_sums(df.where("g = 0"), [], "v", ["x"], buckets=4)
    assert single.agg(F.max("cum_x")).first()[0] == df.where("g = 0").agg(F.sum("x")).first()[0]
