"""Cases that earlier versions got wrong."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weeklens.operators import drift as D
from weeklens.operators import features as FE
from weeklens.operators import incremental as I
from weeklens.operators import ordered as O
from weeklens.operators import scoring as SC
from weeklens.plans.scoring import file_to_frame
from weeklens.sources.tables import nan_to_null


def test_week_53_stays_week_53(spark):
    df = spark.createDataFrame([(w, w) for w in range(1, 54)], "week_num int, n int")
    got = file_to_frame(df).select("n", F.weekofyear("week").alias("w")).collect()
    assert all(r.n == r.w for r in got) and len(got) == 53


@pytest.mark.parametrize("mode", ["A\\B", "ends in \\", "it's", "x\ny", "é\U0001F600", ""])
def test_any_fitted_mode_is_filled_in(spark, mode):
    df = spark.createDataFrame([(mode,), (mode,), (None,)], "brand string")
    ff = FE.fit_features(df, FE.FeatureSpec([], [], ["brand"], False))
    out = ff.stages()[0].transform(df).select("__cat_brand").collect()
    assert [r[0] for r in out] == [mode] * 3
    again = FE.FittedFeatures.from_dict(ff.as_dict())
    assert again.statement() == ff.statement()


def test_median_between_two_integers_is_not_cut(spark):
    df = spark.createDataFrame([(2, "a"), (3, None), (None, "b")], "n int, s string")
    got = SC.fill_gaps(df, ["n", "s"], 7).collect()
    assert [r.n for r in got] == [2.0, 3.0, 2.5] and [r.s for r in got] == ["a", "Unknown", "b"]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (math.nan,), (math.nan,)], "Y double")
    assert SC.null_counts(df) == {"Y": 2}
    assert [r.Y for r in nan_to_null(df).collect()] == [1.0, 2.0, None, None]
    assert FE.fit_features(df, FE.FeatureSpec(["Y"], [], [], False)).median == {"Y": 1.5}


def test_latest_attributes_with_null_tiebreak(spark):
    w1, w2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)
    df = spark.createDataFrame([(1, None, w2, "a", None), (1, 5, w1, "b", 2), (2, None, w1, None, None)],
                               "customer_id long, product_id long, week timestamp, customer_type string, n int")
    got = {r.customer_id: (r.customer_type, r.n)
           for r in SC.latest_attributes(df, "customer_id", ["customer_type", "n"], "product_id").collect()}
    assert got == {1: ("a", 2), 2: (None, None)}


def test_merge_keeps_the_last_of_repeated_rows_on_both_sides(spark):
    w = dt.datetime(2024, 1, 1)
    schema = "customer_id long, product_id long, week timestamp, comprado int, at int"
    hist = spark.createDataFrame([(1, 1, w, 0, 0), (1, 1, w, 1, 1), (2, 1, w, 0, 0)], schema)
    new = spark.createDataFrame([(2, 1, w, 1, 1), (2, 1, w, 0, 0)], schema)
    got = I.prepare_incremental(hist, new, 4, order=["at"]).df.collect()
    assert sorted((r.customer_id, r.comprado) for r in got) == [(1, 1), (2, 1)]


def test_drift_errors_count_as_drift_only_when_asked():
    def broken():
        raise RuntimeError("no baseline")
    assert D.should_retrain(broken, fail_open=True)
    with pytest.raises(RuntimeError):
        D.should_retrain(broken)
    assert D.should_retrain(lambda: None) and D.should_retrain(None)


@pytest.mark.parametrize("rows_per_bucket", [3, 100_000])
def test_quantiles_match_numpy(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", rows_per_bucket)
    r = np.random.default_rng(1)
    a, b = r.integers(0, 9, 40).astype(float), r.normal(size=40)
    weight = r.integers(1, 5, 40)
    df = spark.createDataFrame([(float(x), float(y), int(w)) for x, y, w in zip(a, b, weight)] + [(None, math.nan, 3)],
                               "a double, b double, w long")
    probs = [0, 0.03, 0.25, 0.5, 0.97, 1]
    got = {x.name: x.q for x in O.quantiles(O.histogram([(df, {"a": F.col("a"), "b": F.col("b")}, F.col("w"))]), probs).collect()}
    assert got["a"] == pytest.approx(np.quantile(np.repeat(a, weight), probs))
    assert got["b"] == pytest.approx(np.quantile(np.repeat(b, weight), probs))


def test_winsorize_refits_per_batch(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "Y double")
    got = FE.winsorize(df, ["Y"], 5, 95, refit=True).agg(F.min("Y"), F.max("Y"), F.count("Y")).first()
    assert tuple(got) == (5.0, 95.0, 101)
