import pytest
from pyspark.sql import functions as F

from conftest import ts
from weeklens.functions.tiers import score_tiers
from weeklens.operators import scoring as SC


def test_latest_attributes_skip_nulls(spark):
    g = spark.createDataFrame([
        (1, 10, ts(2024, 1, 1), 0, "A", 1.0), (1, 10, ts(2024, 1, 8), 0, None, 2.0),
        (1, 20, ts(2024, 1, 8), 1, None, None), (2, 10, ts(2024, 1, 1), 0, "B", None)],
        "customer_id long, product_id long, week timestamp, comprado int, customer_type string, Y double")
    la = {r.customer_id: r for r in SC.latest_attributes(g, "customer_id", ["customer_type", "Y"],
                                                          "product_id").collect()}
    assert la[1].customer_type == "A" and la[1].Y == 2.0
    assert la[2].Y is None


def test_scoring_frame_fills_gaps(spark):
    g = spark.createDataFrame([
        (1, 10, ts(2024, 1, 1), 0, None, 1.0), (2, 10, ts(2024, 1, 1), 1, "B", None),
        (3, 10, ts(2024, 1, 1), 0, "C", 5.0)],
        "customer_id long, product_id long, week timestamp, comprado int, customer_type string, Y double")
    sf = SC.scoring_frame(g)
    rows = {r.customer_id: r for r in sf.df.collect()}
    assert len(rows) == 3 and sf.n_customers * sf.n_products == 3
    assert rows[1].customer_type == "Unknown" and rows[2].Y == 3.0   # median of 1 and 5
    assert rows[1].week == ts(2024, 1, 8)


def test_tiers_and_summary(spark):
    df = spark.createDataFrame([(0.9,), (0.65,), (0.55,), (0.5,), (0.25,), (0.1,)], "probabilidad_compra double")
    t = {r.probabilidad_compra: r for r in score_tiers(df).collect()}
    assert t[0.9].action_tier == "immediate_action" and t[0.9].confidence_level == "high"
    assert t[0.65].action_tier == "follow_up" and t[0.55].action_tier == "moderate_opportunity"
    assert t[0.5].prediccion_compra == 0 and t[0.5].action_tier == "latent_potential"
    assert t[0.1].action_tier == "low_priority" and t[0.25].confidence_level == "high"
    assert t[0.5].probability_band == "medium" and t[0.25].probability_band == "low"
    s = SC.prediction_summary(df).first()
    assert s.total_combinations == 6 and s.positive_predictions == 3
    assert s.max_probability == 0.9
    none = SC.prediction_summary(df.where("probabilidad_compra < 0.5")).first()
    assert none.avg_probability == 0.0 and none.max_probability == 0.0
    empty = SC.prediction_summary(df.where("false")).first()
    assert empty.positive_rate == 0.0


def test_scoring_frame_bucketed_products(spark):
    g = spark.createDataFrame([
        (1, 10, ts(2024, 1, 1), 0, "A", 1.0), (2, 20, ts(2024, 1, 1), 1, "B", 2.0),
        (2, 30, ts(2024, 1, 8), 0, "B", 2.0)],
        "customer_id long, product_id long, week timestamp, comprado int, customer_type string, Y double")
    a = SC.scoring_frame(g).df
    b = SC.scoring_frame(g, max_listed_products=1).df
    cols = sorted(a.columns)
    assert a.count() == 6
    assert sorted(map(repr, a.select(cols).collect())) == sorted(map(repr, b.select(cols).collect()))
