import uuid

from conftest import SF_SMALL
from weeklens.plans.weekly import run_weekly
from weeklens.session import scratch_path
from weeklens.sources import io as IO
from weeklens.sources.versions import Versions


def test_weekly_run_trains_then_reuses(spark):
    work = scratch_path(spark, f"weekly-{uuid.uuid4().hex[:8]}")
    kw = dict(tune=False, train_cap=2000)
    first = run_weekly(spark, SF_SMALL, work, **kw)
    assert first["retrained"] and first["drift_detected"] is None
    s = first["prediction_summary"]
    assert s["total_combinations"] > 0 and 0 <= s["positive_rate"] <= 1
    assert min(first["explained"].values()) > 0 and first["val_samples"] > 2000
    second = run_weekly(spark, SF_SMALL, work, stamp="w2", **kw)
    assert second["explained"] == first["explained"]
    store = Versions(spark, work)
    assert store.read("dataset", tag="w2").count() == store.read("dataset").count()
    assert second["drift_detected"] is False and not second["retrained"]
    drift = IO.read_json_report(spark, f"{work}/reports/drift")
    assert drift["summary"]["columns_with_drift"] == 0
    ranked = spark.read.option("header", True).csv(f"{work}/predictions")
    probs = [float(r[0]) for r in ranked.select("probabilidad_compra").collect()]
    assert probs == sorted(probs, reverse=True) and all(p > 0.5 for p in probs)
