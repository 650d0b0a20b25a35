"""The weekly job: grid -> split -> drift gate -> (train) -> explain -> score.

Stages are written as parquet tables of a versioned store under ``workdir`` (on
the shared file system); each stage reads the previous one back, which cuts the
lineage and lets a lost executor recompute only from the last written table.
What belongs together is committed together: the dataset with its spines, and
after a training the model with its features and the drift baseline, so a run
that dies in between leaves the old set.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weeklens.operators import drift as D
from weeklens.operators import explain as EX
from weeklens.operators import grid as G
from weeklens.operators import model as MD
from weeklens.operators import split as S
from weeklens.operators.features import FittedFeatures
from weeklens.plans.scoring import score_next_week
from weeklens.sources import io as IO
from weeklens.sources import load_raw
from weeklens.sources.versions import WHOLE, Versions


def run_weekly(spark: SparkSession, sf_dir: str, workdir: str, grain: str = "brand",
               tune: bool = True, n_trials: int = 30, parallelism: int = 2,
               train_cap: int | None = MD.TRAIN_CAP, fail_open: bool = False,
               threshold: float = 0.5, stamp: str | None = None) -> dict:
    """run_weekly. Returns the small dict of what happened; reports are also
    written as JSON next to the stage tables.

    The dense grid is written once, partitioned by week; train, val and test
    are ranges of its weeks and read as such (the scan prunes the others). The
    drift reference is the pair of weighted spines of the last training, which
    says as much as the dense grid. ``stamp`` asks for a snapshot of the dataset of the
    run before (IO7): a version under that name, which copies nothing."""
    store = Versions(spark, workdir)
    reports = os.path.join(workdir, "reports")
    out: dict = {}

    if stamp is not None and "dataset" in store.entries():
        store.snapshot(stamp)
    g = G.build_grid(*load_raw(spark, sf_dir, grain))
    # the grid, and its dimension spines, each row weighted by the grid rows it stands for
    store.commit({
        "dataset": store.write("dataset", g.df, "week"),
        "spine_customers": store.write("spine_customers", g.customers.withColumn(
            "_rows", F.lit(g.n_products * g.n_weeks).cast("long"))),
        "spine_products": store.write("spine_products", g.products.withColumn(
            "_rows", F.lit(g.n_customers * g.n_weeks).cast("long")))}, part_columns={"dataset": "week"})
    grid = store.read("dataset")
    weeks = g.weeks()
    train, val, _ = S.temporal_split(grid, weeks=weeks)

    made: list = []

    def drift_report():
        if "hist_customers" not in store.entries():
            return None
        # drift of the two grids by the spine identity (equal to testing the grids)
        ref = (store.read("hist_customers"), store.read("hist_products"))
        cur = (store.read("spine_customers"), store.read("spine_products"))
        skip = (*D.NUMERIC_EXCLUDE, "_rows")
        num = [c for df in ref for c in D.by_type(df, "numeric", skip)]
        cat = [c for df in ref for c in D.by_type(df, "categorical", D.CATEGORICAL_EXCLUDE)]
        made.append(D.finish_report(D.grid_drift_tests(ref, cur, num, cat).collect(), num, cat))
        IO.write_json_report(spark, made[0].as_dict(), os.path.join(reports, "drift"))
        return made[0]

    retrain = D.should_retrain(drift_report, fail_open) or "features" not in store.entries()
    out["drift_detected"] = made[0].drift_detected if made else None
    out["retrained"] = retrain

    if retrain:
        # the sample and the judged rows come from the spines and purchase cells; without a cap the
        # forest is fitted on the stored training weeks
        sample, judged = MD.training_frames(g, train_cap or 1)
        res = MD.train(sample if train_cap else train, judged, tune=tune, n_trials=n_trials,
                       train_cap=None, parallelism=parallelism)
        folders = {k: store.new_folder(k) for k in ("model", "features")}
        model = MD.save_model(res.model, store.path(folders["model"]), check=val)
        ff = res.features
        IO.write_json_report(spark, {"final_metrics": res.metrics, "best_params": res.params,
                                     "trials_history": res.trials,
                                     "train_samples": res.train_rows, "val_samples": res.val_rows},
                             os.path.join(reports, "training"))
        out["metrics"] = res.metrics
        out["train_samples"], out["val_samples"] = res.train_rows, res.val_rows
        IO.write_json_report(spark, ff.as_dict(), store.path(folders["features"]))
        # IO6: the grid that was trained on becomes the drift reference, in one commit with the model
        store.commit({**store.promote("spine_customers", "hist_customers"),
                      **store.promote("spine_products", "hist_products"),
                      **{k: {WHOLE: f} for k, f in folders.items()}})
    else:
        held = store.entries()
        model = PipelineModel.load(store.path(held["model"][WHOLE]))
        ff = FittedFeatures.from_dict(IO.read_json_report(spark, store.path(held["features"][WHOLE])))

    # explained whether trained or reused
    explained = {"top_features_by_importance": EX.importance(spark, model, ff, 20),
                 "permutation_importance": EX.permutation_importance(model, ff, val),
                 "partial_dependence": EX.partial_dependence(spark, model, ff, val)}
    explained = {k: [r.asDict() for r in df.collect()] for k, df in explained.items()}
    IO.write_json_report(spark, explained, os.path.join(reports, "interpretability"))
    out["explained"] = {k: len(v) for k, v in explained.items()}

    _, summary = score_next_week(model, g, os.path.join(workdir, "predictions"), threshold, ff)
    out["prediction_summary"] = summary.first().asDict()
    IO.write_json_report(spark, out["prediction_summary"], os.path.join(reports, "prediction"))
    return out
