"""Column drift between a reference and a new table.

All numeric columns go through one unpivot and one aggregate (two-sample
Kolmogorov-Smirnov); all string columns through another (chi-square test of
homogeneity, Yates-corrected on 2x2 tables). Only one row per column comes
back to the driver, where the p-values are computed.

An optional weight column makes each row count ``w`` times. That is how a
dense grid is tested without building it: every customer of a grid occurs
products x weeks times, so the grid's histogram of a customer attribute is
the customer table's histogram with that weight (same for products).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.functions.pvalues import chi2_sf, ks_pvalue
from weeklens.operators.columns import by_type
from weeklens.operators.ordered import running_sums
from weeklens.session import reliable_checkpoint

NUMERIC_EXCLUDE = ("customer_id", "product_id", "comprado")
CATEGORICAL_EXCLUDE = ("customer_id", "product_id", "week", "purchase_date")

TEST_SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType()),
    T.StructField("test", T.StringType()),
    T.StructField("statistic", T.DoubleType()),
    T.StructField("ref_samples", T.LongType()),
    T.StructField("new_samples", T.LongType()),
    T.StructField("categories", T.LongType()),
])


def _unpivot(df: DataFrame, cols: Sequence[str], as_type: str, weight: str | None) -> DataFrame:
    items = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast(as_type).alias("value"))
             for c in cols]
    w = (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w")
    out = df.select(F.explode(F.array(*items)).alias("_u"), w).select("_u.*", "_w")
    keep = F.col("value").isNotNull()
    if as_type == "double":
        keep = keep & ~F.isnan("value")
    return out.where(keep)


def _two_sided(ref, new, cols, as_type, w_ref, w_new) -> DataFrame:
    """Histogram of both sides: one row per (column, value). It is read by
    several aggregates, so it is checkpointed to the shared folder: each call
    scans either input once."""
    a = _unpivot(ref, cols, as_type, w_ref).select(
        "column_name", "value", F.col("_w").alias("n1"), F.lit(0).cast("long").alias("n2"))
    b = _unpivot(new, cols, as_type, w_new).select(
        "column_name", "value", F.lit(0).cast("long").alias("n1"), F.col("_w").alias("n2"))
    h = (a.unionByName(b).groupBy("column_name", "value")
            .agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2")))
    return reliable_checkpoint(h)


def ks_tests(ref: DataFrame, new: DataFrame, cols: Sequence[str],
             weight_ref: str | None = None, weight_new: str | None = None,
             buckets: int | None = None) -> DataFrame:
    """A4: statistic = max |F_ref - F_new| over the distinct values, with both
    ECDFs cumulated on the same sorted value set (ties handled)."""
    if not cols:
        return ref.sparkSession.createDataFrame([], TEST_SCHEMA)
    h = _two_sided(ref, new, cols, "double", weight_ref, weight_new)
    tot = h.groupBy("column_name").agg(F.sum("n1").alias("tot1"), F.sum("n2").alias("tot2"))
    c = running_sums(h, ["column_name"], "value", ["n1", "n2"], buckets, checkpointed=True)
    c = c.join(F.broadcast(tot), "column_name")
    # a side with no values has total 0: the gap is null and the gate skips it
    gap = F.abs(F.try_divide(F.col("cum_n1"), F.col("tot1"))
                - F.try_divide(F.col("cum_n2"), F.col("tot2")))
    return (c.groupBy("column_name")
            .agg(F.max(gap).alias("statistic"), F.first("tot1").alias("ref_samples"),
                 F.first("tot2").alias("new_samples"))
            .select("column_name", F.lit("kolmogorov_smirnov").alias("test"),
                    F.col("statistic").cast("double"), "ref_samples", "new_samples",
                    F.lit(None).cast("long").alias("categories")))


def chi_square_tests(ref: DataFrame, new: DataFrame, cols: Sequence[str],
                     weight_ref: str | None = None, weight_new: str | None = None) -> DataFrame:
    """A5 (with J7/U3 folded in): categories absent on one side count 0."""
    if not cols:
        return ref.sparkSession.createDataFrame([], TEST_SCHEMA)
    h = _two_sided(ref, new, cols, "string", weight_ref, weight_new)
    tot = h.groupBy("column_name").agg(F.sum("n1").alias("tot1"), F.sum("n2").alias("tot2"),
                                       F.count("*").alias("n_cat"))
    j = h.join(F.broadcast(tot), "column_name")
    n = F.col("tot1") + F.col("tot2")
    # as doubles: the product of two counts of a large grid is beyond a long
    t = (F.col("n1") + F.col("n2")).cast("double")
    yates = F.col("n_cat") == 2

    def term(o, e):
        dev = F.abs(o - e)
        dev = dev - F.when(yates, F.least(F.lit(0.5), dev)).otherwise(F.lit(0.0))
        return F.try_divide(dev * dev, e)

    e1 = F.try_divide(t * F.col("tot1"), n)
    e2 = F.try_divide(t * F.col("tot2"), n)
    j = j.withColumn("_term", term(F.col("n1"), e1) + term(F.col("n2"), e2))
    return (j.groupBy("column_name")
            .agg(F.sum("_term").alias("statistic"), F.first("tot1").alias("ref_samples"),
                 F.first("tot2").alias("new_samples"), F.first("n_cat").alias("categories"))
            .select("column_name", F.lit("chi_square").alias("test"),
                    F.col("statistic").cast("double"), "ref_samples", "new_samples",
                    F.col("categories").cast("long")))


def drift_columns(ref: DataFrame, new: DataFrame, numeric=None, categorical=None):
    """Candidate columns (all count as analysed) and the testable ones
    (present on both sides)."""
    if numeric is None:
        numeric = by_type(ref, "numeric", NUMERIC_EXCLUDE)
    if categorical is None:
        categorical = by_type(ref, "categorical", CATEGORICAL_EXCLUDE)
    both = set(ref.columns) & set(new.columns)
    return (list(numeric), list(categorical),
            [c for c in numeric if c in both], [c for c in categorical if c in both])


def drift_tests(ref: DataFrame, new: DataFrame, numeric=None, categorical=None,
                min_samples: int = 30, weight_ref: str | None = None,
                weight_new: str | None = None) -> DataFrame:
    """A4 + A5 + the A7 gate, lazily: one row per tested column."""
    _, _, num, cat = drift_columns(ref, new, numeric, categorical)
    gate = (F.col("ref_samples") >= min_samples) & (F.col("new_samples") >= min_samples)
    ks = ks_tests(ref, new, num, weight_ref, weight_new).where(gate)
    chi = chi_square_tests(ref, new, cat, weight_ref, weight_new).where(
        gate & (F.col("categories") > 1))
    return ks.unionByName(chi)


@dataclass
class DriftReport:
    drift_detected: bool
    numeric_drift: list
    categorical_drift: list
    test_details: dict
    summary: dict

    def as_dict(self) -> dict:
        return {"drift_detected": self.drift_detected, "numeric_drift": self.numeric_drift,
                "categorical_drift": self.categorical_drift,
                "test_details": self.test_details, "summary": self.summary}


def finish_report(rows, numeric: Sequence[str], categorical: Sequence[str],
                  threshold: float = 0.05) -> DriftReport:
    """Driver side: p-values and the A6 summary from the (few) test rows."""
    details, num_d, cat_d = {}, [], []
    for r in rows:
        r = r.asDict() if hasattr(r, "asDict") else dict(r)
        if r["test"] == "kolmogorov_smirnov":
            p = ks_pvalue(r["statistic"], r["ref_samples"], r["new_samples"])
        else:
            p = chi2_sf(r["statistic"], r["categories"] - 1)
        drift = bool(p < threshold)
        rec = {"test": r["test"], "statistic": float(r["statistic"]), "pvalue": float(p),
               "threshold": threshold, "drift": drift,
               "ref_samples": int(r["ref_samples"]), "new_samples": int(r["new_samples"])}
        if r["test"] == "chi_square":
            rec["categories"] = int(r["categories"])
        details[r["column_name"]] = rec
        if drift:
            (num_d if r["test"] == "kolmogorov_smirnov" else cat_d).append(r["column_name"])
    order = {c: i for i, c in enumerate([*numeric, *categorical])}
    num_d.sort(key=order.get)
    cat_d.sort(key=order.get)
    total = len(numeric) + len(categorical)
    n_drift = len(num_d) + len(cat_d)
    summary = {"total_columns_analyzed": total, "numeric_columns_analyzed": len(numeric),
               "categorical_columns_analyzed": len(categorical), "columns_with_drift": n_drift,
               "drift_percentage": n_drift / max(1, total) * 100}
    return DriftReport(n_drift > 0, num_d, cat_d, details, summary)


def detect_drift(ref: DataFrame, new: DataFrame, numeric=None, categorical=None,
                 threshold: float = 0.05, min_samples: int = 30,
                 weight_ref: str | None = None, weight_new: str | None = None) -> DriftReport:
    """detect_drift: runs the test job and collects one row per column."""
    cand_num, cand_cat, _, _ = drift_columns(ref, new, numeric, categorical)
    rows = drift_tests(ref, new, cand_num, cand_cat, min_samples, weight_ref, weight_new).collect()
    return finish_report(rows, cand_num, cand_cat, threshold)


REPORT_SCHEMA = T.StructType([
    *TEST_SCHEMA.fields,
    T.StructField("pvalue", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("drift", T.BooleanType()),
])


def report_frame(spark: SparkSession, report: DriftReport) -> DataFrame:
    """The per-column report as a small DataFrame (one row per tested column)."""
    rows = [(c, d["test"], d["statistic"], d["ref_samples"], d["new_samples"],
             d.get("categories"), d["pvalue"], d["threshold"], d["drift"])
            for c, d in report.test_details.items()]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def summary_frame(spark: SparkSession, report: DriftReport) -> DataFrame:
    s = report.summary
    schema = ("total_columns_analyzed long, numeric_columns_analyzed long, "
              "categorical_columns_analyzed long, columns_with_drift long, "
              "drift_percentage double, drift_detected boolean")
    return spark.createDataFrame([(s["total_columns_analyzed"], s["numeric_columns_analyzed"],
                                   s["categorical_columns_analyzed"], s["columns_with_drift"],
                                   float(s["drift_percentage"]), report.drift_detected)], schema)


def should_retrain(report: "DriftReport | Callable[[], DriftReport | None] | None",
                   fail_open: bool = False) -> bool:
    """No reference -> train; drift -> train; else reuse the model.
    ``report`` may be a function that makes it; its errors raise unless
    ``fail_open`` (then they count as drift)."""
    if callable(report):
        try:
            report = report()
        except Exception:
            if not fail_open:
                raise
            return True
    return report is None or bool(report.drift_detected)


def mean_shift(ref: DataFrame, new: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean before, after and % change per numeric column (one unpivot,
    one aggregate per side)."""
    def means(df, name):
        return (_unpivot(df, cols, "double", None).groupBy("column_name")
                .agg(F.avg("value").alias(name)))
    m = means(ref, "mean_before").join(means(new, "mean_after"), "column_name", "full")
    change = F.when(F.col("mean_before") != 0,
                    (F.col("mean_after") - F.col("mean_before")) / F.abs(F.col("mean_before")) * 100)
    return m.select("column_name", "mean_before", "mean_after", change.alias("pct_change"))


def grid_drift_tests(ref_spines, new_spines, numeric=None, categorical=None,
                     min_samples: int = 30) -> DataFrame:
    """Drift between two grids from their spines (see ``grid.grid_spines``):
    customer columns are tested on the customer spines, product columns on
    the product spines, each row weighted by the grid rows it stands for.
    Equal to testing the two materialised grids, at dimension-table cost."""
    out = None
    for ref, new in zip(ref_spines, new_spines):
        skip = (*NUMERIC_EXCLUDE, "_rows")
        num = (by_type(ref, "numeric", skip) if numeric is None
               else [c for c in numeric if c in ref.columns])
        cat = (by_type(ref, "categorical", CATEGORICAL_EXCLUDE) if categorical is None
               else [c for c in categorical if c in ref.columns])
        t = drift_tests(ref, new, num, cat, min_samples, "_rows", "_rows")
        out = t if out is None else out.unionByName(t)
    return out
