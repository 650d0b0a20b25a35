import math

import pytest
from pyspark.sql import functions as F

from weeklens.functions.pvalues import chi2_sf, ks_pvalue
from weeklens.operators import drift as D


def test_pvalue_helpers():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-6)
    assert chi2_sf(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-6)
    assert chi2_sf(0.0, 3) == 1.0
    assert ks_pvalue(0.0, 100, 100) == 1.0
    assert ks_pvalue(0.5, 100, 100) < 1e-9


def test_identical_tables_no_drift(spark):
    df = spark.range(200).select((F.col("id") % 17).cast("double").alias("a"),
                                 (F.col("id") % 3).cast("string").alias("c"))
    rep = D.detect_drift(df, df)
    assert not rep.drift_detected
    assert rep.test_details["a"]["statistic"] == 0.0
    assert rep.test_details["a"]["pvalue"] == 1.0
    assert rep.test_details["c"]["statistic"] == 0.0


def test_numeric_shift_flags_only_that_column(spark):
    ref = spark.range(500).select((F.col("id") / 10).alias("a"), (F.col("id") % 7).alias("b"))
    new = ref.withColumn("a", F.col("a") * 1.3 + 20)
    rep = D.detect_drift(ref, new)
    assert rep.numeric_drift == ["a"]
    assert rep.summary["columns_with_drift"] == 1 and rep.summary["total_columns_analyzed"] == 2


def test_yates_on_two_by_two(spark):
    ref = spark.createDataFrame([("x",)] * 10 + [("y",)] * 20, "c string")
    new = spark.createDataFrame([("x",)] * 20 + [("y",)] * 10, "c string")
    row = D.chi_square_tests(ref, new, ["c"]).first()
    # expected 15 everywhere, |o - e| = 5, corrected to 4.5: 4 * 4.5^2 / 15
    assert row.statistic == pytest.approx(5.4)
    assert row.categories == 2


def test_too_few_samples_skipped_but_counted(spark):
    small = spark.range(29).select(F.col("id").cast("double").alias("a"))
    big = spark.range(100).select(F.col("id").cast("double").alias("a"))
    rep = D.detect_drift(small, big)
    assert rep.test_details == {} and rep.summary["total_columns_analyzed"] == 1
    rep30 = D.detect_drift(spark.range(30).select(F.col("id").cast("double").alias("a")), big)
    assert "a" in rep30.test_details


def test_one_category_is_skipped(spark):
    one = spark.createDataFrame([("x",)] * 40, "c string")
    assert D.drift_tests(one, one).count() == 0


def test_ks_ties_and_unseen_values(spark):
    ref = spark.createDataFrame([(1.0,)] * 30 + [(2.0,)] * 30, "a double")
    new = spark.createDataFrame([(2.0,)] * 30 + [(3.0,)] * 30, "a double")
    row = D.ks_tests(ref, new, ["a"]).first()
    assert row.statistic == pytest.approx(0.5)


def test_weights_equal_replication(spark):
    base = spark.createDataFrame([(1.0, "x", 3), (2.0, "y", 3), (5.0, "x", 3)] * 20,
                                 "a double, c string, w long")
    other = spark.createDataFrame([(1.0, "y", 2), (4.0, "y", 2), (5.0, "x", 2)] * 20,
                                  "a double, c string, w long")
    weighted = {r.column_name: r for r in
                D.drift_tests(base, other, ["a"], ["c"], 30, "w", "w").collect()}
    rep_a = base.select("a", "c", F.explode(F.array_repeat(F.lit(1), F.col("w").cast("int"))))
    rep_b = other.select("a", "c", F.explode(F.array_repeat(F.lit(1), F.col("w").cast("int"))))
    plain = {r.column_name: r for r in D.drift_tests(rep_a, rep_b, ["a"], ["c"]).collect()}
    for c in ("a", "c"):
        assert weighted[c].statistic == pytest.approx(plain[c].statistic)
        assert weighted[c].ref_samples == plain[c].ref_samples
        assert weighted[c].new_samples == plain[c].new_samples


def test_nan_counts_as_missing(spark):
    ref = spark.createDataFrame([(float("nan"),)] * 5 + [(1.0,)] * 40, "a double")
    row = D.ks_tests(ref, ref, ["a"]).first()
    assert row.ref_samples == 40 and not math.isnan(row.statistic)


def test_should_retrain():
    assert D.should_retrain(None)


def test_exact_ks_against_enumeration():
    import itertools
    from weeklens.functions.pvalues import ks_exact_sf
    m, n = 4, 5
    stats = []
    for pos in itertools.combinations(range(m + n), m):
        a = set(pos)
        c1 = c2 = 0
        best = 0.0
        for k in range(m + n):
            if k in a:
                c1 += 1
            else:
                c2 += 1
            best = max(best, abs(c1 / m - c2 / n))
        stats.append(best)
    for d in sorted(set(stats)):
        expect = sum(s >= d - 1e-12 for s in stats) / len(stats)
        assert ks_exact_sf(d, m, n) == pytest.approx(expect, abs=1e-12)
    # equal sizes and a large case stay in range
    assert 0.0 < ks_exact_sf(0.1, 1500, 1500) < 1.0


def test_column_on_one_side_only(spark):
    ref = spark.range(50).select((F.col("id") * 1.0).alias("a"), (F.col("id") * 2.0).alias("b"))
    new = spark.range(50).select((F.col("id") * 1.0).alias("a"))
    rep = D.detect_drift(ref, new)
    assert set(rep.test_details) == {"a"}
    assert rep.summary["total_columns_analyzed"] == 2      # b counts, untested


def test_all_null_on_one_side(spark):
    ref = spark.range(50).select((F.col("id") * 1.0).alias("a"), (F.col("id") % 3).cast("string").alias("c"))
    new = spark.range(50).select(F.lit(None).cast("double").alias("a"), F.lit(None).cast("string").alias("c"))
    rep = D.detect_drift(ref, new)
    assert rep.test_details == {} and rep.summary["total_columns_analyzed"] == 2


def test_counts_of_large_grids_do_not_overflow(spark):
    """Weights of a grid of ten billion rows: count x total is beyond a long, the statistic is not."""
    from weeklens.operators.drift import chi_square_tests
    big = 5_000_000_000
    ref = spark.createDataFrame([("a", big), ("b", big), ("c", big)], "k string, w long")
    new = spark.createDataFrame([("a", big), ("b", big), ("c", 2 * big)], "k string, w long")
    r = chi_square_tests(ref, new, ["k"], "w", "w").first()
    rows = [(big, big), (big, big), (big, 2 * big)]
    t1, t2 = (sum(x[i] for x in rows) for i in (0, 1))
    want = sum((o - e) ** 2 / e for a, b in rows for o, e in ((a, (a + b) * t1 / (t1 + t2)), (b, (a + b) * t2 / (t1 + t2))))
    assert abs(r.statistic / want - 1) < 1e-9 and (r.ref_samples, r.new_samples) == (3 * big, 4 * big)
