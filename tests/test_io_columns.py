import uuid

import pytest

from weeklens.operators import columns as C
from weeklens.operators import dedup as DD
from weeklens.operators import features as FE
from weeklens.session import scratch_path
from weeklens.sources import io as IO


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k long, rank int, v string")
    first = {r.k: r.v for r in DD.dedup_keep_first(df, ["k"], ["rank"]).collect()}
    last = {r.k: r.v for r in DD.dedup_keep_last(df, ["k"], ["rank"]).collect()}
    assert first == {1: "a", 2: "c"} and last == {1: "b", 2: "c"}
    assert DD.distinct_keys(df.union(spark.createDataFrame([(None, 0, "x")], df.schema)), "k").count() == 2


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 3, 1)],
                               "customer_id long, Y double, brand string, week_of_year int, comprado int")
    assert C.by_type(df, "numeric", ("customer_id", "comprado")) == ["Y", "week_of_year"]
    assert C.by_type(df, "categorical", ("comprado",), integer_as_numeric=False) == ["brand", "week_of_year"]
    num, cat = C.choose_features(df, ["Y"], ["brand", "missing"])
    assert num == ["Y", "week_of_year"] and cat == ["brand"]
    assert C.drop_existing(df, ["Y", "nope"]).columns == ["customer_id", "brand", "week_of_year", "comprado"]
    assert C.by_prefix(df, ["customer_"], ["brand"]) == ["customer_id", "brand"]


def test_sinks_roundtrip(spark):
    base = scratch_path(spark, f"io-{uuid.uuid4().hex[:8]}")
    df = spark.createDataFrame([(1, 10, 0.9), (2, 20, 0.7)], "customer_id long, product_id long, "
                                                             "probabilidad_compra double")
    p = IO.snapshot(df, base + "/snap", "20240101_000000")
    assert p.endswith("snapshot=20240101_000000") and spark.read.parquet(p).count() == 2
    with pytest.raises(Exception):
        IO.snapshot(df, base + "/snap", "20240101_000000")    # never overwrites a snapshot
    IO.write_json_report(spark, {"a": 1, "b": [1, 2]}, base + "/rep")
    assert IO.read_json_report(spark, base + "/rep") == {"a": 1, "b": [1, 2]}
    IO.write_ranked_csv(df, base + "/csv")
    back = spark.read.option("header", True).csv(base + "/csv").collect()
    assert [float(r.probabilidad_compra) for r in back] == [0.9, 0.7]
    bad = spark.createDataFrame([("x",)], "brand string")
    bad.write.option("header", True).csv(base + "/bad")
    with pytest.raises(ValueError, match="week_num"):
        IO.read_scoring_csv(spark, base + "/bad")
    with pytest.raises(ValueError):
        IO.promote_baseline(spark, base + "/snap", base + "/snap")


def test_robust_scaler(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,), (100.0,)], "Y double")
    ff = FE.fit_features(df, FE.FeatureSpec(["Y"], [], [], False, scaler="robust"))
    # median 3.0 imputes the gap: 1, 2, 3, 4, 100 -> centre 3, IQR 4 - 2
    assert ff.median["Y"] == 3.0 and ff.mean["Y"] == 3.0 and ff.scale["Y"] == 2.0
    from pyspark.ml import Pipeline
    out = Pipeline(stages=ff.stages()).fit(df).transform(df).select("__num_Y").collect()
    assert [r[0] for r in out] == [-1.0, -0.5, 0.0, 0.5, 48.5]


def test_bad_rows_of_a_scoring_file_are_told(spark, tmp_path):
    path = str(tmp_path / "file.csv")
    names = IO.SCORING_FILE_SCHEMA.fieldNames()
    lines = [",".join([*names, "extra"]), "a,1.5,2,3,b,s,g,p,1.0,7,x", "a,one,2,3.5,b,s,g,p,1.0,7,x", "a,1.5,2,3,b", ",,,,,,,,,,",
             "a,1.5,2,3,b,s,g,p,1.0,7,x,y", 'a,"1,5",2,3,b,s,g,p,1.0,7,x']
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    good, bad = IO.read_scoring_parts(spark, path)
    assert good.schema == IO.SCORING_FILE_SCHEMA
    assert [r.Y for r in good.collect()] == [1.5, None]
    told = {r.line: r.reasons for r in bad.collect()}
    assert told == {"a,one,2,3.5,b,s,g,p,1.0,7,x": ["Y: one", "num_deliver_per_week: 3.5"], "a,1.5,2,3,b": ["number of cells"],
                    "a,1.5,2,3,b,s,g,p,1.0,7,x,y": ["number of cells"], "a,1,5,2,3,b,s,g,p,1.0,7,x": ["Y: 1,5"]}
    assert IO.read_scoring_csv(spark, path).count() == 2
