import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import CUST_SCHEMA, PROD_SCHEMA, TX_SCHEMA, ts
from weeklens.operators.grid import build_grid
from weeklens.operators.incremental import merge_weeks, prepare_incremental
from weeklens.session import scratch_path
from weeklens.sources.versions import Versions


def store(spark):
    return Versions(spark, scratch_path(spark, f"store-{uuid.uuid4().hex[:8]}"))


def files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".parquet"))


def values(df):
    return sorted(r.a for r in df.collect())


def frame(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "a long")


def test_tables_named_together_change_together(spark, monkeypatch):
    s = store(spark)
    assert s.current() is None and s.read("x") is None and s.entries() == {}
    s.commit({"x": s.write("x", frame(spark, 1)), "y": s.write("y", frame(spark, 2))})
    new = {"x": s.write("x", frame(spark, 10)), "y": s.write("y", frame(spark, 20))}
    assert values(s.read("x")) == [1]  # written, not committed

    def dies(*a, **k):
        raise RuntimeError("lost between the two")

    monkeypatch.setattr(Versions, "_row", dies)
    with pytest.raises(RuntimeError):
        s.commit(new)
    monkeypatch.undo()
    assert (values(s.read("x")), values(s.read("y"))) == ([1], [2])
    held = s.read("x")
    assert s.commit(new) == 1 and (values(s.read("x")), values(s.read("y"))) == ([10], [20])
    assert values(held) == [1] and values(s.read("x", version=0)) == [1]


def test_promotion_and_snapshot_copy_nothing(spark):
    s = store(spark)
    s.commit({"grid": s.write("grid", frame(spark, 1, 2))})
    before = files(f"{s.base}/data")
    s.commit(s.promote("grid", "baseline"))
    s.snapshot("2024-01-01")
    assert files(f"{s.base}/data") == before
    s.commit({"grid": s.write("grid", frame(spark, 3))})
    assert values(s.read("baseline")) == [1, 2] == values(s.read("grid", tag="2024-01-01")) and values(s.read("grid")) == [3]
    with pytest.raises(ValueError):
        s.snapshot("2024-01-01")
    with pytest.raises(KeyError):
        s.read("grid", version=99) or s.entries(99)


def grid_of(spark, weeks, customers=(1, 2, 3)):
    tx = [(10 * w + c, c, 1 + (c + w) % 2, ts(2024, 1, 1) + dt.timedelta(days=7 * w + c)) for w in weeks for c in customers]
    cust = [(c, f"t{c}", c, 0, float(c), 0.0, 1, 1) for c in (1, 2, 3, 4)]
    prod = [(p, f"b{p}", "c", "s", "g", "k", float(p)) for p in (1, 2)]
    return build_grid(spark.createDataFrame(tx, TX_SCHEMA), spark.createDataFrame(cust, CUST_SCHEMA),
                      spark.createDataFrame(prod, PROD_SCHEMA))


def rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_an_intake_writes_its_own_weeks_only(spark):
    s = store(spark)
    first = grid_of(spark, range(6))
    merge_weeks(s, "state", first, 4)
    assert len(s.folders("state")) == 6
    old, expected = s.folders("state"), first.df
    for weeks, customers in ((range(5, 6), (1, 4)), (range(6, 7), (2, 3)), (range(3, 5), (1, 2))):
        new = grid_of(spark, weeks, customers)
        expected = prepare_incremental(expected, new, 4).df
        merge_weeks(s, "state", new, 4)
        cols = sorted(expected.columns)
        assert rows(s.read("state"), cols) == rows(expected, cols)
        written = s.folders("state") - old
        assert len(written) == len(weeks) and len(files(f"{s.base}/data/state")) < 40
        old = s.folders("state")
    # an earlier version is still what it was, and merging the same intake again changes no row
    assert rows(s.read("state", version=0), sorted(first.df.columns)) == rows(first.df, sorted(first.df.columns))
    again = rows(s.read("state"), sorted(expected.columns))
    merge_weeks(s, "state", grid_of(spark, range(3, 5), (1, 2)), 4)
    assert rows(s.read("state"), sorted(expected.columns)) == again
    # a week's filter reads its folder only
    one = s.read("state").where(F.col("week") == F.lit(ts(2024, 2, 5)))
    assert len(one.inputFiles()) >= len(files(f"{s.base}/{s.entries()['state']['2024-02-05']}"))
    assert one.select(F.input_file_name().alias("f")).distinct().count() == len(files(f"{s.base}/{s.entries()['state']['2024-02-05']}"))


def shop(spark, weeks, customers, products, sizes=True):
    tx = [(100 * w + c, c, p, ts(2024, 1, 1) + dt.timedelta(days=7 * w)) for w in weeks for c in customers for p in products
          if (w + c + p) % 3]
    tx += [(None, c, p, ts(2024, 1, 1) + dt.timedelta(days=7 * weeks[0])) for c in customers for p in products]
    cust = [(c, f"t{c}", None if c == 2 else c, 0, float(c), 0.0, 1, 1) for c in range(1, 6)]
    prod = [(p, f"b{p}", "c", None if p == 2 else "s", "g", "k", float(p) if sizes else 1.0) for p in range(1, 5)]
    return build_grid(spark.createDataFrame(tx, TX_SCHEMA), spark.createDataFrame(cust, CUST_SCHEMA),
                      spark.createDataFrame(prod, PROD_SCHEMA))


@pytest.mark.parametrize("written_out", [(), (0,), (1,), (1, 2)])
def test_stored_grids_take_a_row_per_customer_and_week(spark, monkeypatch, written_out):
    """The weeks of a grid are stored without a row per product, what a merge keeps of them too."""
    from weeklens.operators.grid import Grid
    s, expected, folds = store(spark), None, Grid.folds
    steps = [(range(5), (1, 2, 3), (1, 2, 3), True), (range(3, 6), (2, 3, 4), (2, 4), False), (range(4, 7), (1, 5), (1, 2, 4), True)]
    for i, (weeks, customers, products, sizes) in enumerate(steps):
        new = shop(spark, weeks, customers, products, sizes)
        expected = new.df if expected is None else prepare_incremental(expected, new, 4).df
        monkeypatch.setattr(Grid, "folds", lambda self, *a: i not in written_out and folds(self, *a))
        merge_weeks(s, "state", new, 4)
        cols = sorted(expected.columns)
        got = s.read("state")
        assert sorted(got.columns) == cols and rows(got, cols) == rows(expected, cols)
        assert dict(got.dtypes) == dict(expected.dtypes)
    if not written_out:
        stored = sum(spark.read.parquet(s.path(f)).count() for f in s.folders("state"))
        # weeks 2 and 3 to 6, of one customer or of up to five, of whom no row is stored per product
        assert stored <= 5 * len(s.folders("state")) < expected.count()
