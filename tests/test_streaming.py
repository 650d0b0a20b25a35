import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from weeklens.operators.grid import build_grid
from weeklens.operators.incremental import prepare_incremental
from weeklens.session import scratch_path
from weeklens.sources import load_raw
from weeklens.streaming import latest_state, run_weekly_intake


@pytest.mark.parametrize("files", [1, 1000])
def test_two_weekly_drops_equal_batch_merge(spark, files):
    tx, cust, prod = load_raw(spark, SF_SMALL, "brand")
    tx = tx.select("order_id", "customer_id", "product_id",
                   F.col("purchase_date").cast("timestamp").alias("purchase_date"))
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex[:8]}")
    drops, state, ckpt = (os.path.join(base, x) for x in ("drops", "state", "ckpt"))
    cut = dt.datetime(2001, 6, 1)
    first = tx.where(F.col("purchase_date") < F.lit(cut))
    second = tx.where(F.col("purchase_date") >= F.lit(cut - dt.timedelta(days=14)))
    for drop in (first, second):
        drop.repartition(3).write.mode("append").parquet(drops)
        run_weekly_intake(spark, drops, cust, prod, state, ckpt, files_per_batch=files)
    got = latest_state(spark, state)
    exp = prepare_incremental(build_grid(first, cust, prod).df, build_grid(second, cust, prod).df, 4).df
    cols = sorted(exp.columns)
    got = got.select(cols).withColumn("week", F.col("week").cast("timestamp"))
    assert got.count() == exp.count()
    assert got.exceptAll(exp.select(cols)).count() == 0


def test_rows_of_a_cell_in_several_files_and_a_run_without_news(spark):
    """A null order id in one file does not undo the purchase in another."""
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex[:8]}")
    drops, state, ckpt = (os.path.join(base, x) for x in ("drops", "state", "ckpt"))
    cust = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id long, customer_type string")
    prod = spark.createDataFrame([(1, "x"), (2, "y")], "product_id long, brand string")
    day = dt.datetime(2024, 1, 3)
    schema = "order_id long, customer_id long, product_id long, purchase_date timestamp"
    for rows in ([(5, 1, 1, day), (6, 2, 2, day)], [(None, 1, 1, day), (None, 2, 1, day), (7, 1, 2, day)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(drops)
    got = run_weekly_intake(spark, drops, cust, prod, state, ckpt, files_per_batch=1)
    cells = {(r.customer_id, r.product_id): r.comprado for r in got.collect()}
    assert cells == {(1, 1): 1, (2, 2): 1, (1, 2): 1, (2, 1): 0}
    again = run_weekly_intake(spark, drops, cust, prod, state, ckpt)
    assert again.count() == 4 and latest_state(spark, state).count() == 4
