from pyspark.sql import functions as F

from conftest import CUST_SCHEMA, PROD_SCHEMA, TX_SCHEMA, ts
from weeklens.operators import grid as G


def frames(spark, tx_rows, cust_rows=None, prod_rows=None):
    tx = spark.createDataFrame(tx_rows, TX_SCHEMA)
    cust = spark.createDataFrame(cust_rows or [
        (1, "A", 1, 1, 1.0, 2.0, 3, 1), (2, "B", 1, 2, 5.0, 6.0, 4, 1)], CUST_SCHEMA)
    prod = spark.createDataFrame(prod_rows or [
        (10, "b1", "G", "s1", "LOW", "can", 0.5), (20, "b2", "G", "s2", "HIGH", "keg", 1.0)],
        PROD_SCHEMA)
    return tx, cust, prod


def test_grid_dense_labels_and_constant_drop(spark):
    tx, cust, prod = frames(spark, [
        (1, 1, 10, ts(2024, 1, 3)),      # Wednesday -> week of Monday 2024-01-01
        (1, 1, 10, ts(2024, 1, 3)),      # duplicate row: same label
        (2, 2, 20, ts(2024, 1, 17)),     # week of 2024-01-15; 2024-01-08 has no rows
        (None, 2, 10, ts(2024, 1, 17)),  # null order id: counted as no purchase
        (3, None, 10, ts(2024, 1, 17)),  # null key: dropped
    ])
    g = G.build_grid(tx, cust, prod)
    rows = g.df.collect()
    assert g.n_weeks == 3 and g.n_customers == 2 and g.n_products == 2
    assert len(rows) == 2 * 2 * 3
    weeks = sorted({r.week for r in rows})
    assert [w.weekday() for w in weeks] == [0, 0, 0]
    assert weeks[0] == ts(2024, 1, 1) and weeks[-1] == ts(2024, 1, 15)
    pos = {(r.customer_id, r.product_id, r.week) for r in rows if r.comprado == 1}
    assert pos == {(1, 10, ts(2024, 1, 1)), (2, 20, ts(2024, 1, 15))}
    # constant attributes go, the label and week stay
    assert "num_visit_per_week" in g.dropped and "category" in g.dropped
    assert "comprado" in g.df.columns and "week" in g.df.columns


def test_all_null_column_is_kept(spark):
    tx, cust, prod = frames(spark, [(1, 1, 10, ts(2024, 1, 3)), (2, 2, 20, ts(2024, 1, 10))],
                            cust_rows=[(1, "A", None, 1, 1.0, 2.0, 3, 1),
                                       (2, "B", None, 2, 5.0, 6.0, 4, 1)])
    g = G.build_grid(tx, cust, prod)
    assert "region_id" in g.df.columns          # nunique 0, not 1


def test_single_week_keeps_week_by_default(spark):
    tx, cust, prod = frames(spark, [(1, 1, 10, ts(2024, 1, 3)), (2, 2, 20, ts(2024, 1, 4))])
    g = G.build_grid(tx, cust, prod)
    assert g.n_weeks == 1 and "week" in g.df.columns
    g2 = G.build_grid(tx, cust, prod, keep=())
    assert "week" not in g2.df.columns


def test_bucketed_product_path_matches_listed(spark):
    tx, cust, prod = frames(spark, [(1, 1, 10, ts(2024, 1, 3)), (2, 2, 20, ts(2024, 1, 17))])
    a = G.build_grid(tx, cust, prod).df
    b = G.build_grid(tx, cust, prod, max_listed_products=1, rows_per_bucket=1).df
    cols = sorted(a.columns)
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_duplicate_dimension_rows_do_not_multiply(spark):
    tx, cust, prod = frames(spark, [(1, 1, 10, ts(2024, 1, 3))],
                            cust_rows=[(1, "A", 1, 1, 1.0, 2.0, 3, 1), (1, "Z", 1, 1, 1.0, 2.0, 3, 1)])
    g = G.build_grid(tx, cust, prod, drop_constant=False)
    assert g.df.count() == 1
    assert g.df.first().customer_type == "A"     # keep-first by the other columns


def test_cell_counts_match_grid(spark):
    from weeklens.sources import load_raw
    from conftest import SF_SMALL
    tx, cust, prod = load_raw(spark, SF_SMALL, "brand")
    g = G.build_grid(tx, cust, prod)
    cc = G.cell_counts(tx).first()
    agg = g.df.agg(F.count("*").alias("n"), F.sum("comprado").alias("p")).first()
    assert cc.cells == agg.n and cc.positives == agg.p


def test_hot_customer_third_of_rows(spark):
    """One customer holds a third of all transactions: results stay exact
    (cells, labels, latest attributes) with no per-key window in the way."""
    import datetime as dt
    from weeklens.operators import scoring as SC
    base = ts(2024, 1, 1)
    rows = [(i, 1 + (i % 3 != 0) * (2 + i % 50), 10 + i % 7, base + dt.timedelta(days=i % 60))
            for i in range(3000)]
    cust = [(c, "T" + str(c % 4), 1, c % 5, float(c), -float(c), 1 + c % 6, 1) for c in range(1, 60)]
    prod = [(p, "b" + str(p), "G", "s", "LOW", "can", float(p)) for p in range(10, 17)]
    tx, cu, pr = frames(spark, rows, cust, prod)
    assert tx.where("customer_id = 1").count() == 1000
    g = G.build_grid(tx, cu, pr)
    cc = G.cell_counts(tx).first()
    agg = g.df.agg(F.count("*").alias("n"), F.sum("comprado").alias("p")).first()
    assert (agg.n, agg.p) == (cc.cells, cc.positives)
    la = SC.latest_attributes(g.df, "customer_id", ["customer_type", "Y"], "product_id")
    got = {r.customer_id: (r.customer_type, r.Y) for r in la.collect()}
    assert got[1] == ("T1", 1.0) and len(got) == g.n_customers


def test_star_from_grid_object_equals_from_rows(spark):
    from weeklens.operators import profile as PR
    from weeklens.operators import scoring as SC
    from weeklens.sources import load_raw
    from conftest import SF_SMALL
    g = G.build_grid(*load_raw(spark, SF_SMALL, "brand"))
    cc, pc = SC.customer_columns(g.df), SC.product_columns(g.df)
    a = PR.grid_to_star(g, cc, pc)
    b = PR.grid_to_star(g.df, cc, pc)
    for x, y in zip(a, b):
        cols = sorted(x.columns)
        assert sorted(map(repr, x.select(cols).collect())) == sorted(map(repr, y.select(cols).collect()))


def test_customers_are_dealt_once_and_not_joined_by_week(spark):
    """The plan of the grid: products come with their attributes, purchases are looked up per week."""
    tx, cust, prod = frames(spark, [(1, 1, 10, ts(2024, 1, 3)), (1, 1, 20, ts(2024, 1, 4)), (2, 2, 20, ts(2024, 1, 17))])
    df = G.build_grid(tx, cust, prod).df
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2
    assert "week" not in " ".join(line for line in plan.splitlines() if "Join " in line)
    assert {(r.customer_id, r.product_id, r.week) for r in df.where("comprado = 1").collect()} == {
        (1, 10, ts(2024, 1, 1)), (1, 20, ts(2024, 1, 1)), (2, 20, ts(2024, 1, 15))}


def test_latest_attributes_are_folded_without_sorting_the_rows(spark):
    from weeklens.operators import scoring as SC
    rows = [(1, 10, ts(2024, 1, 1), "a", 1.0), (1, 20, ts(2024, 1, 1), "b", None), (1, 10, ts(2024, 1, 8), None, 3.0),
            (1, None, ts(2024, 1, 8), "x", 9.0), (2, 10, None, "n", None), (None, 10, ts(2024, 1, 8), "z", 5.0)]
    df = spark.createDataFrame(rows, "customer_id long, product_id long, week timestamp, k string, y double")
    out = SC.latest_attributes(df, "customer_id", ["k", "y"], "product_id")
    assert sorted(map(tuple, out.collect())) == [(1, "x", 3.0), (2, "n", None)]
    assert "HashAggregate(keys=[customer_id" in out._jdf.queryExecution().sparkPlan().toString()
