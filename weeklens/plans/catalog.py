"""Registry of named queries: each takes (spark, sf_dir) and returns a
DataFrame; most have a DuckDB oracle in ``ORACLE`` with the same column names.

Every query reads the driver tables whole; none subsets rows to make a check
cheaper. Queries whose work is a model fit have no SQL oracle.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weeklens.functions.time import week_spine
from weeklens.operators import grid as G
from weeklens.operators.columns import constant_profile
from weeklens.operators import drift as D
from weeklens.operators import incremental as I
from weeklens.operators import split as S
from weeklens.operators import metrics as M
from weeklens.operators import model as MD
from weeklens.operators import explain as EX
from weeklens.operators import features as FE
from weeklens.operators import profile as PR
from weeklens.sources import io as IO
from weeklens.operators import scoring as SC
from weeklens.functions.tiers import score_tiers
from weeklens.plans.sql_fixtures import (
    CUST, GRID_BRAND, PROD_BRAND, PROD_PART, TX_BRAND, TX_PART, TX_WINDOWS, drift_sql,
    grid_cte, with_,
)
from weeklens.session import reliable_checkpoint
from weeklens.sources import load_raw

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``. Week starts depend on the session time
    zone, so every query pins it to UTC before planning."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- sources (IO1)

@query("source_transactions", with_(TX_PART) +
       "SELECT order_id, customer_id, product_id, purchase_date FROM tx")
def q_source_transactions(spark, sf):
    return load_raw(spark, sf)[0]


@query("source_customers", with_(CUST) + "SELECT * FROM cust")
def q_source_customers(spark, sf):
    return load_raw(spark, sf)[1]


@query("source_products", with_(PROD_PART) + "SELECT * FROM prod")
def q_source_products(spark, sf):
    return load_raw(spark, sf)[2]


# ------------------------------------------------------------ grid

@query("weekly_purchases", with_(TX_PART) + """
SELECT customer_id, product_id, week,
       max(CASE WHEN order_id IS NOT NULL THEN 1 ELSE 0 END) AS comprado
FROM tx GROUP BY 1, 2, 3""")
def q_weekly_purchases(spark, sf):
    return G.weekly_purchases(load_raw(spark, sf)[0])


@query("week_bounds", with_(TX_PART) +
       "SELECT min(week) AS min_week, max(week) AS max_week FROM tx")
def q_week_bounds(spark, sf):
    return G.week_bounds(load_raw(spark, sf)[0])


@query("week_spine", with_(TX_PART) +
       "SELECT unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS week FROM tx")
def q_week_spine(spark, sf):
    return G.week_bounds(load_raw(spark, sf)[0]).select(
        F.explode(week_spine(F.col("min_week"), F.col("max_week"))).alias("week"))


@query("grid", with_(TX_BRAND, CUST, PROD_BRAND, GRID_BRAND) + "SELECT * FROM grid")
def q_grid(spark, sf):
    return G.build_grid(*load_raw(spark, sf, "brand")).df


@query("grid_cell_counts", with_(TX_PART) + """
, d AS (SELECT count(DISTINCT customer_id) AS n_customers, count(DISTINCT product_id) AS n_products,
              CAST(date_diff('day', min(week), max(week)) / 7 + 1 AS BIGINT) AS n_weeks FROM tx),
  p AS (SELECT count(*) AS positives FROM (SELECT DISTINCT customer_id, product_id, week FROM tx
                                           WHERE order_id IS NOT NULL))
SELECT n_customers, n_products, n_weeks, n_customers * n_products * n_weeks AS cells, positives,
       n_customers * n_products * n_weeks - positives AS negatives,
       round(positives / (n_customers * n_products * n_weeks), 6) AS positive_rate,
       round((n_customers * n_products * n_weeks) / (2.0 * positives), 6) AS weight_positive,
       round((n_customers * n_products * n_weeks) / (2.0 * (n_customers * n_products * n_weeks - positives)), 6)
         AS weight_negative
FROM d, p""")
def q_grid_cell_counts(spark, sf):
    df = G.cell_counts(load_raw(spark, sf)[0])
    return df.select(*[r6(F.col(c)).alias(c) if c.startswith(("positive_", "weight_")) else c
                       for c in df.columns])


@query("grid_constant_columns", with_(TX_BRAND, CUST, PROD_BRAND, GRID_BRAND) + """
, cg AS (SELECT g.*, cu.num_visit_per_week, pr.category FROM grid g
         JOIN cust cu USING (customer_id) JOIN prod pr USING (product_id))
SELECT column_name, is_constant FROM (
  SELECT 'customer_type' AS column_name, count(DISTINCT customer_type) = 1 AS is_constant FROM cg UNION ALL
  SELECT 'region_id', count(DISTINCT region_id) = 1 FROM cg UNION ALL
  SELECT 'zone_id', count(DISTINCT zone_id) = 1 FROM cg UNION ALL
  SELECT 'Y', count(DISTINCT Y) = 1 FROM cg UNION ALL
  SELECT 'X', count(DISTINCT X) = 1 FROM cg UNION ALL
  SELECT 'num_deliver_per_week', count(DISTINCT num_deliver_per_week) = 1 FROM cg UNION ALL
  SELECT 'num_visit_per_week', count(DISTINCT num_visit_per_week) = 1 FROM cg UNION ALL
  SELECT 'brand', count(DISTINCT brand) = 1 FROM cg UNION ALL
  SELECT 'category', count(DISTINCT category) = 1 FROM cg)""")
def q_grid_constant_columns(spark, sf):
    """P4 by the dimension identity: the spine of customers and the listed
    products stand for the grid (each occurs with every other key)."""
    tx, cust, prod = load_raw(spark, sf, "brand")
    txw = G.with_week(tx)
    spine = txw.select("customer_id").distinct().join(
        G.clean_dimension(cust, "customer_id"), "customer_id", "left")
    pattrs = G.clean_dimension(prod, "product_id").join(
        txw.select("product_id").distinct(), "product_id", "right")
    cust_cols = [c for c in cust.columns if c != "customer_id"]
    prod_cols = [c for c in prod.columns if c != "product_id"]
    return constant_profile(spine, cust_cols).unionByName(constant_profile(pattrs, prod_cols))


# ------------------------------------------------------------ split

SPLIT_SQL = """, w AS (SELECT unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS week FROM tx),
r AS (SELECT week, row_number() OVER (ORDER BY week) AS week_rank, count(*) OVER () AS n FROM w),
lab AS (SELECT week, week_rank,
           CASE WHEN week_rank <= floor(n * 0.7) THEN 'train'
                WHEN week_rank <= floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split
        FROM r)
"""


@query("temporal_split", with_(TX_BRAND, CUST, PROD_BRAND, GRID_BRAND) + """
, r AS (SELECT week, row_number() OVER (ORDER BY week) AS week_rank, count(*) OVER () AS n
        FROM (SELECT DISTINCT week FROM grid))
SELECT week, week_rank,
       CASE WHEN week_rank <= floor(n * 0.7) THEN 'train'
            WHEN week_rank <= floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split
FROM r""")
def q_temporal_split(spark, sf):
    """W1 on the grid's weeks: its week spine, no grid row is made."""
    return S.split_labels(G.build_grid(*load_raw(spark, sf, "brand")).weeks())


@query("split_sizes", with_(TX_PART) + SPLIT_SQL + """
, d AS (SELECT count(DISTINCT customer_id) AS nc, count(DISTINCT product_id) AS np FROM tx),
  pos AS (SELECT week, count(*) AS positives
          FROM (SELECT DISTINCT customer_id, product_id, week FROM tx WHERE order_id IS NOT NULL)
          GROUP BY week)
SELECT split, count(*) AS n_weeks, min(lab.week) AS first_week, max(lab.week) AS last_week,
       count(*) * max(nc) * max(np) AS cells, CAST(coalesce(sum(positives), 0) AS BIGINT) AS positives
FROM lab CROSS JOIN d LEFT JOIN pos ON pos.week = lab.week
GROUP BY split""")
def q_split_sizes(spark, sf):
    """Rows and positives of train / val / test of the part-grain grid
    (1.04 billion cells at sf0.01) by identity: cells = C x P x weeks."""
    cells = _cells(spark, sf, "part")
    labels = S.split_labels(_cell_weeks(cells))
    dims = cells.agg(F.count_distinct("customer_id").alias("nc"),
                     F.count_distinct("product_id").alias("np")).first()
    pos = (cells.where(F.col("comprado") == 1)
           .join(F.broadcast(labels.select("week", "split")), "week")
           .groupBy("split").agg(F.count("*").alias("positives")))
    per = labels.groupBy("split").agg(F.count("*").alias("n_weeks"),
                                      F.min("week").alias("first_week"),
                                      F.max("week").alias("last_week"))
    return (per.join(pos, "split", "left")
            .select("split", "n_weeks", "first_week", "last_week",
                    (F.col("n_weeks") * F.lit(int(dims.nc) * int(dims.np))).alias("cells"),
                    F.coalesce("positives", F.lit(0)).cast("long").alias("positives")))


@query("latest_weeks", with_(TX_BRAND, CUST, PROD_BRAND, GRID_BRAND) + """
SELECT * FROM grid WHERE week >= (SELECT min(week) FROM
  (SELECT DISTINCT week FROM grid ORDER BY week DESC LIMIT 4))""")
def q_latest_weeks(spark, sf):
    """Grid rows of the latest 4 weeks (the history kept by the merge)."""
    g = G.build_grid(*load_raw(spark, sf, "brand"))
    return g.df.where(F.col("week") >= F.lit(S.latest_weeks_bound(g.weeks(), 4)))


# ------------------------------------------------------------ incremental

def _windows(spark, sf):
    """History = transactions up to 3 weeks before the last week; new = the
    last 6 weeks. They overlap in 3 weeks, where new rows must win."""
    tx, cust, prod = load_raw(spark, sf, "brand")
    txw = G.with_week(tx)
    last = txw.agg(F.max("week")).first()[0]
    import datetime as dt
    hist_tx = txw.where(F.col("week") <= F.lit(last - dt.timedelta(days=21))).drop("week")
    new_tx = txw.where(F.col("week") >= F.lit(last - dt.timedelta(days=35))).drop("week")
    return hist_tx, new_tx, cust, prod


def _incremental(spark, sf):
    """The two built grids."""
    hist_tx, new_tx, cust, prod = _windows(spark, sf)
    return G.build_grid(hist_tx, cust, prod), G.build_grid(new_tx, cust, prod)


INCR_SQL = with_(TX_BRAND, CUST, PROD_BRAND, TX_WINDOWS, grid_cte("hist", "tx_hist"),
                 grid_cte("newg", "tx_new")) + """
, recent AS (SELECT * FROM hist WHERE week >= (SELECT min(week) FROM
              (SELECT DISTINCT week FROM hist ORDER BY week DESC LIMIT 4))),
combined AS (
  SELECT * FROM newg
  UNION ALL
  SELECT * FROM recent r WHERE NOT EXISTS (
    SELECT 1 FROM newg n WHERE n.customer_id = r.customer_id AND n.product_id = r.product_id
                          AND n.week = r.week))
"""


@query("incremental_merge", INCR_SQL + "SELECT * FROM combined")
def q_incremental_merge(spark, sf):
    return I.prepare_incremental(*_incremental(spark, sf), 4).df


@query("merge_repeated_rows", with_(CUST) + """
, base AS (SELECT customer_id, customer_id % 7 AS product_id, TIMESTAMP '2024-01-01' + INTERVAL 7 DAY * (customer_id % 9) AS week,
                  Y, zone_id FROM cust),
hist AS (SELECT customer_id, product_id, week, Y, 0 AS rank FROM base UNION ALL
         SELECT customer_id, product_id, week, Y + 1, 1 FROM base WHERE zone_id < 12),
newr AS (SELECT customer_id, product_id, week, Y + 10 AS Y, 0 AS rank FROM base WHERE zone_id % 2 = 0 UNION ALL
         SELECT customer_id, product_id, week, Y + 20, 1 FROM base WHERE zone_id % 4 = 0),
lo AS (SELECT min(week) AS lo FROM (SELECT DISTINCT week FROM hist ORDER BY week DESC LIMIT 4)),
both_ AS (SELECT *, 0 AS side FROM hist, lo WHERE week >= lo UNION ALL SELECT *, 1 FROM newr, lo),
last_ AS (SELECT *, row_number() OVER (PARTITION BY customer_id, product_id, week ORDER BY side DESC, rank DESC) AS r FROM both_)
SELECT customer_id, product_id, week, round(Y, 6) AS Y, CAST(rank AS INTEGER) AS rank FROM last_ WHERE r = 1""")
def q_merge_repeated_rows(spark, sf):
    """U2 + P3 where both sides repeat keys: the last row of the newer side stays."""
    week = F.lit("2024-01-01").cast("timestamp") + F.make_interval(weeks=(F.col("customer_id") % 9).cast("int"))
    base = load_raw(spark, sf)[1].select("customer_id", (F.col("customer_id") % 7).alias("product_id"),
                                         week.alias("week"), "Y", "zone_id")

    def side(rows, more, rank):
        return rows.select("customer_id", "product_id", "week", (F.col("Y") + more).alias("Y"), F.lit(rank).alias("rank"))
    hist = side(base, 0.0, 0).unionByName(side(base.where("zone_id < 12"), 1.0, 1))
    new = side(base.where("zone_id % 2 = 0"), 10.0, 0).unionByName(side(base.where("zone_id % 4 = 0"), 20.0, 1))
    merged = I.prepare_incremental(hist, new, 4, order=["rank"]).df
    return merged.withColumn("Y", r6(F.col("Y")))


@query("incremental_stats", INCR_SQL + """
SELECT (SELECT count(*) FROM hist) AS historical_samples, (SELECT count(*) FROM newg) AS new_samples,
       (SELECT count(*) FROM combined) AS combined_samples,
       (SELECT count(DISTINCT week) FROM hist) AS historical_weeks,
       (SELECT count(DISTINCT week) FROM newg) AS new_weeks,
       (SELECT count(DISTINCT week) FROM combined) AS combined_weeks,
       4 AS weeks_included_from_historical,
       (SELECT min(week) FROM combined) AS min_week, (SELECT max(week) FROM combined) AS max_week""")
def q_incremental_stats(spark, sf):
    return I.incremental_stats_of_grids(*_incremental(spark, sf), 4)


# ------------------------------------------------------------ drift

CUST_NUMERIC = ["region_id", "zone_id", "Y", "X", "num_deliver_per_week", "num_visit_per_week"]
CUST_CATEGORICAL = ["customer_type"]
ATTR_NUMERIC = CUST_NUMERIC + ["size"]
ATTR_CATEGORICAL = ["customer_type", "brand", "category", "sub_category", "segment", "package"]
GRID_NUMERIC = ["region_id", "zone_id", "Y", "X", "num_deliver_per_week"]
GRID_CATEGORICAL = ["customer_type", "brand"]


def _tests_out(df):
    return df.select("column_name", "test", r6(F.col("statistic")).alias("statistic"),
                     "ref_samples", "new_samples", "categories")


def _customers(spark, sf):
    return load_raw(spark, sf)[1]


def _shift_numeric(c):
    return c.withColumn("Y", F.col("Y") * 1.3)


def _shift_category(c):
    # a third of the customers (zones 0-7 of 25) re-labelled to one segment
    return c.withColumn("customer_type", F.when(F.col("zone_id") < 8, F.lit("BUILDING"))
                        .otherwise(F.col("customer_type")))


@query("drift_same", with_(CUST) + drift_sql("cust", "cust", CUST_NUMERIC, CUST_CATEGORICAL))
def q_drift_same(spark, sf):
    c = _customers(spark, sf)
    return _tests_out(D.drift_tests(c, c))


@query("drift_numeric_shift", with_(CUST) + ", cust2 AS (SELECT * REPLACE (Y * 1.3 AS Y) FROM cust)\n"
       + drift_sql("cust", "cust2", CUST_NUMERIC, CUST_CATEGORICAL))
def q_drift_numeric_shift(spark, sf):
    c = _customers(spark, sf)
    return _tests_out(D.drift_tests(c, _shift_numeric(c)))


@query("drift_category_shift", with_(CUST) + """, cust2 AS (SELECT * REPLACE (
  CASE WHEN zone_id < 8 THEN 'BUILDING' ELSE customer_type END AS customer_type) FROM cust)
""" + drift_sql("cust", "cust2", CUST_NUMERIC, CUST_CATEGORICAL))
def q_drift_category_shift(spark, sf):
    c = _customers(spark, sf)
    return _tests_out(D.drift_tests(c, _shift_category(c)))


def _purchase_attrs(spark, sf):
    tx, cust, prod = load_raw(spark, sf)
    return (tx.join(G.clean_dimension(cust, "customer_id"), "customer_id", "left")
            .join(G.clean_dimension(prod, "product_id"), "product_id", "left")
            .select("purchase_date", *ATTR_NUMERIC, *ATTR_CATEGORICAL))


TIME_SQL = with_(TX_PART, CUST, PROD_PART) + """, pa AS (
  SELECT tx.purchase_date, cust.*, prod.* FROM tx LEFT JOIN cust USING (customer_id)
  LEFT JOIN prod USING (product_id)),
before AS (SELECT * FROM pa WHERE purchase_date < TIMESTAMP '1998-01-01'),
after AS (SELECT * FROM pa WHERE purchase_date >= TIMESTAMP '1998-01-01')
"""


@query("drift_time", TIME_SQL + drift_sql("before", "after", ATTR_NUMERIC, ATTR_CATEGORICAL))
def q_drift_time(spark, sf):
    """Purchases before 1998 against purchases from 1998: did the customer and
    product mix of what is bought move?"""
    pa = reliable_checkpoint(_purchase_attrs(spark, sf))
    cut = F.lit("1998-01-01").cast("timestamp")
    ts = F.col("purchase_date").cast("timestamp")
    return _tests_out(D.drift_tests(pa.where(ts < cut), pa.where(ts >= cut)))


@query("drift_report_time")
def q_drift_report_time(spark, sf):
    """Full report with p-values and flags (driver-side p-values: no SQL)."""
    pa = reliable_checkpoint(_purchase_attrs(spark, sf))
    cut = F.lit("1998-01-01").cast("timestamp")
    ts = F.col("purchase_date").cast("timestamp")
    rep = D.detect_drift(pa.where(ts < cut), pa.where(ts >= cut))
    return D.report_frame(spark, rep)


@query("drift_grid", with_(TX_BRAND, CUST, PROD_BRAND, TX_WINDOWS, grid_cte("hist", "tx_hist"),
                           grid_cte("newg", "tx_new"))
       + drift_sql("hist", "newg", GRID_NUMERIC, GRID_CATEGORICAL))
def q_drift_grid(spark, sf):
    """Drift of the history grid against the new-weeks grid, computed on the
    weighted dimension spines; the oracle tests the two full grids."""
    hist_tx, new_tx, cust, prod = _windows(spark, sf)
    t = D.grid_drift_tests(G.grid_spines(hist_tx, cust, prod), G.grid_spines(new_tx, cust, prod),
                           GRID_NUMERIC, GRID_CATEGORICAL)
    return _tests_out(t)


@query("drift_summary_grid")
def q_drift_summary_grid(spark, sf):
    """A6 + M11 on the grid scenario (p-values on the driver)."""
    hist_tx, new_tx, cust, prod = _windows(spark, sf)
    rows = D.grid_drift_tests(G.grid_spines(hist_tx, cust, prod),
                              G.grid_spines(new_tx, cust, prod),
                              GRID_NUMERIC, GRID_CATEGORICAL).collect()
    rep = D.finish_report(rows, GRID_NUMERIC, GRID_CATEGORICAL)
    return D.summary_frame(spark, rep)


@query("mean_shift", with_(CUST) + """, cust2 AS (SELECT * REPLACE (Y * 1.3 AS Y) FROM cust)
SELECT a.column_name, round(a.m, 6) AS mean_before, round(b.m, 6) AS mean_after,
       round(CASE WHEN a.m <> 0 THEN (b.m - a.m) / abs(a.m) * 100 END, 6) AS pct_change
FROM (SELECT 'Y' AS column_name, avg(Y) AS m FROM cust UNION ALL SELECT 'X', avg(X) FROM cust
      UNION ALL SELECT 'num_deliver_per_week', avg(num_deliver_per_week) FROM cust) a
JOIN (SELECT 'Y' AS column_name, avg(Y) AS m FROM cust2 UNION ALL SELECT 'X', avg(X) FROM cust2
      UNION ALL SELECT 'num_deliver_per_week', avg(num_deliver_per_week) FROM cust2) b
USING (column_name)""")
def q_mean_shift(spark, sf):
    c = _customers(spark, sf)
    m = D.mean_shift(c, _shift_numeric(c), ["Y", "X", "num_deliver_per_week"])
    return m.select("column_name", *[r6(F.col(x)).alias(x)
                                     for x in ("mean_before", "mean_after", "pct_change")])


# ------------------------------------------------------------ scoring

GRID_ALL = with_(TX_BRAND, CUST, PROD_BRAND, GRID_BRAND)

FRAME_SQL = """, lw AS (SELECT max(week) AS lw FROM grid),
ci AS (SELECT customer_id,
         arg_max(customer_type, CASE WHEN customer_type IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS customer_type,
         arg_max(region_id, CASE WHEN region_id IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS region_id,
         arg_max(zone_id, CASE WHEN zone_id IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS zone_id,
         arg_max(Y, CASE WHEN Y IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS Y,
         arg_max(X, CASE WHEN X IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS X,
         arg_max(num_deliver_per_week, CASE WHEN num_deliver_per_week IS NOT NULL
                 THEN epoch_ms(week) * 1000 + product_id END) AS num_deliver_per_week
       FROM grid GROUP BY customer_id),
pi AS (SELECT product_id,
         arg_max(brand, CASE WHEN brand IS NOT NULL THEN epoch_ms(week) * 100000 + customer_id END) AS brand
       FROM grid GROUP BY product_id),
frame AS (SELECT ci.customer_id, pi.product_id, lw + INTERVAL 7 DAY AS week,
                 ci.customer_type, ci.region_id, ci.zone_id, ci.Y, ci.X, ci.num_deliver_per_week, pi.brand
          FROM ci CROSS JOIN pi CROSS JOIN lw),
pos AS (SELECT customer_id, product_id, week FROM grid WHERE comprado = 1),
loy AS (SELECT p.customer_id, p.product_id, count(*) / max(w.wk) AS s
        FROM pos p JOIN (SELECT customer_id, count(DISTINCT week) AS wk FROM pos GROUP BY 1) w
        USING (customer_id) GROUP BY 1, 2),
scored AS (SELECT frame.*, CAST(coalesce(loy.s, 0.0) AS DOUBLE) AS probabilidad_compra
           FROM frame LEFT JOIN loy USING (customer_id, product_id))
"""


def _baseline(spark, sf):
    raw = load_raw(spark, sf, "brand")
    purchases = G.weekly_purchases(raw[0]).where(F.col("comprado") == 1)
    return SC.baseline_scored(G.build_grid(*raw), purchases)


@query("scoring_frame", GRID_ALL + FRAME_SQL + "SELECT * FROM frame")
def q_scoring_frame(spark, sf):
    """Every customer x product pair for the week after the grid's last week,
    with each side's latest attributes."""
    return SC.scoring_frame(G.build_grid(*load_raw(spark, sf, "brand"))).df


@query("next_week_positives", GRID_ALL + FRAME_SQL + """
SELECT customer_id, product_id, week, round(probabilidad_compra, 6) AS probabilidad_compra,
       1 AS prediccion_compra,
       CASE WHEN probabilidad_compra > 0.7 THEN 'high' ELSE 'medium' END AS confidence_level,
       CASE WHEN probabilidad_compra > 0.8 THEN 'immediate_action'
            WHEN probabilidad_compra > 0.6 THEN 'follow_up' ELSE 'moderate_opportunity' END AS action_tier,
       CASE WHEN probabilidad_compra > 0.7 THEN 'high' WHEN probabilidad_compra >= 0.5 THEN 'medium'
            WHEN probabilidad_compra >= 0.3 THEN 'moderate' ELSE 'low' END AS probability_band
FROM scored WHERE probabilidad_compra > 0.5""")
def q_next_week_positives(spark, sf):
    """P11 + W3 + S7-S10 on the loyalty baseline: the ranked list of pairs
    predicted to buy next week, with their tiers."""
    scored = _baseline(spark, sf)
    ranked = score_tiers(scored).where(F.col("prediccion_compra") == 1)
    return (ranked.orderBy(F.col("probabilidad_compra").desc(), "customer_id", "product_id")
            .select("customer_id", "product_id", "week",
                    r6(F.col("probabilidad_compra")).alias("probabilidad_compra"),
                    "prediccion_compra", "confidence_level", "action_tier", "probability_band"))


@query("score_tiers_all", GRID_ALL + FRAME_SQL + """
SELECT customer_id, product_id, round(probabilidad_compra, 6) AS probabilidad_compra,
       CAST(probabilidad_compra > 0.5 AS INTEGER) AS prediccion_compra,
       CASE WHEN probabilidad_compra > 0.5 THEN CASE WHEN probabilidad_compra > 0.7 THEN 'high' ELSE 'medium' END
            WHEN probabilidad_compra < 0.3 THEN 'high' ELSE 'medium' END AS confidence_level,
       CASE WHEN probabilidad_compra > 0.8 THEN 'immediate_action' WHEN probabilidad_compra > 0.6 THEN 'follow_up'
            WHEN probabilidad_compra > 0.5 THEN 'moderate_opportunity' WHEN probabilidad_compra < 0.2 THEN 'low_priority'
            ELSE 'latent_potential' END AS action_tier,
       CASE WHEN probabilidad_compra > 0.7 THEN 'high' WHEN probabilidad_compra >= 0.5 THEN 'medium'
            WHEN probabilidad_compra >= 0.3 THEN 'moderate' ELSE 'low' END AS probability_band
FROM scored""")
def q_score_tiers_all(spark, sf):
    """S7-S10 for every scored pair, positive or not."""
    return score_tiers(_baseline(spark, sf)).select(
        "customer_id", "product_id", r6(F.col("probabilidad_compra")).alias("probabilidad_compra"),
        "prediccion_compra", "confidence_level", "action_tier", "probability_band")


GAPPY = """, gappy AS (SELECT customer_id, product_id, week,
    CASE WHEN (customer_id + product_id + weekofyear(week)) % 3 <> 0 THEN customer_type END AS customer_type,
    CASE WHEN (customer_id * 7 + product_id + weekofyear(week)) % 4 = 0 AND customer_id % 11 <> 0 THEN Y + weekofyear(week) END AS Y,
    CASE WHEN customer_id % 13 <> 0 THEN num_deliver_per_week END AS num_deliver_per_week FROM grid)
"""


def _gappy(spark, sf):
    g = G.build_grid(*load_raw(spark, sf, "brand"))
    # the week of year by its place in the spine: a calendar sum per grid row costs more than all else
    numbers = [r.n for r in g.weeks().select("week", F.weekofyear("week").alias("n")).orderBy("week").collect()]
    first = F.unix_micros(F.lit(g.first_week).cast("timestamp"))
    place = F.call_function("div", F.unix_micros("week") - first, F.lit(7 * 86_400_000_000)).cast("int")
    w, c, p = F.get(F.array(*[F.lit(n) for n in numbers]), place), F.col("customer_id"), F.col("product_id")
    return g.df.select("customer_id", "product_id", "week",
                    F.when((c + p + w) % 3 != 0, F.col("customer_type")).alias("customer_type"),
                    F.when(((c * 7 + p + w) % 4 == 0) & (c % 11 != 0), F.col("Y") + w).alias("Y"),
                    F.when(c % 13 != 0, F.col("num_deliver_per_week")).alias("num_deliver_per_week"))


@query("latest_attributes", GRID_ALL + GAPPY + """
SELECT customer_id,
       arg_max(customer_type, CASE WHEN customer_type IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS customer_type,
       arg_max(Y, CASE WHEN Y IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS Y,
       arg_max(num_deliver_per_week, CASE WHEN num_deliver_per_week IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END)
         AS num_deliver_per_week
FROM gappy GROUP BY customer_id""")
def q_latest_attributes(spark, sf):
    """A3 / W6 from the rows of a grid whose attributes have gaps: the last
    non-null value per customer and column."""
    return SC.latest_attributes(_gappy(spark, sf), "customer_id", ["customer_type", "Y", "num_deliver_per_week"], "product_id")


@query("gap_fill", GRID_ALL + GAPPY + """, la AS (SELECT customer_id,
       arg_max(customer_type, CASE WHEN customer_type IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS customer_type,
       arg_max(Y, CASE WHEN Y IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS Y,
       arg_max(num_deliver_per_week, CASE WHEN num_deliver_per_week IS NOT NULL THEN epoch_ms(week) * 1000 + product_id END) AS n
FROM gappy GROUP BY customer_id)
SELECT customer_id, coalesce(customer_type, 'Unknown') AS customer_type,
       round(coalesce(Y, (SELECT quantile_cont(Y, 0.5) FROM la)), 6) AS Y,
       round(coalesce(CAST(n AS DOUBLE), (SELECT quantile_cont(CAST(n AS DOUBLE), 0.5) FROM la)), 6) AS num_deliver_per_week
FROM la""")
def q_gap_fill(spark, sf):
    """A15 + F12: gaps that no week fills get 'Unknown' or the median, also a
    median between two integers."""
    cols = ["customer_type", "Y", "num_deliver_per_week"]
    la = reliable_checkpoint(SC.latest_attributes(_gappy(spark, sf), "customer_id", cols, "product_id"))
    out = SC.fill_gaps(la, cols, 1)
    return out.select("customer_id", "customer_type", r6(F.col("Y")).alias("Y"),
                      r6(F.col("num_deliver_per_week").cast("double")).alias("num_deliver_per_week"))


@query("null_profile", GRID_ALL + GAPPY + """
SELECT 'customer_type' AS column_name, count(*) - count(customer_type) AS nulls FROM gappy UNION ALL
SELECT 'Y', count(*) - count(Y) FROM gappy UNION ALL
SELECT 'num_deliver_per_week', count(*) - count(num_deliver_per_week) FROM gappy""")
def q_null_profile(spark, sf):
    """A15 as a table."""
    n = SC.null_counts(_gappy(spark, sf), ["customer_type", "Y", "num_deliver_per_week"])
    return spark.createDataFrame(list(n.items()), "column_name string, nulls long")


@query("scoring_file_weeks", with_(TX_PART) + """
SELECT DISTINCT week_num, TIMESTAMP '2019-12-30' + INTERVAL 7 DAY * (week_num - 1) AS week, week_num AS week_of_year
FROM (SELECT CAST(weekofyear(purchase_date) AS INTEGER) AS week_num FROM tx UNION ALL
      SELECT CAST(1 + order_id % 53 AS INTEGER) FROM tx)""")
def q_scoring_file_weeks(spark, sf):
    """Every week number a scoring file may carry (1 to 53) becomes a
    week whose ISO number is the same."""
    from weeklens.plans.scoring import file_to_frame
    tx = load_raw(spark, sf)[0]
    n = (tx.select(F.weekofyear("purchase_date").alias("week_num"))
         .unionByName(tx.select((F.col("order_id") % 53 + 1).cast("int").alias("week_num"))).distinct())
    out = file_to_frame(n.withColumn("n", F.col("week_num")))
    return out.select(F.col("n").alias("week_num"), "week", F.weekofyear("week").alias("week_of_year"))


@query("prediction_summary", GRID_ALL + FRAME_SQL + """
SELECT count(*) AS total_combinations,
       count(*) FILTER (WHERE probabilidad_compra > 0.5) AS positive_predictions,
       round(count(*) FILTER (WHERE probabilidad_compra > 0.5) / count(*), 6) AS positive_rate,
       round(coalesce(avg(probabilidad_compra) FILTER (WHERE probabilidad_compra > 0.5), 0), 6)
         AS avg_probability,
       round(coalesce(max(probabilidad_compra) FILTER (WHERE probabilidad_compra > 0.5), 0), 6)
         AS max_probability
FROM scored""")
def q_prediction_summary(spark, sf):
    s = SC.prediction_summary(_baseline(spark, sf))
    return s.select("total_combinations", "positive_predictions",
                    *[r6(F.col(c)).alias(c) for c in
                      ("positive_rate", "avg_probability", "max_probability")])


# ------------------------------------------------------------ metrics

def _cells(spark, sf, grain):
    """Weekly purchase cells, checkpointed: the transaction join runs once."""
    return reliable_checkpoint(G.weekly_purchases(load_raw(spark, sf, grain)[0]))


def _cell_weeks(cells):
    return G.week_bounds_of_cells(cells).select(
        F.explode(week_spine(F.col("min_week"), F.col("max_week"))).alias("week"))


def _val_pairs(spark, sf):
    """(score, tp, n) groups of the brand grid's validation weeks, scored by
    loyalty learnt on the training weeks. Built from purchase cells and
    counts: the val grid itself is never materialised."""
    all_cells = _cells(spark, sf, "brand")
    t_end, v_end = S.split_bounds(_cell_weeks(all_cells))
    cells = all_cells.where(F.col("comprado") == 1)
    dims = all_cells.agg(F.count_distinct("customer_id").alias("nc"),
                         F.count_distinct("product_id").alias("np")).first()
    w_val = int(round((v_end - t_end).days / 7))
    train = cells.where(F.col("week") <= F.lit(t_end))
    per_pair = train.groupBy("customer_id", "product_id").agg(F.count("*").alias("k"))
    per_cust = train.groupBy("customer_id").agg(F.count_distinct("week").alias("w"))
    loy = per_pair.join(per_cust, "customer_id").select(
        "customer_id", "product_id", (F.col("k") / F.col("w")).alias("score"))
    val = (cells.where((F.col("week") > F.lit(t_end)) & (F.col("week") <= F.lit(v_end)))
           .groupBy("customer_id", "product_id").agg(F.count("*").alias("tp")))
    pairs = (loy.join(val, ["customer_id", "product_id"], "full")
             .select(F.coalesce("score", F.lit(0.0)).alias("score"),
                     F.coalesce("tp", F.lit(0)).cast("long").alias("tp"),
                     F.lit(w_val).cast("long").alias("n")))
    rest = pairs.agg(F.count("*").alias("k")).select(
        F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("tp"),
        ((F.lit(int(dims.nc) * int(dims.np)) - F.col("k")) * w_val).cast("long").alias("n"))
    return pairs.unionByName(rest)


EVAL_SQL = GRID_ALL + """, r AS (SELECT week, row_number() OVER (ORDER BY week) AS wr, count(*) OVER () AS n
           FROM (SELECT DISTINCT week FROM grid)),
lab AS (SELECT week, CASE WHEN wr <= floor(n * 0.7) THEN 'train'
                          WHEN wr <= floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split
        FROM r),
g2 AS (SELECT grid.*, lab.split FROM grid JOIN lab USING (week)),
tr AS (SELECT customer_id, product_id, week FROM g2 WHERE split = 'train' AND comprado = 1),
loy AS (SELECT t.customer_id, t.product_id, count(*) / max(w.wk) AS s
        FROM tr t JOIN (SELECT customer_id, count(DISTINCT week) AS wk FROM tr GROUP BY 1) w
        USING (customer_id) GROUP BY 1, 2),
v AS (SELECT g2.comprado AS y, CAST(coalesce(loy.s, 0.0) AS DOUBLE) AS s
      FROM g2 LEFT JOIN loy USING (customer_id, product_id) WHERE split = 'val')
"""


@query("eval_metrics", EVAL_SQL + """, h AS (SELECT s, sum(y) AS tp, count(*) AS n FROM v GROUP BY s),
c AS (SELECT tp, sum(tp) OVER (ORDER BY s DESC) AS ctp, sum(n) OVER (ORDER BY s DESC) AS cn FROM h),
ap AS (SELECT sum(tp * ctp / cn) / sum(tp) AS average_precision FROM c),
m AS (SELECT count(*) AS n_rows, sum(y) AS positives,
             count(*) FILTER (WHERE s > 0.5) AS pp, sum(y) FILTER (WHERE s > 0.5) AS tpp,
             count(*) FILTER (WHERE s <= 0.5 AND y = 0) AS tn,
             min(s) AS mn, max(s) AS mx, avg(s) AS mean, quantile_cont(s, 0.5) AS med FROM v)
SELECT n_rows, positives,
       round(coalesce(average_precision, 0), 6) AS average_precision,
       round(CASE WHEN pp > 0 THEN tpp / pp ELSE 0 END, 6) AS precision,
       round(CASE WHEN positives > 0 THEN coalesce(tpp, 0) / positives ELSE 0 END, 6) AS recall,
       round(CASE WHEN pp + positives > 0 THEN 2 * coalesce(tpp, 0) / (pp + positives) ELSE 0 END, 6)
         AS f1_score,
       round((coalesce(tpp, 0) + tn) / n_rows, 6) AS accuracy,
       round(mn, 6) AS score_min, round(mx, 6) AS score_max, round(mean, 6) AS score_mean,
       round(med, 6) AS score_median
FROM m, ap""")
def q_eval_metrics(spark, sf):
    """A8-A10 of the loyalty baseline on the validation weeks; the oracle
    scores the materialised validation grid row by row."""
    return M.all_metrics(_val_pairs(spark, sf)).select(
        "n_rows", "positives", *[r6(F.col(c)).alias(c) for c in
                                 ("average_precision", "precision", "recall", "f1_score", "accuracy", "score_min",
                                  "score_max", "score_mean", "score_median")])


@query("class_balance", GRID_ALL + """
SELECT comprado, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share,
       round(sum(count(*)) OVER () / (2.0 * count(*)), 6) AS class_weight
FROM grid GROUP BY comprado""")
def q_class_balance(spark, sf):
    cb = M.class_balance(G.build_grid(*load_raw(spark, sf, "brand")).class_counts())
    return cb.select("comprado", "n", r6(F.col("share")).alias("share"),
                     r6(F.col("class_weight")).alias("class_weight"))


# ------------------------------------------------------------ features

def _brand_split(spark, sf):
    g = G.build_grid(*load_raw(spark, sf, "brand"))
    return S.temporal_split(g.df, weeks=g.weeks())


def _num_sql(c):
    x = f"coalesce(CAST({c} AS DOUBLE), (SELECT med FROM m_{c}))"
    return f"""m_{c} AS (SELECT quantile_cont({c}, 0.5) AS med FROM train),
q_{c} AS (SELECT quantile_cont({x}, 0.03) AS lo, quantile_cont({x}, 0.97) AS hi0 FROM train),
b_{c} AS (SELECT lo, CASE WHEN hi0 > lo THEN hi0 ELSE lo + 1e-6 END AS hi FROM q_{c}),
s_{c} AS (SELECT avg(least(greatest({x}, lo), hi)) AS mu, stddev_pop(least(greatest({x}, lo), hi)) AS sd
          FROM train, b_{c})"""


def _num_rows(c):
    return f"""SELECT '{c}' AS feature, 'median' AS stat, med AS value, NULL AS text FROM m_{c}
UNION ALL SELECT '{c}', 'winsor_lower', lo, NULL FROM b_{c}
UNION ALL SELECT '{c}', 'winsor_upper', hi, NULL FROM b_{c}
UNION ALL SELECT '{c}', 'mean', mu, NULL FROM s_{c}
UNION ALL SELECT '{c}', 'scale', CASE WHEN sd > 0 THEN sd ELSE 1 END, NULL FROM s_{c}"""


FIT_NUM = ["region_id", "Y", "X", "num_deliver_per_week"]
FIT_CAT = ["customer_type", "brand"]
FIT_SQL = (EVAL_SQL + ", train AS (SELECT * FROM g2 WHERE split = 'train'),\n"
           + ",\n".join(_num_sql(c) for c in FIT_NUM) + """,
ed AS (SELECT unnest(quantile_cont(CAST(num_deliver_per_week AS DOUBLE),
                     [0, 1/7, 2/7, 3/7, 4/7, 5/7, 6/7, 1])) AS e,
              unnest(range(8)) AS i FROM train),
ek AS (SELECT e, i, e - lag(e) OVER (ORDER BY i) AS gap FROM ed),
edges AS (SELECT e, row_number() OVER (ORDER BY i) - 1 AS k FROM ek WHERE gap IS NULL OR gap > 1e-8),
modes AS (SELECT column_name, value FROM (
   SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS r
   FROM (SELECT 'customer_type' AS column_name, customer_type AS value, count(*) AS n FROM train
         WHERE customer_type IS NOT NULL GROUP BY 2
         UNION ALL SELECT 'brand', brand, count(*) FROM train WHERE brand IS NOT NULL GROUP BY 2)) WHERE r = 1),
wk AS (SELECT avg(CAST(weekofyear(week) AS DOUBLE)) AS mu, stddev_pop(CAST(weekofyear(week) AS DOUBLE)) AS sd
       FROM train)
SELECT feature, stat, round(value, 6) AS value, text FROM (
""" + "\nUNION ALL ".join(_num_rows(c) for c in FIT_NUM) + """
UNION ALL SELECT 'num_deliver_per_week', 'edge_' || CAST(k AS VARCHAR), e, NULL FROM edges
UNION ALL SELECT column_name, 'mode', NULL, value FROM modes
UNION ALL SELECT 'week', 'mean', mu, NULL FROM wk
UNION ALL SELECT 'week', 'scale', CASE WHEN sd > 0 THEN sd ELSE 1 END, NULL FROM wk)""")


def _train_parts(spark, sf):
    """The grid and its training split as weighted spines."""
    g = G.build_grid(*load_raw(spark, sf, "brand"))
    t_end, _ = S.split_bounds(g.weeks())
    weeks = g.weeks().where(F.col("week") <= F.lit(t_end))
    w_train = weeks.count()
    return g, [(g.customers.withColumn("_w", F.lit(g.n_products * w_train)), "_w"),
               (g.products.withColumn("_w", F.lit(g.n_customers * w_train)), "_w"),
               (weeks.withColumn("_w", F.lit(g.n_customers * g.n_products)), "_w")]


@query("feature_fit", FIT_SQL)
def q_feature_fit(spark, sf):
    """F1, F2, F4, F5, F7, F9 fitted on the whole training split of the grid,
    by the grid identity: the customer spine weighs products x training
    weeks, each product customers x training weeks, each week customers x
    products. The oracle fits on the materialised split row by row."""
    g, parts = _train_parts(spark, sf)
    ff = FE.fit_features_weighted(parts, FE.FeatureSpec.for_frame(g.df))
    rows = FE.fitted_table(ff)
    df = spark.createDataFrame(rows, "feature string, stat string, value double, text string")
    return df.select("feature", "stat", r6(F.col("value")).alias("value"), "text")


@query("feature_fit_robust", EVAL_SQL + """, train AS (SELECT * FROM g2 WHERE split = 'train'),
imp AS (SELECT """ + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM train)) AS {c}"
    for c in FIT_NUM) + """ FROM train)
SELECT feature, stat, round(value, 6) AS value, CAST(NULL AS VARCHAR) AS text FROM (
""" + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, 'median' AS stat, (SELECT quantile_cont({c}, 0.5) FROM train) AS value
UNION ALL SELECT '{c}', 'center', quantile_cont({c}, 0.5) FROM imp
UNION ALL SELECT '{c}', 'scale', CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) > 0
  THEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) ELSE 1 END FROM imp""" for c in FIT_NUM) + ")")
def q_feature_fit_robust(spark, sf):
    """F6 (the production trainer's scaling): median impute, centre at the
    median, scale by the interquartile range, on the whole training split."""
    _, parts = _train_parts(spark, sf)
    ff = FE.fit_features_weighted(parts, FE.FeatureSpec(FIT_NUM, [], [], False, scaler="robust"))
    df = spark.createDataFrame(FE.fitted_table(ff), "feature string, stat string, value double, text string")
    return df.select("feature", "stat", r6(F.col("value")).alias("value"), "text")


@query("feature_transform", FIT_SQL.split("SELECT feature, stat, round(value, 6)")[0] + """
SELECT c.customer_id,
""" + ",\n".join(f"""round((least(greatest(coalesce(CAST(c.{x} AS DOUBLE), m_{x}.med), b_{x}.lo), b_{x}.hi) - s_{x}.mu)
  / CASE WHEN s_{x}.sd > 0 THEN s_{x}.sd ELSE 1 END, 6) AS num_{x}""" for x in FIT_NUM) + """,
CAST((SELECT count(*) FROM edges WHERE k > 0 AND k < (SELECT max(k) FROM edges) AND c.num_deliver_per_week >= e) AS DOUBLE)
  AS disc_num_deliver_per_week,
coalesce(c.customer_type, (SELECT value FROM modes WHERE column_name = 'customer_type')) AS cat_customer_type
FROM (SELECT customer_id, customer_type, region_id, zone_id, X, num_deliver_per_week,
             CASE WHEN customer_id % 5 = 0 THEN NULL ELSE Y END AS Y FROM cust
      WHERE customer_id IN (SELECT customer_id FROM tx)) c, """
       + ", ".join(f"m_{x}, b_{x}, s_{x}" for x in FIT_NUM))
def q_feature_transform(spark, sf):
    """F1-F8 applied: imputed, clipped and scaled numbers, bin numbers and filled
    categories of every customer of the grid (a fifth without Y)."""
    from pyspark.ml.feature import SQLTransformer
    g, parts = _train_parts(spark, sf)
    ff = FE.fit_features_weighted(parts, FE.FeatureSpec(FIT_NUM, FE.DISCRETIZE_FEATURES, ["customer_type"], False))
    rows = g.customers.withColumn("Y", F.when(F.col("customer_id") % 5 != 0, F.col("Y")))
    out = SQLTransformer(statement=ff.statement()).transform(rows)
    return out.select("customer_id", *[r6(F.col(f"__num_{c}")).alias(f"num_{c}") for c in FIT_NUM],
                      F.col("__disc_num_deliver_per_week").alias("disc_num_deliver_per_week"),
                      F.col("__cat_customer_type").alias("cat_customer_type"))


@query("winsor_refit", with_(CUST) + """, q AS (SELECT quantile_cont(Y, 0.03) AS lo, quantile_cont(Y, 0.97) AS hi FROM cust)
SELECT customer_id, round(least(greatest(Y, lo), hi), 6) AS Y FROM cust, q""")
def q_winsor_refit(spark, sf):
    """F4 refitted on the batch it transforms."""
    c = FE.winsorize(load_raw(spark, sf)[1], ["Y"], 3, 97, refit=True)
    return c.select("customer_id", r6(F.col("Y")).alias("Y"))


# ------------------------------------------------------------ model (M1-M10, IO8)

_MODELS: dict = {}


def trained(spark, sf, tune=False, n_trials=3):
    """One fit per (application, data dir, search setting); later queries of the
    same application reuse it. The fit is seeded, so it does not matter which
    query asks first, and nothing stays persisted."""
    key = (spark.sparkContext.applicationId, sf, tune, n_trials)
    if key not in _MODELS:
        g = G.build_grid(*load_raw(spark, sf, "brand"))
        _, va, _ = S.temporal_split(g.df, weeks=g.weeks())
        sample, judged = MD.training_frames(g)
        _MODELS[key] = (MD.train(sample, judged, tune=tune, n_trials=n_trials, train_cap=None,
                                 parallelism=4), va)
    return _MODELS[key]


MODEL_SQL = GRID_ALL + SPLIT_SQL + """, d AS (SELECT count(DISTINCT customer_id) * count(DISTINCT product_id) AS pairs FROM tx),
n AS (SELECT count(*) FILTER (WHERE split = 'train') AS tw, count(*) FILTER (WHERE split = 'val') AS vw FROM lab)
"""


@query("model_checks", MODEL_SQL + """
SELECT least(50000, pairs * tw) AS train_samples, pairs * vw AS val_samples, pairs AS scored_pairs,
       true AS probabilities_in_range, true AS reload_equal, CAST(1.0 AS DOUBLE) AS importance_sum, true AS ranked
FROM d, n""")
def q_model_checks(spark, sf):
    """What must hold of any trained forest: it was fitted on the capped rows and
    judged on every validation cell, scores every pair of next week within
    [0, 1], comes back the same from disk, and the ranked list is in order."""
    res, va = trained(spark, sf)
    g = G.build_grid(*load_raw(spark, sf, "brand"))
    path = IO.new_stage_path(spark, "model")
    model = MD.save_model(res.model, path)
    frame = SC.scoring_frame(g)
    cols = ["customer_id", "product_id", "probabilidad_compra"]
    a = reliable_checkpoint(MD.score_pairs(res.model, res.features, frame).select(*cols))
    b = MD.score_pairs(model, res.features, frame).select("customer_id", "product_id", F.col("probabilidad_compra").alias("again"))
    both = a.join(b, ["customer_id", "product_id"]).agg(
        F.count("*").alias("scored_pairs"),
        F.min(F.col("probabilidad_compra").between(0, 1)).alias("probabilities_in_range"),
        F.min(F.col("probabilidad_compra") == F.col("again")).alias("reload_equal")).first()
    ranked = [r[0] for r in SC.positives_ranked(a.withColumn("week", F.lit(None).cast("timestamp")))
              .select("probabilidad_compra").toLocalIterator()]
    row = (res.train_rows, res.val_rows, both.scored_pairs, both.probabilities_in_range, both.reload_equal,
           round(float(sum(res.model.stages[-1].featureImportances.toArray())), 6),
           all(x >= y for x, y in zip(ranked, ranked[1:])) and all(x > 0.5 for x in ranked))
    return spark.createDataFrame([row], "train_samples long, val_samples long, scored_pairs long, "
                                 "probabilities_in_range boolean, reload_equal boolean, importance_sum double, ranked boolean")


@query("grid_sample", MODEL_SQL + """
SELECT least(50000, pairs * tw) AS n_rows, least(50000, pairs * tw) AS n_cells, true AS rows_of_the_grid,
       true AS positives_as_expected FROM d, n""")
def q_grid_sample(spark, sf):
    """M2: the sample the forest is fitted on, drawn by cell numbers: its size,
    its distinct cells, whether every cell is one of the training weeks' with the
    label of the purchases, and whether its positives are as many as a uniform
    draw gives (within five deviations)."""
    g = G.build_grid(*load_raw(spark, sf, "brand"))
    t_end, _ = S.split_bounds(g.weeks())
    rows = reliable_checkpoint(g.sample(MD.TRAIN_CAP, last_week=t_end).select(*G.KEYS, G.LABEL))
    bought = g.cells.where((F.col(G.LABEL) == 1) & (F.col("week") <= F.lit(t_end))).select(*G.KEYS, F.lit(1).alias("_bought"))
    right = (F.col(G.LABEL) == F.coalesce("_bought", F.lit(0))) & F.col("week").between(F.lit(g.first_week), F.lit(t_end))
    found = (rows.join(bought, G.KEYS, "left")
             .join(g.customers.select("customer_id", F.lit(True).alias("_c")), "customer_id", "left")
             .join(g.products.select("product_id", F.lit(True).alias("_p")), "product_id", "left")
             .agg(F.count("*").alias("n_rows"), F.count_distinct(*G.KEYS).alias("n_cells"),
                  F.min(right & F.col("_c").isNotNull() & F.col("_p").isNotNull()).alias("rows_of_the_grid"),
                  F.sum(G.LABEL).alias("_hit")))
    weeks = int(round((t_end - g.first_week).days / 7)) + 1
    share = bought.count() / (g.n_customers * g.n_products * weeks)
    n = F.col("n_rows")
    near = F.abs(F.col("_hit") - n * share) <= 5 * F.sqrt(n * share) + 1
    return found.select("n_rows", "n_cells", "rows_of_the_grid", near.alias("positives_as_expected"))


@query("train_model_full")
def q_train_model_full(spark, sf):
    """The full trainer variant: regions and zones as categories, its fixed
    defaults; metrics on all validation cells."""
    g = G.build_grid(*load_raw(spark, sf, "brand"))
    res = MD.train_full(*MD.training_frames(g), train_cap=None)
    keys = ["average_precision", "precision", "recall", "f1_score"]
    row = (res.train_rows, res.val_rows, *[float(res.metrics[k] or 0) for k in keys],
           ",".join(res.features.spec.numeric), ",".join(res.features.spec.categorical))
    return spark.createDataFrame([row], "train_samples long, val_samples long, "
                                 + ", ".join(f"{k} double" for k in keys) + ", numeric string, categorical string")


@query("train_model")
def q_train_model(spark, sf):
    """The forest with the default parameters, trained on
    the capped training weeks, with its validation metrics."""
    res, _ = trained(spark, sf)
    m = res.metrics
    row = (res.train_rows, res.val_rows, *[float(m[k] or 0) for k in
           ("average_precision", "precision", "recall", "f1_score")],
           int(res.params["n_estimators"]), int(res.params["max_depth"]),
           str(res.params["max_features"]))
    return spark.createDataFrame([row], "train_samples long, val_samples long, "
                                 "average_precision double, precision double, recall double, "
                                 "f1_score double, n_estimators int, max_depth int, max_features string")


@query("train_trials")
def q_train_trials(spark, sf):
    """M3: seeded random search over the fast space on the fixed validation
    weeks, as many trials as the weekly run draws."""
    res, _ = trained(spark, sf, tune=True, n_trials=30)
    cols = ["trial_number", "n_bins", "winsor_lower", "winsor_upper", "n_estimators",
            "max_depth", "max_features", "average_precision", "precision", "recall", "f1_score"]
    rows = [tuple(t[c] if c != "max_features" else str(t[c]) for c in cols) for t in res.trials]
    return spark.createDataFrame(rows, "trial_number int, n_bins int, winsor_lower int, "
                                 "winsor_upper int, n_estimators int, max_depth int, "
                                 "max_features string, average_precision double, "
                                 "precision double, recall double, f1_score double")


@query("train_model_production")
def q_train_model_production(spark, sf):
    """The production trainer variant (robust scaling, week of year as a
    category, fixed parameters, threshold 0.2), fitted on every cell of the
    training weeks; metrics on train and validation and the validation score
    stats."""
    g = G.build_grid(*load_raw(spark, sf, "brand"))
    res = MD.train_production(*MD.training_parts(g))
    m = res.metrics
    keys = ["train_average_precision", "train_precision", "train_recall", "train_f1_score",
            "val_average_precision", "val_precision", "val_recall", "val_f1_score",
            "val_score_min", "val_score_max", "val_score_mean", "val_score_median",
            "positive_rate_train", "positive_rate_val", "threshold"]
    row = (res.train_rows, res.val_rows, *[float(m[k] or 0) for k in keys])
    return spark.createDataFrame([row], "train_samples long, val_samples long, "
                                 + ", ".join(f"{k} double" for k in keys))


@query("model_importance")
def q_model_importance(spark, sf):
    res, _ = trained(spark, sf)
    return EX.importance(spark, res.model, res.features, 20)


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    res, va = trained(spark, sf)
    return EX.permutation_importance(res.model, res.features, va, total=res.val_rows)


@query("partial_dependence")
def q_partial_dependence(spark, sf):
    res, va = trained(spark, sf)
    return EX.partial_dependence(spark, res.model, res.features, va, total=res.val_rows)


@query("score_next_week")
def q_score_next_week(spark, sf):
    """M6: every pair of the grid scored by the forest for next week; the
    positives, highest first."""
    res, _ = trained(spark, sf)
    grid = G.build_grid(*load_raw(spark, sf, "brand"))
    scored = MD.score_pairs(res.model, res.features, SC.scoring_frame(grid))
    return SC.positives_ranked(scored)


@query("score_next_week_summary")
def q_score_next_week_summary(spark, sf):
    res, _ = trained(spark, sf)
    grid = G.build_grid(*load_raw(spark, sf, "brand"))
    return SC.prediction_summary(MD.score_pairs(res.model, res.features, SC.scoring_frame(grid)))


# ------------------------------------------------------------ profile (A17-A19), extraction

@query("profile_dataset", with_(TX_PART, CUST, PROD_PART) + """
SELECT (SELECT count(*) FROM tx) AS transactions,
       (SELECT count(DISTINCT customer_id) FROM cust) AS customers_registered,
       (SELECT count(DISTINCT customer_id) FROM tx) AS customers_active,
       (SELECT count(DISTINCT product_id) FROM prod) AS products_catalogue,
       (SELECT count(DISTINCT product_id) FROM tx) AS products_sold,
       (SELECT count(DISTINCT order_id) FROM tx) AS orders,
       (SELECT min(purchase_date) FROM tx) AS first_date,
       (SELECT max(purchase_date) FROM tx) AS last_date""")
def q_profile_dataset(spark, sf):
    return PR.dataset_profile(*load_raw(spark, sf))


PROFILE_NUM_CUST = ["region_id", "zone_id", "Y", "X", "num_deliver_per_week"]


@query("profile_numeric", with_(CUST, PROD_PART) + """, u AS (
""" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM cust"
                         for c in PROFILE_NUM_CUST)
   + """ UNION ALL SELECT 'size', size FROM prod)
SELECT column_name, count(v) AS n, count(DISTINCT v) AS n_distinct, round(min(v), 6) AS min,
       round(max(v), 6) AS max, round(quantile_cont(v, 0.5), 6) AS median
FROM u GROUP BY column_name""")
def q_profile_numeric(spark, sf):
    _, cust, prod = load_raw(spark, sf)
    p = PR.numeric_profile(cust, PROFILE_NUM_CUST).unionByName(PR.numeric_profile(prod, ["size"]))
    return p.select("column_name", "n", "n_distinct",
                    *[r6(F.col(c)).alias(c) for c in ("min", "max", "median")])


@query("category_share", with_(CUST, PROD_PART) + """, u AS (
  SELECT 'customer_type' AS column_name, customer_type AS value, 'c' AS t FROM cust
  UNION ALL SELECT 'brand', brand, 'p' FROM prod UNION ALL SELECT 'sub_category', sub_category, 'p' FROM prod
  UNION ALL SELECT 'segment', segment, 'p' FROM prod UNION ALL SELECT 'package', package, 'p' FROM prod)
SELECT column_name, value, count(*) AS n,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY column_name), 6) AS pct
FROM u GROUP BY column_name, value""")
def q_category_share(spark, sf):
    _, cust, prod = load_raw(spark, sf)
    c = PR.category_share(cust, ["customer_type"]).unionByName(
        PR.category_share(prod, ["brand", "sub_category", "segment", "package"]))
    return c.select("column_name", "value", "n", r6(F.col("pct")).alias("pct"))


@query("busiest_weeks", with_(TX_PART) + """
SELECT weekofyear(purchase_date) AS week_of_year, count(*) AS transactions
FROM tx GROUP BY 1 ORDER BY transactions DESC, week_of_year LIMIT 10""")
def q_busiest_weeks(spark, sf):
    return PR.busiest_weeks(load_raw(spark, sf)[0], 10)


def _star(spark, sf):
    g = G.build_grid(*load_raw(spark, sf, "brand"))
    return PR.grid_to_star(g, SC.customer_columns(g.df), SC.product_columns(g.df))


@query("star_purchases", GRID_ALL + """
SELECT row_number() OVER (ORDER BY week, customer_id, product_id) AS order_id,
       customer_id, product_id, week AS purchase_date
FROM grid WHERE comprado = 1""")
def q_star_purchases(spark, sf):
    """X1 + W7: the purchase table recovered from the grid, order ids dense in
    (week, customer, product) order."""
    return _star(spark, sf)[0]


@query("star_customers_from_rows", GRID_ALL + """
SELECT DISTINCT customer_id, customer_type, region_id, zone_id, Y, X, num_deliver_per_week FROM grid""")
def q_star_customers_from_rows(spark, sf):
    """X1 from the rows of a grid frame, as for a stored or merged grid."""
    df = G.build_grid(*load_raw(spark, sf, "brand")).df
    return PR.grid_to_star(df, SC.customer_columns(df), SC.product_columns(df))[1]


@query("star_customers", GRID_ALL + """
SELECT DISTINCT customer_id, customer_type, region_id, zone_id, Y, X, num_deliver_per_week FROM grid""")
def q_star_customers(spark, sf):
    return _star(spark, sf)[1]


# ------------------------------------------------------------ sinks and file scoring (IO2-IO4, M7, P12)

@query("incremental_merge_by_week", INCR_SQL + "SELECT * FROM combined")
def q_incremental_merge_by_week(spark, sf):
    """U2, IO6, IO7 in a versioned store: the history is committed and kept
    under a name, the new grid is merged by writing its own weeks only, and the
    earlier version is still there; the result is that of ``incremental_merge``."""
    from weeklens.operators.incremental import merge_weeks
    from weeklens.sources.versions import Versions
    hist_tx, new_tx, cust, prod = _windows(spark, sf)
    store = Versions(spark, IO.new_stage_path(spark, "versions"))
    history = G.build_grid(hist_tx, cust, prod)
    merge_weeks(store, "state", history)
    store.snapshot("history")
    before = store.folders("state")
    new = G.build_grid(new_tx, cust, prod)
    merge_weeks(store, "state", new)
    if len(store.folders("state") - before) != new.n_weeks or store.read("state", tag="history").count() != history.n_cells:
        raise RuntimeError("the merge wrote other weeks than its own, or changed the snapshot")
    return store.read("state")


@query("stage_roundtrip", with_(TX_PART) + """
SELECT customer_id, product_id, week,
       max(CASE WHEN order_id IS NOT NULL THEN 1 ELSE 0 END) AS comprado
FROM tx GROUP BY 1, 2, 3""")
def q_stage_roundtrip(spark, sf):
    """IO2: weekly purchases written partitioned by week to the shared folder
    and read back."""
    path = IO.new_stage_path(spark, "weekly_purchases")
    IO.write_stage(G.weekly_purchases(load_raw(spark, sf)[0]), path, ["week"])
    back = IO.read_stage(spark, path)
    return back.select("customer_id", "product_id", F.col("week").cast("timestamp"), "comprado")


@query("score_file")
def q_score_file(spark, sf):
    """M7: the next-week pairs exported as a ten-column scoring file (CSV),
    read back with the required-column check, scored by the forest; the
    positives ranked with their tiers."""
    from weeklens.plans.scoring import export_scoring_file, score_file
    res, _ = trained(spark, sf)
    grid = G.build_grid(*load_raw(spark, sf, "brand"))
    path = IO.new_stage_path(spark, "scoring_file")
    export_scoring_file(SC.scoring_frame(grid).df, path)
    return score_file(spark, res.model, path, res.features)


LINE_SQL = with_(CUST) + """, f AS (SELECT customer_id AS c, customer_type,
  CASE WHEN customer_id % 11 = 0 THEN 'n/a' ELSE CAST(region_id AS VARCHAR) END AS y,
  CASE WHEN customer_id % 13 = 0 THEN 'w' || customer_id ELSE CAST(1 + customer_id % 52 AS VARCHAR) END AS w FROM cust),
l AS (SELECT *, CASE WHEN c % 17 = 0 THEN coalesce(customer_type, '') || ',' || y
  ELSE coalesce(customer_type, '') || ',' || y || ',1.5,2,b,,,,3.0,' || w END AS line FROM f)
"""


@query("scoring_file_parts", LINE_SQL + """
SELECT 'scored' AS part, '' AS line, '' AS reason, count(*) AS n FROM l WHERE c % 11 > 0 AND c % 13 > 0 AND c % 17 > 0
UNION ALL
SELECT 'rejected', line, CASE WHEN c % 17 = 0 THEN 'number of cells' WHEN c % 11 = 0 AND c % 13 = 0 THEN 'Y: n/a; week_num: ' || w
  WHEN c % 11 = 0 THEN 'Y: n/a' ELSE 'week_num: ' || w END, count(*)
FROM l WHERE c % 11 = 0 OR c % 13 = 0 OR c % 17 = 0 GROUP BY 1, 2, 3""")
def q_scoring_file_parts(spark, sf):
    """IO4: a scoring file made of all customers, some lines with a cell that is
    no number or with cells missing: how many rows are good, and every rejected
    line with its reasons."""
    c = F.col("customer_id")
    kind = F.coalesce(F.col("customer_type"), F.lit(""))
    y = F.when(c % 11 == 0, "n/a").otherwise(F.col("region_id").cast("string"))
    w = F.when(c % 13 == 0, F.concat(F.lit("w"), c.cast("string"))).otherwise((1 + c % 52).cast("string"))
    line = F.when(c % 17 == 0, F.concat(kind, F.lit(","), y)).otherwise(
        F.concat(kind, F.lit(","), y, F.lit(",1.5,2,b,,,,3.0,"), w))
    path = IO.new_stage_path(spark, "scoring-lines")
    # whole lines as one column whose name is the header, so that every part file starts with it
    (load_raw(spark, sf)[1].select(line.alias(",".join(IO.SCORING_FILE_SCHEMA.fieldNames())))
     .write.option("header", True).option("sep", "\x01").csv(path))
    good, bad = IO.read_scoring_parts(spark, path)
    scored = good.agg(F.lit("scored").alias("part"), F.lit("").alias("line"), F.lit("").alias("reason"), F.count("*").alias("n"))
    return scored.unionAll(bad.groupBy(F.lit("rejected").alias("part"), "line", F.array_join("reasons", "; ").alias("reason"))
                           .agg(F.count("*").alias("n")))


@query("score_file_totals", MODEL_SQL + """
SELECT pairs AS rows, pairs AS scored, CAST(0 AS BIGINT) AS rejected, true AS positives_as_ranked, true AS scores_in_range FROM d""")
def q_score_file_totals(spark, sf):
    """M7: the totals of a scored file over all its rows, checked against the
    ranked list."""
    from weeklens.plans.scoring import export_scoring_file, score_file_parts
    res, _ = trained(spark, sf)
    path = IO.new_stage_path(spark, "scoring_file")
    export_scoring_file(SC.scoring_frame(G.build_grid(*load_raw(spark, sf, "brand"))).df, path)
    ranked, _, totals = score_file_parts(spark, res.model, path, res.features)
    return totals.select("rows", "scored", "rejected", (F.col("positives") == ranked.count()).alias("positives_as_ranked"),
                         ((F.col("mean_score") <= F.col("max_score")) & (F.col("max_score") <= 1)).alias("scores_in_range"))


# ------------------------------------------------------------ streaming intake (U2 as a stream)

@query("stream_weekly_intake", INCR_SQL + "SELECT * FROM combined")
def q_stream_weekly_intake(spark, sf):
    """The weekly merge run as a Structured Streaming job: the history
    transactions and the last six weeks arrive as two parquet drops (written
    from the tables to the shared folder), each micro-batch is gridded and
    merged into the state table; returns the final state (equal to
    ``incremental_merge``)."""
    import os
    import uuid
    from weeklens.streaming import run_weekly_intake
    hist_tx, new_tx, cust, prod = _windows(spark, sf)
    base = IO.new_stage_path(spark, f"stream-{uuid.uuid4().hex[:8]}")
    drops, state = os.path.join(base, "drops"), os.path.join(base, "state")
    cols = ["order_id", "customer_id", "product_id",
            F.col("purchase_date").cast("timestamp").alias("purchase_date")]
    out = None
    for week_drop in (hist_tx, new_tx):
        # a drop lands in several files, and the job takes them one by one
        week_drop.select(*cols).repartition(4).write.mode("append").parquet(drops)
        out = run_weekly_intake(spark, drops, cust, prod, state, os.path.join(base, "ckpt"), files_per_batch=1)
    return out.withColumn("week", F.col("week").cast("timestamp"))
