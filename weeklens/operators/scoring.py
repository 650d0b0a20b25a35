"""Next-week scoring frame and its summary.

The frame is every customer x product pair of the grid for the week after its
last week. It is generated like the grid: latest attributes are aggregated
per customer and per product (map-side partial aggregation, shuffles of
customer and product size), then each customer row is exploded over the
size-checked product list, so nothing of pair size is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.functions.time import next_week
from weeklens.operators.columns import by_prefix
from weeklens.operators.ordered import histogram, quantiles
from weeklens.sources.tables import CUSTOMER_ATTRIBUTES, PRODUCT_ATTRIBUTES

DROP_FOR_FEATURES = ("comprado", "customer_id", "product_id")


def latest_attributes(grid: DataFrame, key: str, cols: Sequence[str],
                      other: str, week: str = "week") -> DataFrame:
    """A3: per ``key``, each column's last non-null value by week (``other``
    key breaks ties, a null one ranks lowest, then the value itself), as pandas
    ``sort_values(week).groupby(key).last()``.

    Rows are folded twice: first to one row per key and set of values, by the largest (week, other) as one number,
    which a hash aggregate can hold (a struct in its buffer would sort all rows); then those few to the key. A small
    action finds the ranges of ``week`` and ``other``; where they do not fit into a number, rows are folded once by a
    (week, other, value) struct per column."""
    g = grid.where(F.col(key).isNotNull())
    if not cols:
        return g.select(key).distinct()
    at = place_number(g, week, other)
    if at is None:
        at = F.struct(F.col(week), F.col(other))
    elif len({key, *cols}) == 1 + len(cols):
        g, at = g.groupBy(key, *cols).agg(F.max(at).alias("_at")), F.col("_at")
    return (g.groupBy(key).agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("v")))).alias(c)
        for c in cols]).select(key, *[F.col(c)["v"].alias(c) for c in cols]))


DAY = 86_400_000_000


def place_number(df: DataFrame, week: str, other: str) -> Column | None:
    """A long that orders the rows of ``df`` as (``week``, ``other``) does, nulls lowest; None where the two are no
    timestamp or date and whole number, or their ranges are too wide. Runs one single-row aggregate."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if not isinstance(kinds[week], (T.TimestampType, T.DateType)) or not isinstance(kinds[other], T.IntegralType):
        return None
    t = F.unix_micros(week) if isinstance(kinds[week], T.TimestampType) else F.unix_date(week).cast("long") * DAY
    o = F.col(other).cast("long")
    b = df.agg(F.min(t).alias("t0"), F.max(t).alias("t1"), F.max(F.pmod(t, F.lit(DAY))).alias("odd"),
               F.min(o).alias("o0"), F.max(o).alias("o1")).first()
    t0, t1, o0, o1 = (x or 0 for x in (b.t0, b.t1, b.o0, b.o1))
    unit = 1 if b.odd else DAY
    span = o1 - o0 + 2
    if span * ((t1 - t0) // unit + 2) >= 2 ** 62:
        return None
    days = F.call_function("div", t, F.lit(unit)) - F.lit(t0 // unit - 1)
    return F.coalesce(days, F.lit(0)) * F.lit(span).cast("long") + F.coalesce(o - F.lit(o0 - 1), F.lit(0))


def customer_columns(grid: DataFrame) -> list[str]:
    """P9."""
    return [c for c in by_prefix(grid, ["customer_"], CUSTOMER_ATTRIBUTES) if c != "customer_id"]


def product_columns(grid: DataFrame) -> list[str]:
    return [c for c in by_prefix(grid, ["product_"], PRODUCT_ATTRIBUTES) if c != "product_id"]


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> dict:
    """Nulls (NaN counts as null) per column in one pass. Runs one
    single-row aggregate."""
    cols = list(cols or df.columns)
    if not cols:
        return {}
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    missing = {c: F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull() for c in cols}
    row = df.agg(*[F.sum(missing[c].cast("long")).alias(c) for c in cols]).first()
    return {c: int(row[c] or 0) for c in cols}


@dataclass
class ScoringFrame:
    df: DataFrame
    week: object
    n_customers: int
    n_products: int
    customers: DataFrame      # latest customer attributes, one row per customer
    products: DataFrame       # latest product attributes, one row per product


def scoring_frame(grid, fill: bool = True,
                  max_listed_products: int = 10_000, extra_customer: DataFrame | None = None,
                  customer_extra_cols: Sequence[str] = ()) -> ScoringFrame:
    """M6 up to the model: pairs x next week with latest attributes, gaps
    filled (F12). ``grid`` is a grid DataFrame (stored, merged: attributes
    are aggregated from it) or a ``grid.Grid`` just built (its dimension
    spines are the latest attributes, as every row of a key carries the same
    ones, so no pass over the grid rows is needed). ``extra_customer`` lets a
    caller attach per-customer columns (e.g. a map of scores) before the
    product explode.

    Runs small actions: last week and counts, the product list (size-checked),
    null counts of the two attribute tables, medians of gap columns.
    """
    from weeklens.operators.grid import Grid, attach_products
    if isinstance(grid, Grid):
        last = grid.last_week
        ccols = [c for c in grid.customers.columns if c != "customer_id"]
        pcols = [c for c in grid.products.columns if c != "product_id"]
        ci, pi = grid.customers, grid.products
        nc, np_ = grid.n_customers, grid.n_products
    else:
        ccols, pcols = customer_columns(grid), product_columns(grid)
        # one row per customer / per product: small, reused by several actions
        # below, so kept (persist recomputes from lineage if an executor is lost)
        ci = latest_attributes(grid, "customer_id", ccols, "product_id").persist()
        pi = latest_attributes(grid, "product_id", pcols, "customer_id").persist()
        nc, np_ = ci.count(), pi.count()
        last = grid.agg(F.max("week").alias("last")).first().last
    nxt = F.lit(last).cast("timestamp") + F.expr("INTERVAL 7 DAYS")

    if fill:
        ci, pi = fill_gaps(ci, ccols, np_), fill_gaps(pi, pcols, nc)

    rows = ci
    if extra_customer is not None:
        rows = rows.join(extra_customer, "customer_id", "left")
    rows, _ = attach_products(rows.withColumn("week", nxt), pi, max_listed_products)
    frame = rows.select("customer_id", "product_id", "week", *ccols, *pcols,
                        *customer_extra_cols)
    return ScoringFrame(frame, last, nc, np_, ci, pi)


def fill_gaps(attrs: DataFrame, cols: Sequence[str], repeat: int) -> DataFrame:
    """F12 on an attribute table whose rows each stand for ``repeat`` frame
    rows: strings -> 'Unknown', numbers -> the frame median, which is the
    frequency-weighted exact percentile of the attribute table."""
    gaps = [c for c, n in null_counts(attrs, cols).items() if n]
    if not gaps:
        return attrs
    types = dict(attrs.dtypes)
    numeric = [c for c in gaps if types[c] != "string"]
    med = {}
    if numeric:
        hist = histogram([(attrs, {c: F.col(c) for c in numeric}, F.lit(repeat))])
        med = {r.name: r.q[0] for r in quantiles(hist, [0.5]).collect()}
    out = attrs
    for c in gaps:
        # a median may fall between two integers: the filled column is a double then
        fill = F.lit("Unknown") if types[c] == "string" else F.lit(med.get(c)).cast("double")
        value = F.col(c) if types[c] == "string" else F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        out = out.withColumn(c, F.coalesce(value, fill))
    return out


def positives_ranked(scored: DataFrame, p: str = "probabilidad_compra",
                     threshold: float = 0.5) -> DataFrame:
    """P11 + W3: strict ``p > threshold``, highest first (keys break ties).
    The positives are checkpointed before the sort: a global sort samples its
    input first, which would otherwise score every pair twice."""
    from weeklens.session import reliable_checkpoint
    pos = reliable_checkpoint(scored.where(F.col(p) > F.lit(threshold))
                              .select("customer_id", "product_id", "week", p))
    return pos.orderBy(F.col(p).desc(), "customer_id", "product_id")


def prediction_summary(scored: DataFrame, p: str = "probabilidad_compra",
                       threshold: float = 0.5) -> DataFrame:
    """A11 in one aggregate: combinations, positives, rate, mean and max score
    of the positives (0 when there are none)."""
    pos = F.col(p) > F.lit(threshold)
    n = F.count("*")
    k = F.count(F.when(pos, 1))
    return scored.agg(
        n.alias("total_combinations"), k.alias("positive_predictions"),
        F.coalesce(k / F.when(n > 0, n), F.lit(0.0)).alias("positive_rate"),
        F.coalesce(F.avg(F.when(pos, F.col(p))), F.lit(0.0)).alias("avg_probability"),
        F.coalesce(F.max(F.when(pos, F.col(p))), F.lit(0.0)).alias("max_probability"))


def loyalty_scores(positives: DataFrame) -> DataFrame:
    """Baseline propensity per pair: weeks in which the customer bought the
    product / weeks in which the customer bought anything. ``positives`` holds
    the purchase cells (customer, product, week): the weekly purchases, or a
    grid's ``comprado = 1`` rows (the filter pushes down to a stored grid)."""
    if "comprado" in positives.columns:
        positives = positives.where(F.col("comprado") == 1)
    pos = positives.select("customer_id", "product_id", "week")
    per_pair = pos.groupBy("customer_id", "product_id").agg(F.count("*").alias("_k"))
    per_cust = pos.groupBy("customer_id").agg(F.count_distinct("week").alias("_w"))
    return (per_pair.join(per_cust, "customer_id")
            .select("customer_id", "product_id",
                    (F.col("_k") / F.col("_w")).alias("probabilidad_compra")))


def loyalty_maps(positives: DataFrame) -> DataFrame:
    """The same scores folded to one map per customer (bounded by the product
    list), so they join the frame before the product explode."""
    return (loyalty_scores(positives).groupBy("customer_id")
            .agg(F.map_from_entries(F.collect_list(
                F.struct("product_id", "probabilidad_compra"))).alias("_scores")))


def baseline_scored(grid, positives: DataFrame) -> DataFrame:
    """Scoring frame with the loyalty baseline as ``probabilidad_compra``."""
    sf = scoring_frame(grid, extra_customer=loyalty_maps(positives),
                       customer_extra_cols=["_scores"])
    score = F.coalesce(F.col("_scores")[F.col("product_id")], F.lit(0.0))
    return sf.df.withColumn("probabilidad_compra", score.cast(T.DoubleType())).drop("_scores")
