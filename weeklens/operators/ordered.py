"""Ordered running sums and exact quantiles without one huge window partition.

A running sum over all values of a column (KS, average precision, quantiles)
is a window ordered by value. Done naively every row of a group goes to one
task. Here the value range of each group is cut into buckets at approximate
quantiles (one small aggregate), each bucket's totals are summed (a table of
groups x buckets rows), their prefix sums become offsets, and the window runs
inside each bucket. Cut points only decide the partitioning, so the result is
exact whatever the quantile error. The bucket count follows the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weeklens.session import reliable_checkpoint

ROWS_PER_BUCKET = 100_000


def cuts_below(cuts, x, most: int):
    """How many of the sorted array ``cuts`` (at most ``most``) are less than ``x``, by halving."""
    steps = [2 ** i for i in reversed(range(most.bit_length()))]
    if not steps:
        return F.lit(0)
    return F.reduce(F.array(*[F.lit(k) for k in steps]), F.lit(0),
                    lambda at, k: F.when(F.get(cuts, at + k - 1) < x, at + k).otherwise(at))


def running_sums(df: DataFrame, groups: Sequence[str], order: str, values: Sequence[str],
                 buckets: int | None = None, accuracy: int = 10_000,
                 checkpointed: bool = False) -> DataFrame:
    """Add ``cum_<v>`` = sum of ``v`` over rows of the same group with
    ``order`` <= this row's. ``df`` must already hold one row per distinct
    (groups, order) value, so ties are not an issue. ``buckets`` per group
    defaults to one per 100,000 rows of the largest group; ``checkpointed`` says
    that ``df`` is written already."""
    groups = list(groups)
    # the input is read by the count, the cut points, the bucket totals and the
    # final window: write it once to the shared folder instead of recomputing it
    if not checkpointed:
        df = reliable_checkpoint(df)
    if buckets is None:
        rows = df.groupBy(*groups).count().agg(F.max("count")).first()[0]
        buckets = max(1, -(-(rows or 0) // ROWS_PER_BUCKET))
    probs = [i / buckets for i in range(1, buckets)]
    if not probs:
        b = df.withColumn("_cuts", F.array().cast(f"array<{dict(df.dtypes)[order]}>"))
    elif groups:
        cuts = df.groupBy(*groups).agg(
            F.percentile_approx(order, probs, accuracy).alias("_cuts"))
        # one row per group, ``buckets`` numbers each
        b = df.join(cuts, groups)
    else:
        # a single group: its cut points are one array, used as a literal
        cut = df.agg(F.percentile_approx(order, probs, accuracy).alias("c")).first().c or []
        b = df.withColumn("_cuts", F.array(*[F.lit(x) for x in cut]) if cut
                          else F.array().cast(f"array<{dict(df.dtypes)[order]}>"))
    bucket = F.when(F.col("_cuts").isNotNull(), cuts_below(F.col("_cuts"), F.col(order), len(probs))).otherwise(F.size("_cuts"))
    b = b.withColumn("_bk", bucket).drop("_cuts")

    tot = b.groupBy(*groups, "_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = (Window.partitionBy(*groups).orderBy("_bk")
              .rowsBetween(Window.unboundedPreceding, -1))
    offs = tot.select(*groups, "_bk", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0))
                                       .alias(f"_o_{v}") for v in values])
    inside = (Window.partitionBy(*groups, "_bk").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = b.join(offs, [*groups, "_bk"])
    for v in values:
        out = out.withColumn(f"cum_{v}", F.col(f"_o_{v}") + F.sum(v).over(inside))
    return out.drop("_bk", *[f"_o_{v}" for v in values])


def histogram(parts: Sequence[tuple[DataFrame, dict, object]]) -> DataFrame:
    """(name, v, n): how often each column holds each value; NaN counts as null.

    ``parts`` are (frame, {name: numeric column}, weight), the weight a column
    that says how many rows a row stands for, or None. One pass over each
    frame, folded on the map side."""
    out = None
    for df, cols, weight in parts:
        w = F.lit(1) if weight is None else weight
        items = [F.struct(F.lit(name).alias("name"),
                          F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias("v"))
                 for name, c in cols.items()]
        part = df.select(F.explode(F.array(*items)).alias("u"), w.cast("long").alias("n")).select("u.*", "n")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("name", "v").agg(F.sum("n").alias("n"))


def quantiles(hist: DataFrame, probs: Sequence[float], checkpointed: bool = False) -> DataFrame:
    """(name, q): the exact quantiles (linear interpolation between ranks) of
    every column of a ``histogram``, nulls left out. Ranks are found by running
    counts over the distinct values, so no task holds all of them."""
    h = hist.where(F.col("v").isNotNull())
    c = running_sums(h, ["name"], "v", ["n"], checkpointed=checkpointed)
    # one row per column
    c = c.join(F.broadcast(h.groupBy("name").agg(F.sum("n").alias("_all"))), "name")
    aggs = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("_all") - 1)
        aggs += [F.min(F.when(F.col("cum_n") > F.floor(at), F.col("v"))).alias(f"_lo{i}"),
                 F.min(F.when(F.col("cum_n") > F.ceil(at), F.col("v"))).alias(f"_hi{i}"),
                 F.max(at - F.floor(at)).alias(f"_f{i}")]
    one = c.groupBy("name").agg(*aggs)
    between = [F.col(f"_lo{i}") + F.when(F.col(f"_f{i}") == 0, 0.0).otherwise(
        (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")) for i in range(len(probs))]
    return one.select("name", F.array(*between).alias("q"))
