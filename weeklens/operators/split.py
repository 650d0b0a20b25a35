"""Temporal split by distinct weeks (W1) and latest-N-weeks.

The distinct-week table has one row per week (52 a year), so ranking it in a
single window is bounded by the calendar, not by the data. The split is then
applied as two range predicates on ``week``; on a grid stored partitioned by
week those prune whole partitions at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def week_ranks(df: DataFrame, week: str = "week") -> DataFrame:
    """Distinct weeks with their 1-based rank and the total count."""
    weeks = df.select(week).where(F.col(week).isNotNull()).distinct()
    w = Window.orderBy(week)
    return (weeks.withColumn("week_rank", F.row_number().over(w))
            .withColumn("n_weeks", F.count("*").over(Window.partitionBy())))


def split_labels(df: DataFrame, train_frac: float = 0.7, val_frac: float = 0.15,
                 week: str = "week") -> DataFrame:
    """Week -> 'train' / 'val' / 'test'. Cut sizes are ``int(n * frac)`` on
    IEEE doubles, as Python computes them; the rest is test."""
    r = week_ranks(df, week)
    n_train = F.floor(F.col("n_weeks").cast("double") * F.lit(float(train_frac)))
    n_val = F.floor(F.col("n_weeks").cast("double") * F.lit(float(val_frac)))
    label = (F.when(F.col("week_rank") <= n_train, "train")
              .when(F.col("week_rank") <= n_train + n_val, "val").otherwise("test"))
    return r.select(week, "week_rank", label.alias("split"))


def split_bounds(df: DataFrame, train_frac: float = 0.7, val_frac: float = 0.15,
                 week: str = "week"):
    """Last week of train and of val (None when empty). One small action;
    ``df`` may be the grid or just its week table."""
    row = (split_labels(df, train_frac, val_frac, week)
           .agg(F.max(F.when(F.col("split") == "train", F.col(week))).alias("t"),
                F.max(F.when(F.col("split") == "val", F.col(week))).alias("v"))
           .first())
    return row.t, row.v


def temporal_split(df: DataFrame, train_frac: float = 0.7, val_frac: float = 0.15,
                   test_frac: float = 0.15, week: str = "week", weeks: DataFrame | None = None):
    """(train, val, test) frames cut by range predicates on ``week``.
    ``test_frac`` is accepted and unused: test is whatever follows val.
    ``weeks`` (the grid's week table, if known) saves a pass over the rows."""
    t_end, v_end = split_bounds(weeks if weeks is not None else df, train_frac, val_frac, week)
    c = F.col(week)
    if t_end is None:
        train = df.where(F.lit(False))
        after_train = c.isNotNull()
    else:
        train = df.where(c <= F.lit(t_end))
        after_train = c > F.lit(t_end)
    if v_end is None:
        val = df.where(F.lit(False))
        test = df.where(after_train)
    else:
        val = df.where(after_train & (c <= F.lit(v_end)))
        test = df.where(c > F.lit(v_end))
    return train, val, test


def latest_weeks_bound(df: DataFrame, n: int = 4, week: str = "week"):
    """The first of the latest ``n`` distinct weeks (None if no weeks).
    A top-n of distinct weeks: bounded by ``n``."""
    rows = (df.select(week).where(F.col(week).isNotNull()).distinct()
            .orderBy(F.col(week).desc()).limit(n).agg(F.min(week).alias("lo")).first())
    return rows.lo


def latest_weeks(df: DataFrame, n: int = 4, week: str = "week") -> DataFrame:
    lo = latest_weeks_bound(df, n, week)
    if lo is None:
        return df.where(F.lit(False))
    return df.where(F.col(week) >= F.lit(lo))
