"""Row and key de-duplication.

Keyed dedup is an aggregate, not a window: ``min``/``max`` of a struct is
computed partially on the map side, so a hot key that holds a large share of
the rows is folded before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop fully equal rows."""
    return df.dropDuplicates()


def _keyed(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    order = list(order) or rest
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(pick(packed).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]))


def dedup_keep_first(df: DataFrame, keys: Sequence[str],
                     order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the smallest by ``order`` (default: all other
    columns). pandas keeps the first in file order, which a distributed scan has
    no notion of; this tiebreak is deterministic instead."""
    return _keyed(df, keys, order, F.min)


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the largest by ``order`` (e.g. a source rank where
    new rows rank higher)."""
    return _keyed(df, keys, order, F.max)


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """P14."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.select(*keys).where(cond).distinct()
