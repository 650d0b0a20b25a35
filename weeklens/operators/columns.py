"""Schema-driven column choice (P4-P9). All of this is driver-side work on
``df.schema``; no job runs except in ``constant_columns``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_COLUMNS = ("customer_id", "product_id")
LABEL = "comprado"


def drop_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P5: drop the columns that exist, ignore the rest."""
    return df.drop(*[c for c in cols if c in df.columns])


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The listed names that exist, in list order."""
    have = set(df.columns)
    return [c for c in names if c in have]


def by_type(df: DataFrame, kind: str, exclude: Iterable[str] = (),
            integer_as_numeric: bool = True) -> list[str]:
    """Columns by type. ``kind`` is 'numeric' or 'categorical' (strings).
    With ``integer_as_numeric=False`` 32-bit integers count as categorical,
    which reproduces the week-of-year quirk of the production trainer."""
    skip = set(exclude)
    out = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        dt = f.dataType
        is_num = isinstance(dt, T.NumericType)
        if is_num and not integer_as_numeric and isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
            is_num = False
            is_cat = True
        else:
            is_cat = isinstance(dt, T.StringType)
        if (kind == "numeric" and is_num) or (kind == "categorical" and is_cat):
            out.append(f.name)
    return out


def choose_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]):
    """Named features that exist; fewer than two of a kind -> all of that
    type; nothing at all -> all numeric."""
    skip = (*ID_COLUMNS, LABEL, "week")
    num = present(df, numeric)
    cat = present(df, categorical)
    if len(num) < 2:
        num = by_type(df, "numeric", skip)
    if len(cat) < 2:
        cat = by_type(df, "categorical", skip)
    if not num and not cat:
        num = by_type(df, "numeric", skip)
    return num, cat


def by_prefix(df: DataFrame, prefixes: Sequence[str], names: Sequence[str] = ()) -> list[str]:
    """Columns named in ``names`` or starting with one of ``prefixes``."""
    named = set(names)
    return [c for c in df.columns if c in named or any(c.startswith(p) for p in prefixes)]


def constant_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P4 as a table: one row per column with ``is_constant`` (exactly one
    distinct non-null value, pandas ``nunique() == 1``). One aggregate pass:
    ``min = max`` over non-null values is exact and cheaper than count distinct."""
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"mn_{c}"), F.max(c).alias(f"mx_{c}")]
    row = df.agg(*aggs)
    stacked = [F.struct(F.lit(c).alias("column_name"),
                        (F.col(f"mn_{c}").isNotNull() & (F.col(f"mn_{c}") == F.col(f"mx_{c}")))
                        .alias("is_constant")) for c in cols]
    return row.select(F.explode(F.array(*stacked)).alias("r")).select("r.*")


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Runs one aggregate job (a single output row)."""
    return [r.column_name for r in constant_profile(df, cols).collect() if r.is_constant]
