"""Incremental merge of new grid rows into recent history.

combined = latest N weeks of history  UNION BY NAME  new grid, one row per
(customer, product, week), new rows winning, the last of repeated rows of one
side staying. A ``Grid`` just built holds each key once, and a history row is
replaced by it exactly when its customer, its product and its week all belong
to the new grid; so the merge of built grids joins history rows to the two
small key tables of the new grid and never shuffles rows by their full key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.operators.dedup import dedup_keep_last
from weeklens.operators.grid import LABEL, LISTED_VALUES, Grid
from weeklens.operators.split import latest_weeks_bound
from weeklens.sources.versions import LIST, MARK, folded_base

KEYS = ["customer_id", "product_id", "week"]


@dataclass
class Incremental:
    df: DataFrame
    history_lower_bound: object


def _unique(df: DataFrame, order) -> DataFrame:
    """One row per key: the last by ``order`` (default: all other columns, as
    a distributed table has no file order)."""
    rest = list(order) or [c for c in df.columns if c not in KEYS]
    return dedup_keep_last(df, KEYS, rest)


def prepare_incremental(history: DataFrame | Grid | None, new: DataFrame | Grid,
                        weeks_to_include: int = 4, history_weeks: DataFrame | None = None,
                        new_first_week=None, order=(), unique: bool = False) -> Incremental:
    """U2. ``history`` may be None (no history yet): the new grid is used as is.

    Each side is a grid DataFrame or a ``Grid`` just built. Rows of a frame
    that repeat a key are cut to the last by ``order`` columns (pass ``unique``
    if the keys are known to be unique, as in a table this function wrote).
    Small actions find the history bound and, for a frame, the new week range."""
    new_rows = new.df if isinstance(new, Grid) else (new if unique else _unique(new, order))
    if history is None:
        return Incremental(new_rows, None)
    weeks = history_weeks if history_weeks is not None else (
        history.weeks() if isinstance(history, Grid) else history)
    lo = latest_weeks_bound(weeks, weeks_to_include)
    if lo is None:
        return Incremental(new_rows, None)
    table = history.df if isinstance(history, Grid) else history
    recent = table.where(F.col("week") >= F.lit(lo))
    if not isinstance(history, Grid) and not unique:
        recent = _unique(recent, order)
    if isinstance(new, Grid):
        new_lo, new_hi = new.first_week, new.last_week
    else:
        new_lo = new_first_week if new_first_week is not None else new.agg(F.min("week")).first()[0]
        new_hi = None
    if new_lo is None:
        return Incremental(recent.unionByName(new_rows, allowMissingColumns=True), lo)
    older = recent.where(F.col("week") < F.lit(new_lo))
    overlap = recent.where(F.col("week") >= F.lit(new_lo))
    if isinstance(new, Grid):
        # every (customer, product, week) of the new spines is a row of the new grid
        c = new.customers.select(F.col("customer_id").alias("_c"))
        p = new.products.select(F.col("product_id").alias("_p"))
        kept = (overlap.join(c, F.col("customer_id") == F.col("_c"), "left")
                .join(p, F.col("product_id") == F.col("_p"), "left")
                .where(F.col("_c").isNull() | F.col("_p").isNull() | (F.col("week") > F.lit(new_hi)))
                .drop("_c", "_p"))
    else:
        kept = overlap.join(new_rows.select(*KEYS), KEYS, "left_anti")
    combined = older.unionByName(kept).unionByName(new_rows, allowMissingColumns=True)
    return Incremental(combined, lo)


def merge_weeks(store, name: str, new: Grid, weeks_to_include: int = 4, tag: str | None = None) -> int:
    """U2 into table ``name`` of a versioned store: the same rows as ``prepare_incremental`` of the table and
    ``new``, written as the weeks of ``new`` only. Weeks before the recent history leave the new version, other
    weeks stay in the folders they lie in. Returns the version.

    Grids of few products are written folded, a row per customer and week; where products are many, or replaced
    weeks lie there row by row, the rows are written out."""
    history = store.read(name)
    if history is None:
        written = _write_folded(store, name, new, *_numbered(new)) if new.folds() else store.write(name, new.df, "week")
        return store.commit({name: written}, tag, part_columns={name: "week"})
    held = store.entries()[name]
    recent = sorted(held)[-weeks_to_include:] if weeks_to_include > 0 else []
    first, last = (str(w.date()) for w in (new.first_week, new.last_week))
    overlap = [held[w] for w in recent or held if first <= w <= last]
    written = _merge_folded(store, name, history, overlap, new) if new.folds() else None
    if written is None:
        history = history.where(F.col("week").between(F.lit(new.first_week), F.lit(new.last_week)))
        if recent:
            history = history.where(F.col("week") >= F.lit(recent[0]).cast("timestamp"))
        c = new.customers.select(F.col("customer_id").alias("_c"))
        p = new.products.select(F.col("product_id").alias("_p"))
        # every (customer, product, week) of the new spines is a row of the new grid and replaces the old one
        kept = (history.join(c, F.col("customer_id") == F.col("_c"), "left").join(p, F.col("product_id") == F.col("_p"), "left")
                .where(F.col("_c").isNull() | F.col("_p").isNull()).drop("_c", "_p"))
        written = store.write(name, kept.unionByName(new.df, allowMissingColumns=True), "week")
    gone = {w: None for w in held if w not in recent or first <= w <= last}
    return store.commit({name: {**gone, **written}}, tag, whole=False, part_columns={name: "week"})


def _numbered(grid: Grid) -> tuple[DataFrame, DataFrame]:
    """Folded rows of ``grid`` and its product list, which is number 0."""
    rest = [c for c in grid.products.columns if c != "product_id"]
    return grid.folded().withColumn(LIST, F.lit(0)), grid.products.select(F.lit(0).alias(LIST), "product_id", *rest)


def _write_folded(store, name: str, new: Grid, rows: DataFrame, lists: DataFrame) -> dict[str, str]:
    weeks = [str(r.week.date()) for r in new.weeks().collect()]
    return store.write_folded(name, rows, lists, "week", weeks, LABEL)


def _merge_folded(store, name: str, history: DataFrame, overlap: list[str], new: Grid) -> dict[str, str] | None:
    """Writes ``new`` and what it leaves of the folders ``overlap``, folded; None if they cannot be folded.

    A customer of the new grid keeps the products that the new grid lacks, any other customer keeps its whole
    list: so a kept row is an old row with its list or with what is left of it, and no grid row is made."""
    writes: dict = {}
    for f in overlap:
        writes.setdefault(folded_base(f), []).append(f)
    if None in writes:
        return None
    c = new.customers.select(F.col("customer_id").alias("_c"))
    replaced = [r[0] for r in new.products.select("product_id").collect()]  # few, see Grid.folds
    rows, lists = _numbered(new)
    number, values = 0, new.n_products * len(new.products.columns)
    for folders in writes.values():
        old, old_lists = store.read_folded(folders)
        old_lists = old_lists.drop(MARK)
        old = (old.withColumn("week", F.col("week").cast("timestamp")).join(c, F.col("customer_id") == F.col("_c"), "left")
               .withColumn("_again", F.col("_c").isNotNull()).drop("_c"))
        left = {False: old_lists, True: old_lists.where(~F.col("product_id").isin(replaced))}
        sizes = {(again, r[LIST]): r["n"] for again, of in left.items()
                 for r in of.groupBy(LIST).agg(F.count("*").alias("n")).collect()}
        to = F.lit(None).cast("int")
        for r in sorted(old.select("_again", LIST).distinct().collect()):
            n = sizes.get((r["_again"], r[LIST]), 0)
            if not n:  # all its products are replaced
                continue
            number, values = number + 1, values + n * len(old_lists.columns)
            to = F.when((F.col("_again") == F.lit(r["_again"])) & (F.col(LIST) == r[LIST]), F.lit(number)).otherwise(to)
            lists = lists.unionByName(left[r["_again"]].where(F.col(LIST) == r[LIST]).withColumn(LIST, F.lit(number)),
                                      allowMissingColumns=True)
        if values > LISTED_VALUES:
            return None
        rows = rows.unionByName(old.withColumn(LIST, to).where(F.col(LIST).isNotNull()).drop("_again"), allowMissingColumns=True)
    # a column of the table stays one, also where no row of these weeks has it
    for f in history.schema.fields:
        if f.name not in (*rows.columns, *lists.columns, LABEL):
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    return _write_folded(store, name, new, rows, lists)


STATS_SCHEMA = ("historical_samples long, new_samples long, combined_samples long, "
                "historical_weeks long, new_weeks long, combined_weeks long, "
                "weeks_included_from_historical int, min_week timestamp, max_week timestamp")


def incremental_stats(history: DataFrame | None, new: DataFrame, combined: DataFrame,
                      weeks_to_include: int = 4) -> DataFrame:
    """Row counts, distinct weeks and week range per input. Three
    one-row aggregates are collected and set side by side in one row."""
    def one(df):
        return df.agg(F.count("*").alias("n"), F.count_distinct("week").alias("w"),
                      F.min("week").alias("lo"), F.max("week").alias("hi")).first()
    n, c = one(new), one(combined)
    h = one(history) if history is not None else None
    row = (h.n if h else 0, n.n, c.n, h.w if h else 0, n.w, c.w, weeks_to_include, c.lo, c.hi)
    return new.sparkSession.createDataFrame([row], STATS_SCHEMA)


def incremental_stats_of_grids(history: Grid, new: Grid, weeks_to_include: int = 4) -> DataFrame:
    """A12 of a merge of built grids, by identity: sizes are products of key
    counts, and replaced rows are (common customers) x (common products) x
    (common weeks). No grid row is made."""
    weeks = history.weeks()
    lo = latest_weeks_bound(weeks, weeks_to_include)
    recent = weeks.where(F.col("week") >= F.lit(lo))
    both = new.weeks().select("week")
    common = (history.customers.select("customer_id").join(new.customers.select("customer_id"), "customer_id").count()
              * history.products.select("product_id").join(new.products.select("product_id"), "product_id").count()
              * recent.join(both, "week").count())
    kept = history.n_customers * history.n_products * recent.count() - common
    # a history week stays in the result if any of its rows is kept
    alone = recent.join(both, "week", "left_anti") if common and kept == 0 else recent
    w = alone.union(both).agg(F.count_distinct("week").alias("n"), F.min("week").alias("lo"),
                              F.max("week").alias("hi")).first()
    row = (history.n_cells, new.n_cells, new.n_cells + kept, history.n_weeks, new.n_weeks, w.n,
           weeks_to_include, w.lo, w.hi)
    return new.df.sparkSession.createDataFrame([row], STATS_SCHEMA)
