"""The dense customer x product x week grid with a 0/1 purchase label.

Plan shape (the grid itself is never shuffled):

  transactions --(shuffle on customer)--> purchase sets by week, one map per customer
  distinct customers --join attributes--> customer spine
  customer spine --join maps on customer--> (shuffle at customer scale)
  --explode(week spine), set of the week looked up--> customer-week rows   (map side)
  --explode(product list with its attributes)--> grid rows, label = array_contains  (map side)

Shuffles therefore scale with transactions and customers, never with customers x
weeks or more, and all rows of a customer lie in one partition. The product list
is collected only behind a size check (``max_listed_products``), which also
bounds a customer's map; above it purchase sets are joined to customer-week
rows, and customers and products are spread over hash buckets and joined on
(product bucket, customer bucket), which deals the pairs evenly to all tasks.

Constant columns (P4) are found on the dimension tables, not on the grid: every
customer of the spine occurs in the grid with every product and week, so a
customer attribute is constant over the grid exactly when it is constant over
the spine (same for products). The label and keys follow from counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.functions.time import week_start, week_spine
from weeklens.operators.columns import constant_columns
from weeklens.operators.dedup import dedup_keep_first, dedup_rows
from weeklens.operators.ordered import running_sums
from weeklens.operators.sampling import sample_numbers
from weeklens.session import reliable_checkpoint

KEYS = ["customer_id", "product_id", "week"]
LABEL = "comprado"
CUSTOMER_BUCKETS = 256
# purchase cells that a customer may have at most (weeks x products) to be folded to one map
CELLS_PER_MAP = 4_000_000
# grid rows made by a task, as far as the tasks stay within MAX_TASKS
ROWS_PER_TASK, MAX_TASKS = 2_000_000, 2_000
# rows that a task scores with a forest
SCORED_PER_TASK = 50_000
# values of a product list (products x columns) that become literals
LISTED_VALUES = 10_000
# customers that a file of folded rows holds at most, about
CUSTOMERS_PER_FILE = 200_000


def with_week(tx: DataFrame) -> DataFrame:
    """S1/S2 plus null-key filter (pandas groupby drops null keys)."""
    return (tx.where(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull()
                     & F.col("purchase_date").isNotNull())
            .withColumn("week", week_start(F.col("purchase_date"))))


def weekly_purchases(tx: DataFrame) -> DataFrame:
    """A1: one row per (customer, product, week) holding a transaction, with
    ``comprado`` = 1 when any non-null order id is present. Duplicate
    transaction rows do not change it, so P1 on transactions is not planned."""
    return (with_week(tx).groupBy(*KEYS)
            .agg(F.max(F.col("order_id").isNotNull().cast("int")).alias(LABEL)))


def week_bounds(tx: DataFrame) -> DataFrame:
    """A2: one row, first and last week."""
    w = with_week(tx)
    return w.agg(F.min("week").alias("min_week"), F.max("week").alias("max_week"))


def week_bounds_of_cells(cells: DataFrame) -> DataFrame:
    """A2 on purchase cells (already carrying ``week``): one row."""
    return cells.agg(F.min("week").alias("min_week"), F.max("week").alias("max_week"))


@dataclass
class Grid:
    df: DataFrame
    first_week: object
    last_week: object
    n_weeks: int
    n_customers: int
    n_products: int
    dropped: list = field(default_factory=list)
    customers: DataFrame | None = None   # the customer spine with its grid attributes
    products: DataFrame | None = None    # the listed products with their grid attributes
    cells: DataFrame | None = None       # checkpointed weekly purchase cells (label per cell)

    def weeks(self) -> DataFrame:
        """The week spine of the grid (one row per week), without touching
        the grid rows."""
        spark = self.df.sparkSession
        return spark.range(1).select(F.explode(week_spine(self.first_week, self.last_week))
                                     .alias("week"))

    @property
    def n_cells(self) -> int:
        return self.n_customers * self.n_products * self.n_weeks

    def sample(self, n: int, seed: int = 42, first_week=None, last_week=None,
               max_listed: int = 1_000_000) -> DataFrame:
        """min(n, cells) distinct grid rows of the given weeks (M2), drawn by their cell numbers: no other
        grid row is made. Customers and products get their ordinals in the order of their ids. Up to
        ``max_listed`` sampled keys go to all tasks, more of them are joined by shuffles."""
        first, last = first_week or self.first_week, last_week or self.last_week
        weeks = int(round((last - first).days / 7)) + 1
        spark = self.df.sparkSession
        total = self.n_customers * self.n_products * weeks
        cells = sample_numbers(spark, total, n, seed)
        per = F.lit(self.n_products * weeks).cast("long")
        rest = F.pmod("cell", per)
        keys = cells.select(F.expr(f"cell div {self.n_products * weeks}").alias("_c"),
                            F.call_function("div", rest, F.lit(weeks).cast("long")).alias("_p"),
                            (F.lit(first).cast("timestamp") + F.make_dt_interval(days=(F.pmod(rest, F.lit(weeks)) * 7).cast("int")))
                            .alias("week"))
        some = F.broadcast if min(n, total) <= max_listed else (lambda df: df)
        keys = reliable_checkpoint(keys)
        # the sampled keys are the small side; each dimension is read once and only its sampled rows stay
        cust = ordinals(self.customers, "customer_id", "_c").join(some(keys), "_c").drop("_c")
        rows = ordinals(self.products, "product_id", "_p").join(some(reliable_checkpoint(cust)), "_p").drop("_p")
        rows = reliable_checkpoint(rows)
        bought = (self.cells.where(F.col(LABEL) == 1).select(*KEYS, LABEL)
                  .join(some(rows.select(*KEYS)), KEYS, "left_semi"))
        label = F.coalesce(F.col(LABEL), F.lit(0)).alias(LABEL)
        out = rows.join(some(bought), KEYS, "left")
        return out.select(*[label if c == LABEL else F.col(c) for c in self.df.columns])

    def judged_rows(self, first_week=None, last_week=None) -> DataFrame:
        """Rows that stand for all cells of the given weeks when cells are scored by attributes and week of
        year (A8 to A10): customer and product with their attributes, ``week``, ``_n`` cells and ``_tp``
        purchases among them.

        Cells of one customer and product whose weeks share a week of year score alike: one row, the latest of
        the weeks, stands for them all, with no purchase. The purchases come as rows of their own that stand for no cell, from the
        purchase cells, so the grid is not joined with them. Grouped by score, the two add up to the cells."""
        return self.judged_parts(first_week, last_week).rows()

    def judged_parts(self, first_week=None, last_week=None) -> "JudgedParts":
        """What ``judged_rows`` are made of, so that a judge may fold customers that score alike first."""
        first, last = first_week or self.first_week, last_week or self.last_week
        weeks = self.df.sparkSession.range(1).select(F.explode(week_spine(first, last)).alias("week"))
        bought = self.cells.where((F.col(LABEL) == 1) & F.col("week").between(F.lit(first), F.lit(last)))
        return JudgedParts(self.customers, self.products, weeks, bought.select(*KEYS))

    def folds(self, max_values: int | None = None) -> bool:
        """Whether the products are few enough for ``folded`` rows to be paired with them by a literal list."""
        most = LISTED_VALUES if max_values is None else max_values
        return (self.n_products * len(self.products.columns) <= most and self.n_products * self.n_weeks <= CELLS_PER_MAP
                and not set(self.products.columns) & set(self.customers.columns) and not set(self.dropped) & set(KEYS))

    def folded(self) -> DataFrame:
        """One row per customer and week, with the customer's attributes and the products bought (``_bought``, null
        if none): with every row of ``products`` they are the grid.

        Made to be written by week in few files: a task takes up to ``CUSTOMERS_PER_FILE`` customers and some of the
        weeks. Rows of a customer and so many weeks are dealt out, with the purchases in them, not those of each week."""
        cores = self.df.sparkSession.sparkContext.defaultParallelism
        buckets = -(-self.n_customers // CUSTOMERS_PER_FILE)
        span = max(1, min(ROWS_PER_TASK * buckets // self.n_customers, self.n_weeks * buckets // (3 * cores)))
        chunks = -(-self.n_weeks // span)
        start = F.lit(self.first_week).cast("timestamp")

        def week(number):
            return start + F.make_dt_interval(days=(number * 7).cast("int"))

        at = F.floor(F.round(F.datediff("week", start) / 7) / span).cast("int")
        sets = (self.cells.where(F.col(LABEL) == 1).groupBy("customer_id", "week").agg(F.collect_set("product_id").alias("_bought"))
                .groupBy("customer_id", at.alias("_at"))
                .agg(F.map_from_entries(F.collect_list(F.struct("week", "_bought"))).alias("_sets"))
                .groupBy("customer_id").agg(F.map_from_entries(F.collect_list(F.struct("_at", "_sets"))).alias("_sets")))
        rows = (self.customers.join(sets, "customer_id", "left")
                .withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
                .withColumn("_sets", F.col("_sets")[F.col("_at")])
                .repartition(buckets * chunks, F.pmod(F.xxhash64("customer_id"), F.lit(buckets)), "_at"))
        last = F.least((F.col("_at") + 1) * span, F.lit(self.n_weeks)) - 1
        return (rows.withColumn("week", F.explode(F.sequence(F.col("_at") * span, last)))
                .withColumn("week", week(F.col("week")))
                .withColumn("_bought", F.col("_sets")[F.col("week")]).drop("_sets", "_at"))

    def class_counts(self) -> DataFrame:
        """Grid rows per label (A13) by identity: the purchase cells hold the
        positives, all other rows are negatives. Two rows, no grid row made."""
        pos = self.cells.agg(F.coalesce(F.sum(LABEL), F.lit(0)).cast("long").alias("_p"))
        both = F.array(F.struct(F.lit(1).alias(LABEL), F.col("_p").alias("n")),
                       F.struct(F.lit(0).alias(LABEL), (F.lit(self.n_cells) - F.col("_p")).alias("n")))
        return pos.select(F.explode(both).alias("r")).select("r.*").where("n > 0")


@dataclass
class JudgedParts:
    """The dimensions of cells to be judged and the purchases among them."""
    customers: DataFrame
    products: DataFrame
    weeks: DataFrame
    bought: DataFrame

    def rows(self, customer_cell=None, week_cell=None) -> DataFrame:
        """``Grid.judged_rows``. Customers with the same ``customer_cell`` (a column of theirs that is never null)
        score alike: one of them, with its attributes, stands for all; so does the latest of the weeks with the same
        ``week_cell`` (default: the week of year)."""
        week_cell = F.weekofyear("week") if week_cell is None else week_cell
        weeks = (self.weeks.groupBy(week_cell.alias("_wc")).agg(F.max("week").alias("week"), F.count("*").alias("_n"))
                 .select(F.sort_array(F.collect_list(F.struct("week", "_n"))).alias("w")).first().w)  # at most 53
        listed = F.array(*[F.struct(F.lit(r["week"]).alias("week"), F.lit(r["_n"]).cast("long").alias("_n")) for r in weeks])
        key, customers, bought = "customer_id", self.customers, self.bought
        if customer_cell is not None:
            key, cells = "_cell", reliable_checkpoint(customers.withColumn("_cell", customer_cell))
            one = F.min(F.struct(*customers.columns)).alias("_one")
            customers = reliable_checkpoint(cells.groupBy("_cell").agg(one, F.count("*").alias("_k")).select("_cell", "_one.*", "_k"))
            bought = bought.join(cells.select("customer_id", "_cell"), "customer_id")
        many = F.col("_k") if customer_cell is not None else F.lit(1)
        rows = customers.withColumn("_w", F.explode(listed)).select("*", "_w.*").drop("_w").withColumn("_n", F.col("_n") * many)
        tasks = 0
        if customer_cell is not None:  # few rows by now, but each is scored with every product
            tasks = max(1, min(MAX_TASKS, -(-rows.count() * self.products.count() // SCORED_PER_TASK)))
            rows = rows.repartition(tasks, "_cell", "week")
        every, _ = attach_products(rows.drop("_cell", "_k"), self.products)
        bought = (bought.groupBy(key, "product_id", week_cell.alias("_wc"))
                  .agg(F.max("week").alias("week"), F.count("*").alias("_tp")).drop("_wc"))
        bought = bought.join(customers, key).join(self.products, "product_id")
        if tasks:
            bought = bought.repartition(tasks, "_cell", "product_id", "week")
        bought = bought.drop("_cell", "_k")
        return (every.withColumn("_tp", F.lit(0).cast("long"))
                .unionByName(bought.withColumn("_n", F.lit(0).cast("long"))))


def ordinals(dim: DataFrame, key: str, name: str) -> DataFrame:
    """``dim`` (one row per ``key``) with ``name`` = 0, 1, 2, ... in the order of the keys."""
    d = running_sums(dim.withColumn("_one", F.lit(1).cast("long")), [], key, ["_one"])
    return d.withColumn(name, F.col("cum__one") - 1).drop("_one", "cum__one")


def clean_dimension(dim: DataFrame, key: str) -> DataFrame:
    """P1 then P2: a dimension listed twice with different attributes would
    multiply grid rows in the attribute join."""
    return dedup_keep_first(dedup_rows(dim).where(F.col(key).isNotNull()), [key])


def build_grid(tx: DataFrame | None, customers: DataFrame, products: DataFrame,
               drop_constant: bool = True, keep=("week", LABEL),
               max_listed_products: int = 10_000, rows_per_bucket: int = 2_000,
               checkpoint_cells: bool = True, cells: DataFrame | None = None) -> Grid:
    """build_grid: P1, A1, A2, S2, S3, J2-J4, S5, P4.

    Transactions are folded once into weekly purchase cells; the cells are
    checkpointed to the shared checkpoint folder, so the transaction join runs
    once and later actions (and a lost executor) start from the cells. Small
    actions follow: week bounds and customer count (one row), the product list
    (bounded by ``max_listed_products``), the constant check on the two
    dimension tables. The returned frame is lazy. ``cells`` (written weekly
    purchase cells) may be given instead of transactions.
    """
    if cells is None:
        cells = weekly_purchases(tx)
        if checkpoint_cells:
            cells = reliable_checkpoint(cells)
    cust = clean_dimension(customers, "customer_id")
    prod = clean_dimension(products, "product_id")

    b = cells.agg(F.min("week").alias("lo"), F.max("week").alias("hi"),
                  F.count_distinct("customer_id").alias("nc")).first()
    if b.lo is None:
        raise ValueError("no transactions with keys")
    n_weeks = int(round((b.hi - b.lo).days / 7)) + 1

    # one row per customer: read by the constant check and by the grid plan
    spine = (cells.select("customer_id").distinct()
             .join(cust, "customer_id", "left")).persist()
    pids = cells.select("product_id").distinct()
    prod_attrs = prod.join(pids, "product_id", "right").persist()
    n_listed = prod_attrs.limit(max_listed_products + 1).count()
    bought = cells.where(F.col(LABEL) == 1)
    if n_listed <= max_listed_products and n_listed * n_weeks <= CELLS_PER_MAP:
        cw = customer_weeks(spine, bought, b.lo, b.hi, int(b.nc) * n_listed * n_weeks)
    else:
        sets = bought.groupBy("customer_id", "week").agg(F.collect_set("product_id").alias("_bought"))
        cw = (spine.withColumn("week", F.explode(week_spine(b.lo, b.hi)))
              .join(sets, ["customer_id", "week"], "left"))
    rows, n_products = attach_products(cw, prod_attrs, max_listed_products, rows_per_bucket)

    label = F.coalesce(F.array_contains("_bought", F.col("product_id")), F.lit(False)).cast("int")
    cust_cols = [c for c in cust.columns if c != "customer_id"]
    prod_cols = [c for c in prod.columns if c != "product_id"]
    grid = rows.select(*KEYS, label.alias(LABEL), *cust_cols, *prod_cols)

    dropped = []
    if drop_constant:
        dropped = grid_constant_columns(spine, prod_attrs, int(b.nc), n_products, n_weeks,
                                        cust_cols, prod_cols, cells, keep)
        grid = grid.drop(*dropped)
    keep_c = [c for c in cust_cols if c not in dropped]
    keep_p = [c for c in prod_cols if c not in dropped]
    return Grid(grid, b.lo, b.hi, n_weeks, int(b.nc), n_products, dropped,
                spine.select("customer_id", *keep_c), prod_attrs.select("product_id", *keep_p),
                cells)


def customer_weeks(spine: DataFrame, bought: DataFrame, first, last, n_rows: int) -> DataFrame:
    """Every customer of ``spine`` with every week and the products bought in it (``_bought``, null if none).

    Both sides are dealt by customer once, into tasks of about ``ROWS_PER_TASK`` of the ``n_rows`` grid rows;
    a customer's purchases become one map of weeks to products, looked up for every week in place."""
    tasks = max(1, min(MAX_TASKS, -(-n_rows // ROWS_PER_TASK)))
    sets = (bought.where(F.col("week").isNotNull()).select(*KEYS).repartition(tasks, "customer_id")
            .groupBy("customer_id", "week").agg(F.collect_set("product_id").alias("_bought"))
            .groupBy("customer_id").agg(F.map_from_entries(F.collect_list(F.struct("week", "_bought"))).alias("_sets")))
    return (spine.repartition(tasks, "customer_id").join(sets, "customer_id", "left")
            .withColumn("week", F.explode(week_spine(first, last)))
            .withColumn("_bought", F.col("_sets")[F.col("week")]).drop("_sets"))


def attach_products(rows: DataFrame, products: DataFrame, max_listed: int = 10_000,
                    rows_per_bucket: int = 2_000):
    """Pair every row with every product of ``products`` (which holds
    ``product_id`` and its attributes); returns (frame, product count).

    Up to ``max_listed`` products (a checked count) they are collected and
    exploded from a literal list (with their attributes, so those nobody reads
    cost nothing; beyond ``LISTED_VALUES`` values the attributes are joined by
    broadcast): no shuffle. Above it the products are spread over hash buckets of about
    ``rows_per_bucket``, the customers over ``CUSTOMER_BUCKETS``, and the two are
    joined on both bucket numbers (each row is replicated once per product
    bucket, each product once per customer bucket): the pairs are dealt to
    (product buckets x customer buckets) keys of about equal size."""
    short = min(max_listed, LISTED_VALUES // len(products.columns))
    full = products.limit(short + 1).collect()
    ids = {r.product_id for r in full}
    if len(full) == len(ids) <= short and None not in ids and not set(products.columns) & set(rows.columns):
        entries = [F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in products.schema.fields])
                   for r in sorted(full, key=lambda r: r.product_id)]
        listed = F.array(*entries).cast(T.ArrayType(products.schema))
        return rows.withColumn("_p", F.explode(listed)).select("*", "_p.*").drop("_p"), len(full)
    listed = [r.product_id for r in products.select("product_id").limit(max_listed + 1).collect()]
    if len(listed) <= max_listed:
        listed.sort()
        ids = F.array(*[F.lit(p) for p in listed]).cast("array<long>")
        out = rows.withColumn("product_id", F.explode(ids))
        return out.join(F.broadcast(products), "product_id", "left"), len(listed)
    n = products.count()
    buckets = max(1, math.ceil(n / rows_per_bucket))
    bucket = F.pmod(F.xxhash64("product_id"), F.lit(buckets))
    def numbers(k):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))

    spread = F.pmod(F.xxhash64("customer_id"), F.lit(CUSTOMER_BUCKETS))
    out = (rows.withColumn("_s", spread).withColumn("_b", numbers(buckets))
           .join(products.withColumn("_b", bucket).withColumn("_s", numbers(CUSTOMER_BUCKETS)), ["_b", "_s"])
           .drop("_b", "_s"))
    return out, n


def grid_constant_columns(spine, prod_attrs, nc, np_, nw, cust_cols, prod_cols, cells, keep):
    """P4 through the dimension identity (see module docstring); ``cells``
    are the weekly purchase cells."""
    out = []
    if nc == 1:
        out.append("customer_id")
    if np_ == 1:
        out.append("product_id")
    if nw == 1:
        out.append("week")
    if LABEL not in keep:
        pos = cells.agg(F.sum(LABEL)).first()[0] or 0
        if pos == 0 or pos == nc * np_ * nw:
            out.append(LABEL)
    if cust_cols:
        out += constant_columns(spine, cust_cols)
    if prod_cols:
        out += constant_columns(prod_attrs, prod_cols)
    return [c for c in out if c not in keep]


def cell_counts(tx: DataFrame) -> DataFrame:
    """Grid size and class balance without building the grid (A13, A14 by
    identity): cells = customers x products x weeks, positives = distinct
    purchase cells, balanced weights n / (2 n_class). One aggregate, one row;
    works at any grain, including grids of billions of cells."""
    txw = with_week(tx)
    cell = F.when(F.col("order_id").isNotNull(), F.struct(*KEYS))
    row = txw.agg(F.count_distinct("customer_id").alias("n_customers"),
                  F.count_distinct("product_id").alias("n_products"),
                  F.min("week").alias("min_week"), F.max("week").alias("max_week"),
                  F.count_distinct(cell).alias("positives"))
    n_weeks = (F.datediff(F.col("max_week"), F.col("min_week")) / 7 + 1).cast("long")
    row = row.withColumn("n_weeks", n_weeks)
    cells = F.col("n_customers") * F.col("n_products") * F.col("n_weeks")
    row = row.withColumn("cells", cells).withColumn("negatives", F.col("cells") - F.col("positives"))
    return row.select(
        "n_customers", "n_products", "n_weeks", "cells", "positives", "negatives",
        F.try_divide(F.col("positives"), F.col("cells")).alias("positive_rate"),
        F.try_divide(F.col("cells"), 2 * F.col("positives")).alias("weight_positive"),
        F.try_divide(F.col("cells"), 2 * F.col("negatives")).alias("weight_negative"))


def grid_spines(tx: DataFrame, customers: DataFrame, products: DataFrame):
    """The two dimension tables that stand for a grid, each with the number of
    grid rows every one of its rows becomes (column ``_rows``):
    customers x (products x weeks) and products x (customers x weeks).
    The transactions are folded into checkpointed purchase cells once; one small
    action finds the counts; nothing of grid size is built."""
    txw = reliable_checkpoint(weekly_purchases(tx))
    b = txw.agg(F.min("week").alias("lo"), F.max("week").alias("hi"),
                F.count_distinct("customer_id").alias("nc"),
                F.count_distinct("product_id").alias("np")).first()
    n_weeks = int(round((b.hi - b.lo).days / 7)) + 1
    cust = (txw.select("customer_id").distinct()
            .join(clean_dimension(customers, "customer_id"), "customer_id", "left")
            .withColumn("_rows", F.lit(int(b.np) * n_weeks).cast("long")))
    prod = (txw.select("product_id").distinct()
            .join(clean_dimension(products, "product_id"), "product_id", "left")
            .withColumn("_rows", F.lit(int(b.nc) * n_weeks).cast("long")))
    return cust, prod
