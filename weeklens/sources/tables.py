"""The three input tables (transactions, customers, products).

On the test cluster they are views over the TPC-H-like tables; the mapping is
fixed by FIXTURES.md. Everything stays lazy: column pruning and filters reach
the parquet scans.

Two product grains are offered. ``part`` keys products by part (the mapping
as written); ``brand`` keys them by brand, which keeps the dense grid at the
reference's own size (about 1.5k customers x a few dozen products x weeks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRANSACTION_COLUMNS = ["order_id", "customer_id", "product_id", "purchase_date"]
CUSTOMER_ATTRIBUTES = ["customer_type", "region_id", "zone_id", "Y", "X",
                       "num_deliver_per_week", "num_visit_per_week"]
PRODUCT_ATTRIBUTES = ["brand", "category", "sub_category", "segment", "package", "size"]

# Fixed values of the fixture mapping: retail-price cut points for the four
# product segments (below 925 LOW, below 950 MEDIUM, below 975 HIGH, else PREMIUM).
SEGMENT_CUTS = (925.0, 950.0, 975.0)
SEGMENT_NAMES = ("LOW", "MEDIUM", "HIGH", "PREMIUM")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def brand_key(brand: Column) -> Column:
    """Numeric product key at brand grain: the number in 'Brand#13'."""
    return F.regexp_extract(brand, r"(\d+)", 1).try_cast("long")


def segment_of(price: Column) -> Column:
    lo, mid, hi = SEGMENT_CUTS
    return (F.when(price < lo, SEGMENT_NAMES[0])
             .when(price < mid, SEGMENT_NAMES[1])
             .when(price < hi, SEGMENT_NAMES[2])
             .otherwise(SEGMENT_NAMES[3]))


def transactions(spark: SparkSession, sf_dir: str, grain: str = "part") -> DataFrame:
    """order_id, customer_id, product_id, purchase_date (one row per line item)."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("purchase_date"))
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    if grain == "brand":
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        lines = (lines.join(part, lines.l_partkey == part.p_partkey)
                 .select("l_orderkey", brand_key(F.col("p_brand")).alias("l_partkey")))
    elif grain != "part":
        raise ValueError(f"unknown grain {grain!r}")
    return (lines.join(orders, lines.l_orderkey == orders.order_id)
            .select("order_id", "customer_id", F.col("l_partkey").alias("product_id"),
                    "purchase_date"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_mktsegment").alias("customer_type"),
                    F.col("n_regionkey").cast("int").alias("region_id"),
                    F.col("c_nationkey").cast("int").alias("zone_id"),
                    F.col("c_acctbal").cast("double").alias("Y"),
                    (F.col("c_acctbal") * F.lit(-0.5) + F.col("c_nationkey")).alias("X"),
                    (F.col("c_custkey") % 6 + 1).cast("int").alias("num_deliver_per_week"),
                    F.lit(1).cast("int").alias("num_visit_per_week")))


def products(spark: SparkSession, sf_dir: str, grain: str = "part") -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    if grain == "brand":
        return (part.select(brand_key(F.col("p_brand")).alias("product_id"),
                            F.col("p_brand").alias("brand"),
                            F.lit("GOODS").alias("category"))
                .dropDuplicates())
    if grain != "part":
        raise ValueError(f"unknown grain {grain!r}")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("brand"),
        F.lit("GOODS").alias("category"),
        F.col("p_type").alias("sub_category"),
        segment_of(F.col("p_retailprice")).alias("segment"),
        F.get(F.split(F.col("p_name"), " "), 1).alias("package"),
        F.col("p_size").cast("double").alias("size"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is missing in the input tables: read it as null, once, here."""
    null = F.lit(None).cast("double")
    return df.select(*[F.nanvl(F.col(c), null.cast(t)).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def load_raw(spark: SparkSession, sf_dir: str, grain: str = "part"):
    """IO1: the three named scans."""
    return tuple(nan_to_null(df) for df in (transactions(spark, sf_dir, grain), customers(spark, sf_dir),
                                            products(spark, sf_dir, grain)))
