"""Exact-size samples of a dense grid without making the grid (M2).

The cells of a grid of C customers, P products and W weeks are the numbers
0 .. C*P*W - 1. A keyed Feistel network permutes these numbers: a number is
split into a quotient and a remainder of about its square root, and each round
adds a hash of the one to the other, modulo its range, which can be undone, so
no two numbers meet. The network's domain is a little larger than the grid; a
number that lands outside is sent through it again until it lands inside (cycle
walking), which keeps the whole map a permutation of the grid's numbers. The
images of 0 .. n - 1 are then n distinct cells, spread over the grid by the
key: the sample itself, at the cost of n rows. They are read back as (customer,
product, week) by their ordinals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 6
# A walk ends outside the grid with a probability under 1 / sqrt(total), 1/2 at most; a number still
# outside after so many raises an error, it never gives a wrong cell.
WALKS = 64


def permute(df: DataFrame, x: Column, total: int, key: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the image of ``x`` (0 <= x < total) under the permutation of 0 .. total - 1 that
    ``key`` (any column) names. Rows with the same key and different x get different images."""
    if not 1 <= total < 2 ** 62:
        raise ValueError("a permutation of 1 to 2^62 numbers")
    a = math.isqrt(total - 1) + 1
    high, low = (F.lit(side).cast("long") for side in (a, -(-total // a)))
    whole = F.lit(total).cast("long")

    def moved(left, right, k, half):
        # one round: the half whose turn it is, moved by a hash of the other one
        if half == "l":
            return F.pmod(left + F.pmod(F.xxhash64(right, F.col("_perm_key"), k), high), high)
        return F.pmod(right + F.pmod(F.xxhash64(left, F.col("_perm_key"), k), low), low)

    out = df.withColumn("_perm_key", key).withColumn("_perm_x", x.cast("long"))
    out = out.withColumns({"_perm_l": F.call_function("div", F.col("_perm_x"), low), "_perm_r": F.pmod("_perm_x", low)})
    for k in range(ROUNDS):  # a projection each
        half = "lr"[k % 2]
        out = out.withColumn(f"_perm_{half}", moved(F.col("_perm_l"), F.col("_perm_r"), F.lit(k), half))

    def again(p: Column, k: Column) -> Column:
        return F.struct(F.when(k % 2 == 0, moved(p["l"], p["r"], k, "l")).otherwise(p["l"]).alias("l"),
                        F.when(k % 2 == 0, p["r"]).otherwise(moved(p["l"], p["r"], k, "r")).alias("r"))

    def number(p: Column) -> Column:
        return p["l"] * low + p["r"]

    # the few that landed outside walk on
    walked = F.reduce(
        F.sequence(F.lit(2), F.lit(WALKS)), F.struct(F.col("_perm_l").alias("l"), F.col("_perm_r").alias("r")),
        lambda p, _: F.when(number(p) < whole, p).otherwise(F.reduce(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), p, again)),
        lambda p: F.when(number(p) < whole, number(p))
        .otherwise(F.raise_error(F.lit("a number stays outside the grid")).cast("long")))
    first = F.col("_perm_l") * low + F.col("_perm_r")
    return out.withColumn(name, F.when(first < whole, first).otherwise(walked)).drop("_perm_key", "_perm_x", "_perm_l", "_perm_r")


def sample_numbers(spark: SparkSession, total: int, n: int, seed: int = 42, name: str = "cell") -> DataFrame:
    """min(n, total) distinct numbers of 0 .. total - 1, the same ones for the same seed, however they are dealt out."""
    if total <= 0:
        return spark.range(0).select(F.col("id").alias(name))
    return permute(spark.range(min(n, total)), F.col("id"), total, F.lit(seed), name).select(name)
