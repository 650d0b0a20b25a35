from pyspark.sql import functions as F

from weeklens.operators.grid import attach_products


def test_many_products_are_dealt_to_all_tasks(spark):
    """Beyond the listed size: every pair once, and no task holds a bucket of all customers."""
    rows = spark.range(1, 401).withColumnRenamed("id", "customer_id").withColumn("week", F.lit(1))
    products = spark.range(1, 301).select(F.col("id").alias("product_id"), (F.col("id") % 7).alias("brand"))
    listed, n1 = attach_products(rows, products)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt, n2 = attach_products(rows, products, max_listed=10, rows_per_bucket=100)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert n1 == n2 == 300 and sum(sizes) == 400 * 300
        assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
        cols = ["customer_id", "product_id", "week", "brand"]
        assert dealt.select(cols).exceptAll(listed.select(cols)).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
