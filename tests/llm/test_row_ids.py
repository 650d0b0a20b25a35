import pytest
from pyspark.sql import functions as F

from weeklens.llm import common, poly_fingerprints


@pytest.fixture()
def files(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.sha2((F.col("id") % 4000).cast("string"), 512)).alias("text"),
                             F.lit(1).alias("_path")).repartition(3).write.option("parquet.block.size", 20_000).parquet(path)
    return spark.read.parquet(path)


@pytest.fixture()
def split(spark):
    """Sets the bytes a scan task reads at most: other cores at planning time shift it likewise."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, before)


def numbers(df):
    return {r["_rid"]: r["doc_id"] for r in common.with_row_id(df).select("_rid", "doc_id").collect()}


def test_numbers_do_not_depend_on_the_split(files, split):
    split(1 << 27)
    whole = numbers(files)
    split(30_000)
    assert files.rdd.getNumPartitions() > 6
    assert len(whole) == 6000 and numbers(files) == whole
    kept = files.filter("doc_id % 2 = 0").select("doc_id", "text")
    assert numbers(kept).items() <= whole.items()
    assert common.with_row_id(files).columns == [*files.columns, "_rid"]


def test_rows_are_dropped_right_when_the_split_changes(files, split):
    split(1 << 27)
    gone = common.stage(poly_fingerprints.exact_duplicates(files).filter(~F.col("kept")).select("_rid"), "test-gone")
    split(30_000)
    left = common.without_rows(files, gone)
    assert left.columns == files.columns
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == list(range(2000, 6000))


def test_other_frames_are_written_before_they_are_numbered(files, split):
    dealt = files.repartition(5).withColumn("x", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = common.settled(dealt)
    assert common.settled(rows) is rows and rows.columns == dealt.columns
    split(1 << 27)
    whole = numbers(rows)
    split(20_000)
    assert len(whole) == 12_000 and numbers(rows) == whole


@pytest.mark.parametrize("vectors", [0, 1, 1000])
def test_rows_are_dropped_by_vectors_or_by_a_join(spark, files, vectors):
    numbered = common.with_row_id(files).select("_rid", "doc_id")
    gone = common.stage(numbered.filter("doc_id % 3 = 0 OR doc_id < 100").select("_rid"), "test-gone")
    twice = gone.unionByName(gone)
    left = common.without_rows(files, twice, vectors)
    plan = left._jdf.queryExecution().executedPlan().toString()
    few = vectors >= 3  # three files
    assert ("Exchange hashpartitioning" not in plan) == few and ("LeftAnti" in plan) != few
    assert left.columns == files.columns
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == [i for i in range(100, 6000) if i % 3]
    held = common.only_rows(numbered, "_rid", twice, vectors)
    assert held.columns == numbered.columns
    kept = sorted(r.doc_id for r in held.collect())
    assert kept == ([i for i in range(6000) if i % 3 == 0 or i < 100] if few else list(range(6000)))


def test_vectors_reach_over_their_borders(spark, tmp_path):
    path = str(tmp_path / "many")
    n = 2 * common.VECTOR_ROWS + 11
    spark.range(n).coalesce(1).select(F.col("id").alias("doc_id")).write.parquet(path)
    docs = spark.read.parquet(path)
    edge = [0, 7, 8, common.VECTOR_ROWS - 1, common.VECTOR_ROWS, 2 * common.VECTOR_ROWS - 1, 2 * common.VECTOR_ROWS, n - 1]
    gone = common.stage(common.with_row_id(docs).filter(F.col("doc_id").isin(edge)).select("_rid"), "test-gone")
    left = common.without_rows(docs, gone)
    assert left.count() == n - len(edge) and left.filter(F.col("doc_id").isin(edge)).count() == 0
