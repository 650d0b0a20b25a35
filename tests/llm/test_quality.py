import math

import pytest
from pyspark.sql import functions as F

from weeklens.llm import bayes_quality as bq

from .conftest import rows

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_documents(tables):
    """Fitted on 2,000 labelled documents, judged on the others."""
    docs, labels = tables
    got = bq.classify(docs, labels, train_rows=2000)
    trained = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2000).select("doc_id")
    r = (got.join(labels.join(trained, "doc_id", "left_anti"), "doc_id")
         .withColumn("good", (F.col("quality") == 1) & (F.col("toxic") == 0))
         .groupBy("good").agg(F.avg(F.col("kept").cast("double")).alias("kept"), F.count("*").alias("n"))).collect()
    kept = {x.good: x.kept for x in r}
    assert sum(x.n for x in r) > 1900
    assert kept[True] > 0.98 and kept[False] < 0.15


def labels_of(spark, data):
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int, text string")


def test_odd_rows(spark, odd, empty):
    labels = labels_of(spark, [(1, 1, 0, "x"), (2, 1, 0, None), (2, 0, 0, "y"), (8, 0, 0, "x"), (None, 1, 0, "x"), (9, None, 0, "x"),
                               (10, 1, 0, "x"), (10, 1, 0, "x"), (99, 1, 1, "x")])
    got = bq.classify(odd, labels).collect()
    assert len(got) == len(rows()) and all(0 <= r.p_good <= 1 and r.kept == (r.p_good >= 0.5) for r in got)
    left = bq.drop_rejected(odd, labels)
    assert left.columns == odd.columns and left.count() == sum(r.kept for r in got)
    assert bq.classify(empty, labels).collect() == []


def test_without_labels_everything_is_kept(spark, odd):
    got = bq.classify(odd, labels_of(spark, [])).collect()
    assert len(got) == len(rows()) and all(r.kept for r in got)
    assert all(r.kept for r in bq.classify(odd, labels_of(spark, [(1, 1, 0, "x")])).collect())


def test_posteriors_match_the_formulas(spark):
    data = []
    for host, path, n, good in [("a", "x", 300, 290), ("a", "y", 40, 10), ("b", "x", 200, 20), ("c", "x", 1, 1), ("c", "z", 2, 0)]:
        data += [(len(data) + i, host, path, 3.0 if i < good else -3.0) for i in range(n)]
    odds = spark.createDataFrame([(i, i, h, p, o) for i, (_, h, p, o) in enumerate(data)],
                                 "_rid long, doc_id long, host string, path string, odds double")
    got = {r.doc_id: r for r in bq.posteriors(odds).collect()}
    p = [1 / (1 + math.exp(-o)) for *_, o in data]
    mean = sum(p) / len(p)

    def strength(groups):
        n, k = sum(len(g) for g, _ in groups), len(groups)
        spread = sum(len(g) * (sum(g) / len(g) - parent) ** 2 for g, parent in groups)
        v = mean * (1 - mean)
        rho = (spread / n - v * k / n) / (v - v * k / n)
        return min(1e6, max(1, (1 - rho) / rho)) if rho > 0 else 1e6

    by = lambda f: {k: [x for x, d in zip(p, data) if f(d) == k] for k in {f(d) for d in data}}
    hosts, paths = by(lambda d: d[1]), by(lambda d: d[1:3])
    hk = strength([(g, mean) for g in hosts.values()])
    pk = strength([(g, (sum(hosts[h]) + hk * mean) / (len(hosts[h]) + hk)) for (h, _), g in paths.items()])
    logit = lambda x: math.log(x / (1 - x))
    for i, (_, h, q, o) in enumerate(data):
        host = (sum(hosts[h]) - p[i] + hk * mean) / (len(hosts[h]) - 1 + hk)
        path = (sum(paths[h, q]) - p[i] + pk * host) / (len(paths[h, q]) - 1 + pk)
        post = 1 / (1 + math.exp(-(o + logit(path) - logit(mean))))
        assert got[i].p_good == pytest.approx(post, abs=1e-9)
    single = got[len(data) - 3]  # the one document of its path leans on the host and the whole
    assert single.path_posterior == pytest.approx(single.host_posterior)
