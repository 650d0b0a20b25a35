import numpy as np
import pytest
from pyspark.sql import functions as F

from weeklens.operators import grid as G
from weeklens.operators import sampling as SA
from weeklens.operators import split as S
from weeklens.sources import load_raw

from conftest import SF_SMALL


@pytest.mark.parametrize("total", [1, 2, 3, 7, 10, 97, 100, 1000, 4097])
def test_whole_range_is_a_permutation(spark, total):
    got = [r[0] for r in SA.sample_numbers(spark, total, total + 5).collect()]
    assert sorted(got) == list(range(total)) and (total < 10 or got != sorted(got))


def test_seeds_and_partitions(spark):
    a, b = ([r[0] for r in SA.sample_numbers(spark, 10**15, 50, seed=s).collect()] for s in (1, 2))
    again = [r.y for r in SA.permute(spark.range(0, 50, 1, 17), F.col("id"), 10**15, F.lit(1), "y").collect()]
    assert a == again and not set(a) & set(b) and all(0 <= x < 10**15 for x in a) and len(set(a)) == 50
    assert SA.sample_numbers(spark, 0, 10).collect() == []


def test_uniform(spark):
    # every cell of 40 x 25 is drawn about equally often, alone and in pairs of neighbours
    total, n = 1000, 100
    seen, pairs = np.zeros(total), 0
    frames = [SA.sample_numbers(spark, total, n, seed=s) for s in range(60)]
    out = frames[0].withColumn("s", F.lit(0))
    for s, f in enumerate(frames[1:], 1):
        out = out.unionByName(f.withColumn("s", F.lit(s)))
    drawn = {}
    for r in out.collect():
        seen[r.cell] += 1
        drawn.setdefault(r.s, set()).add(r.cell)
    assert all(len(d) == n for d in drawn.values())
    expected = 60 * n / total
    chi = ((seen - expected) ** 2 / (expected * (1 - n / total))).sum()
    assert 800 < chi < 1200  # 999 degrees of freedom: mean 999, deviation 45
    pairs = sum(len({c + 1 for c in d} & d) for d in drawn.values())
    assert 400 < pairs < 800  # 60 x 999 x 0.01 = 594
    by_week, by_product = (np.bincount([c % 25 if k else c // 25 for d in drawn.values() for c in d]) for k in (1, 0))
    assert by_week.min() > 150 and by_product.min() > 90


def test_grid_sample_equals_grid_rows(spark):
    g = G.build_grid(*load_raw(spark, SF_SMALL, "brand"))
    t_end, _ = S.split_bounds(g.weeks())
    train, _, _ = S.temporal_split(g.df, weeks=g.weeks())
    total = train.count()
    got = g.sample(5000, last_week=t_end)
    assert got.columns == g.df.columns and got.count() == 5000 == got.select(*G.KEYS).distinct().count()
    assert got.exceptAll(train).count() == 0
    share = train.agg(F.avg("comprado")).first()[0]
    assert abs(got.agg(F.avg("comprado")).first()[0] - share) < 4 * (share / 5000) ** 0.5
    assert sorted(got.select(*G.KEYS).collect()) == sorted(g.sample(5000, last_week=t_end).select(*G.KEYS).collect())
    assert g.sample(total + 10, last_week=t_end).count() == total
    # neither the grid nor a sort of it is planned
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in plan and "TakeOrderedAndProject" not in plan
