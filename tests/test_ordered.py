import random

from pyspark.sql import functions as F

from weeklens.operators import ordered as O


def test_running_sums_cut_groups_by_their_own_size(spark, monkeypatch):
    """A group gets as many buckets as the largest one needs, not as the whole frame does; sums stay exact."""
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 50)
    asked, plain = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, p, *a: asked.append(len(p)) or plain(c, p, *a))
    rng = random.Random(3)
    rows = [(g, v, rng.randint(1, 9)) for g in range(20) for v in rng.sample(range(10_000), 240 if g == 7 else 100)]
    got = O.running_sums(spark.createDataFrame(rows, "g int, v long, n long"), ["g"], "v", ["n"]).collect()
    assert asked == [4]  # 240 rows: five buckets; before: one per 50 of all 2,140 rows
    want, at = [], {}
    for g, v, n in sorted(rows):
        at[g] = at.get(g, 0) + n
        want.append((g, v, n, at[g]))
    assert sorted((r.g, r.v, r.n, r.cum_n) for r in got) == want


def test_cuts_below_counts_as_a_filter_does(spark):
    rng = random.Random(4)
    rows = [(sorted(rng.choices(range(30), k=k)), rng.choice([None, *range(-1, 31)])) for k in range(0, 40) for _ in range(4)]
    df = spark.createDataFrame(rows, "cuts array<int>, x int")
    got = df.select(O.cuts_below(F.col("cuts"), F.col("x"), 39).alias("a"), F.size(F.filter("cuts", lambda c: c < F.col("x"))).alias("b")).collect()
    assert len(got) == len(rows) and all(r.a == r.b for r in got)
