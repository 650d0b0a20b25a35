import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weeklens.llm import shard_propagation as sp

from .conftest import rows


def check(got, data, shards):
    assert len(got) == len(data)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values(), default=0) - min((sizes.get(i, 0) for i in range(shards)), default=0) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in data)
    assert {r.law for r in got} <= {"rows"} and {r.grown_shard for r in got} <= {None}


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_odd_rows(odd, shards):
    check(sp.shard_documents(odd, shards).collect(), [(r[0], r[1]) for r in rows()], shards)


def test_empty_table(empty):
    assert sp.shard_documents(empty, 4).collect() == []


def test_groups_stay_whole_where_quotas_allow(plain):
    texts = [f"g{i % 20}" for i in range(120)] + [f"single {i}" for i in range(280)]
    got = sp.shard_documents(plain(texts), 4).collect()
    check(got, list(enumerate(texts)), 4)
    homes = {}
    for r in got:
        homes.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in homes.values())


def test_group_larger_than_a_shard_takes_as_few_as_it_can(plain):
    texts = ["hot"] * 100 + [f"single {i}" for i in range(200)]
    got = sp.shard_documents(plain(texts), 10).collect()
    check(got, list(enumerate(texts)), 10)
    per = Counter(r.shard for r in got if texts[r.doc_id] == "hot")
    assert len(per) == 4 and sorted(per.values()) == [10, 30, 30, 30]


def test_all_documents_linked(plain):
    texts = [f"pair {i // 2}" for i in range(400)]
    got = sp.shard_documents(plain(texts), 8).collect()
    check(got, list(enumerate(texts)), 8)
    split = sum(len({r.shard for r in got if texts[r.doc_id] == t}) > 1 for t in set(texts))
    assert split < 30  # 175 of 200 pairs are split at first


def test_rounds_cut_edges(spark, plain):
    texts = [f"g{i % 30}" for i in range(300)]
    base = plain(texts).select(F.col("text").alias("g"), (F.col("doc_id") % 7 % 5).cast("int").alias("shard"))
    state = base.groupBy("g", "shard").agg(F.count(F.lit(1)).alias("n"))
    final, log = sp.propagate(state, [70] * 5, 6)
    held = final.groupBy("shard").agg(F.sum("n").alias("n")).collect()
    assert max(r.n for r in held) <= 70 and sum(r.n for r in held) == 300
    inside = lambda df: df.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0]
    assert inside(final) > 2 * inside(state) and log[0]["granted"] > 0
    assert all(b["inside"] > a["inside"] for a, b in zip(log, log[1:])) and log[0]["inside"] <= inside(final)


def test_rounds_end_when_groups_only_change_places(plain):
    # one group of five shards' size beside small ones: its parts have nowhere better to go
    texts = ["hot"] * 250 + [f"g{i // 3}" for i in range(300)] + [f"single {i}" for i in range(50)]
    base = plain(texts).select(F.col("text").alias("g"), (F.col("doc_id") * 7 % 12).cast("int").alias("shard"))
    state = base.groupBy("g", "shard").agg(F.count(F.lit(1)).alias("n"))
    final, log = sp.propagate(state, [50] * 12, 40)
    assert len(log) < 12 and all(b["inside"] > a["inside"] for a, b in zip(log, log[1:]))
    held = {r[0]: r[1] for r in final.groupBy("shard").agg(F.sum("n")).collect()}
    assert max(held.values()) <= 50 and sum(held.values()) == 600


def test_granted_moves_fit(seed=0):
    r = np.random.default_rng(seed)
    for _ in range(400):
        n = int(r.integers(1, 9))
        wishes, room = r.integers(0, 50, (n, n)), r.integers(-20, 30, n)
        np.fill_diagonal(wishes, 0)
        moves = sp.granted_moves(wishes, room)
        assert (moves >= 0).all() and (moves <= wishes).all()
        over = moves.sum(axis=0) - moves.sum(axis=1) > room
        assert not (over & (room >= 0)).any()
        assert (moves[:, over] == 0).all()  # what cannot be emptied gets nothing more


@pytest.mark.parametrize("room", [[-16, 0, 0, 0, 0], [-16, -15, 27, 27, 27], [-5, -5, -5, -5, -5]])
def test_granted_moves_end_for_overfull_shards(room):
    wishes = np.zeros((5, 5), int)
    wishes[1, 0], wishes[0, 2], wishes[2, 3] = 1, 9, 30
    moves = sp.granted_moves(wishes, np.array(room))
    assert (moves <= wishes).all() and (moves[1, 0] == 0 or room[0] >= 0 or moves[0].sum() >= 1 - room[0])


def test_departures_of_an_overfull_shard_go_first():
    wishes = np.zeros((3, 3), int)
    wishes[0, 2], wishes[1, 2] = 10, 40
    moves = sp.granted_moves(wishes, np.array([-10, 5, 12]))
    assert moves[0, 2] == 10 and moves[1, 2] == 2
