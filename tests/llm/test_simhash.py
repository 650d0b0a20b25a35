import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weeklens.llm import simhash_trie as st

from .conftest import rows


def fingerprint(text, words=4):
    w = text.encode().lower().split()
    if not w:
        return 0
    runs = [w] if len(w) < words else [w[i:i + words] for i in range(len(w) - words + 1)]
    h = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(data, max_bits=4):
    fps = [fingerprint(t or "") for _, t in data]
    label = list(range(len(data)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                label[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(data):
        ids = [data[j][0] for j in range(len(data)) if find(j) == find(i) and data[j][0] is not None]
        out.append((d, f"{fps[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def result(docs):
    got = st.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    return sorted((tuple(r) for r in got), key=str)


def test_odd_rows(odd):
    assert result(odd) == brute([(r[0], r[1]) for r in rows()])


def test_empty_table(empty):
    assert result(empty) == []


def test_text_blocks_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(str(random.Random(1).random()) for _ in range(500))
    monkeypatch.setattr(st, "_TEXT_BLOCK", 37)
    assert st.simhash(text) == fingerprint(text)
    assert st.simhash("a b") == fingerprint("a b")


def families(seed, n, centres, near):
    r = random.Random(seed)
    out = {r.getrandbits(64) for _ in range(n)}
    for _ in range(centres):
        c = r.getrandbits(64)
        for _ in range(near):
            out.add(c ^ sum({1 << r.randrange(64) for _ in range(r.randrange(6))}))
    return sorted(out)


def linked(fps, max_bits):
    v = np.array(fps, dtype=np.uint64)
    label = np.arange(len(v))
    for i in range(len(v)):
        near = np.flatnonzero(np.bitwise_count(v ^ v[i]) <= max_bits)
        st._joined(label, np.full(len(near), i), near)
    return label


@pytest.mark.parametrize("seed,max_bits", [(1, 4), (2, 4), (3, 2), (4, 6)])
def test_trie_join_finds_all_links(spark, seed, max_bits):
    fps = families(seed, 600, 12, 60)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    edges = st.trie_links(df, len(fps), max_bits)
    found = {r.node: r.root for r in st.components(edges).collect()}
    label = linked(fps, max_bits)
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    groups, expected = {}, {}
    for x, lab in zip(fps, label.tolist()):
        expected.setdefault(lab, set()).add(sign(x))
        groups.setdefault(found.get(sign(x), sign(x)), set()).add(sign(x))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_large_group_stays_linear(spark):
    # one centre and all fingerprints within two bits of it: over two million pairs, few edges leave the tasks
    c = 0x0123456789ABCDEF
    fps = {c} | {c ^ (1 << i) for i in range(64)} | {c ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)}
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    edges = st.trie_links(df, len(fps)).cache()
    assert edges.count() < 30 * len(fps)
    assert st.components(edges).select("root").distinct().count() == 1


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 300).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    got = st.components(edges).collect()
    assert len(got) == 300 and {r.root for r in got} == {1}


def test_one_row_of_each_component_stays(odd):
    left = st.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    expected = {c for _, _, c in brute([(r[0], r[1]) for r in rows()])}
    assert left.count() == len(expected)
