import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from weeklens.llm import poly_fingerprints as pf

from .conftest import rows


def brute(data):
    groups = {}
    for place, r in enumerate(data):
        groups.setdefault(r[1] or "", []).append((r[0] if r[0] is not None else -1, place, r[0]))
    out = []
    for text, members in groups.items():
        last = max(members)
        for m in members:
            out.append((m[2], last[2], len(members), m == last, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def result(docs, **kw):
    got = pf.exact_duplicates(docs, **kw).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted((tuple(r) for r in got), key=str)


def test_odd_rows(odd):
    assert result(odd) == brute(rows())


def test_chunked_huge_texts_give_the_same(odd):
    assert result(odd, chunk_bytes=1000) == brute(rows())


def test_empty_table(empty):
    assert result(empty) == []


def test_rows_dropped_and_columns_kept(odd):
    left = pf.drop_exact_duplicates(odd)
    assert left.columns == odd.columns
    texts = [r.text or "" for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({r[1] or "" for r in rows()})
    assert {r._rid for r in left.collect()} <= {7, None}  # the table's own column of that name


def test_collisions_are_split(spark, plain, monkeypatch):
    # fingerprints that all collide: the comparison of the texts must still tell them apart
    docs = plain(["aa", "bb", "aa", "cc", "bb"])
    real = pf.fingerprints

    def same(*a, **k):
        from pyspark.sql import functions as F
        return real(*a, **k).withColumn("h1", F.lit(1).cast("long")).withColumn("h2", F.lit(1).cast("long"))

    monkeypatch.setattr(pf, "fingerprints", same)
    got = {(r.doc_id, r.keep_id, r.group_size) for r in pf.exact_duplicates(docs).collect()}
    assert got == {(0, 2, 2), (2, 2, 2), (1, 4, 2), (4, 4, 2), (3, 3, 1)}


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 40))
def test_composition(data, cut):
    for prime, base in zip(pf.PRIMES, pf.BASES):
        powers = pf._powers(base, prime, 400)
        whole = pf.chunk_hash(data, prime, powers)
        h = (0, 0)
        for i in range(0, len(data), cut):
            part = data[i:i + cut]
            h = pf.combine(h, (pf.chunk_hash(part, prime, powers), len(part)), prime, base)
        assert h == (whole, len(data))
        assert whole == sum((b + 1) * pow(base, len(data) - 1 - i, prime) for i, b in enumerate(data)) % prime
