import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

from weeklens.llm import periodic_runs as pr
from weeklens.llm.queries import planted_words, run_digests

from .conftest import rows


def brute(words, least=24, repeats=3):
    """All runs by comparing at every lag; a stretch counts with its smallest period only."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, repeats * q) and (i, size) not in seen:
                seen.add((i, size))
                out.append((i, size, q))
            i = j + 1
    return sorted(out)


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def random_words(r, n):
    """Words with planted periodic stretches, nested and side by side, over small and large vocabularies."""
    words = r.integers(0, int(r.choice([2, 3, 50, 10_000])), n).tolist()
    for _ in range(int(r.integers(0, 4))):
        a, p = int(r.integers(0, n)), int(r.integers(1, max(2, n // 3)))
        if r.random() < 0.3:
            p = int(r.integers(1, 20))
        end = min(n, a + int(p * (2 + 4 * r.random())))
        for i in range(a + p, end):
            words[i] = words[i - p]
    return words


def test_find_runs_equals_brute_force():
    r = np.random.default_rng(3)
    some = 0
    for _ in range(600):
        words = random_words(r, int(r.integers(1, 400)))
        want = brute(words)
        some += bool(want)
        assert pr.find_runs(np.array(words, dtype=np.int64)) == want
    assert some > 200


@pytest.mark.parametrize("least, repeats", [(1, 3), (5, 3), (24, 4), (40, 5)])
def test_other_lengths_and_repeats(least, repeats):
    r = np.random.default_rng(least)
    for _ in range(150):
        words = random_words(r, int(r.integers(1, 200)))
        assert pr.find_runs(np.array(words, dtype=np.int64), least, repeats) == brute(words, least, repeats)


def test_every_period_is_covered_at_the_least_length():
    r = np.random.default_rng(5)
    for q in list(range(1, 120)) + [333, 1000, 2500]:
        size = max(24, 3 * q)
        words = np.concatenate([r.integers(10**6, 10**7, 17), np.resize(np.arange(q), size), r.integers(10**6, 10**7, 9)])
        assert (17, size, q) in pr.find_runs(words)
        assert not any(p == q for _, _, p in pr.find_runs(np.delete(words, 17)))


def expected(rows_):
    out = []
    for doc, text in rows_:
        words = planted_words(doc, (text or "").encode().split())
        runs = brute(words)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        out.append((doc, len(runs), *(best[:3] if best else (None,) * 3), best and 1000 * best[1] // best[2],
                    hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                    hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()))
    return sorted(out, key=str)


def digests(df):
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r) for r in run_digests(pr.periodic_runs(df, prepare=planted_words)).select(cols).collect()), key=str)


def test_documents_equal_brute_force(plain):
    r = np.random.default_rng(9)
    texts = [" ".join(f"w{w}" for w in random_words(r, int(r.integers(0, 300)))) for _ in range(150)]
    texts += ["la " * 500, "a b " * 40 + "c " + "a b " * 40, "\t\n ", "x y " * 30, "é\x0bè\x0c" * 20]
    assert digests(plain(texts)) == expected(list(enumerate(texts)))
    hit = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert hit


def test_odd_rows(odd):
    # the long text is too long for the brute force: its rows are compared without it
    short = [(r[0], r[1]) for r in rows() if len(r[1] or "") < 10_000]
    got = digests(odd)
    assert len(got) == len(rows())
    assert [g for g in got if g[0] not in (8, 9)] == expected(short)


def test_long_text(plain):
    text = "intro " + " ".join(f"w{i % 5000}" for i in range(60_000)) + " outro"
    got = pr.periodic_runs(plain([text])).collect()[0]
    assert [tuple(x) for x in got.runs] == [(1, 60_000, 5000)] and got.n_words == 60_002
    assert got.collapsed.split() == ["intro", *[f"w{i}" for i in range(5000)], "outro"]


def test_empty_table(empty):
    assert digests(empty) == []
