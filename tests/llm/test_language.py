import math
import zlib
from collections import Counter

import numpy as np
import pytest

from weeklens.llm import ecoc_language as el
from weeklens.llm.queries import op13_ecoc_language

from .conftest import rows

SF = "/root/testdata/sf0.01"


def held(doc):
    return zlib.crc32(str("" if doc is None else doc).encode()) % 4 == 2


def plain_grams(text, buckets, orders):
    """The n-grams letter by letter."""
    codes, before = [32], False
    for c in text:
        if c.isalpha():
            codes.append(ord(c.lower()) if len(c.lower()) == 1 else ord(c))
        elif before:
            codes.append(32)
        before = c.isalpha()
    mults, out = [0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], Counter()
    for i in range(len(codes)):
        h = 0
        for n in range(orders):
            if i + n >= len(codes):
                break
            h = (h + codes[i + n]) * mults[n] % 2**32
            h ^= h >> 15
            out[((h * 0x2C1B3C6D) % 2**32) >> (32 - buckets.bit_length() + 1)] += 1
    return out


@pytest.mark.parametrize("text", ["Hello, World!", "a", "Straße  ÉTÉ 12 東京\U0001F600x", "x" * 50, "one two"])
def test_grams_equal_plain_python(text):
    got = Counter(np.concatenate(list(el.Grams(1 << 12, 3)(text))).tolist())
    assert got == plain_grams(text, 1 << 12, 3)


def test_letterless_start_is_one_space():
    assert list(el.Grams(1 << 12, 2)("")) == []
    assert sum(len(g) for g in el.Grams(1 << 12, 1)("...")) >= 1


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 7, 12, 40])
def test_codebook_corrects_errors(n):
    code = el.codebook(n)
    assert set(np.unique(code)) == {-1, 1} and (abs(code.sum(axis=0)) < n).all()
    apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    if n <= el.EXHAUSTIVE:
        assert code.shape[1] == 2 ** (n - 1) - 1 and set(apart) == {2 ** (n - 2)}
    else:
        assert code.shape[1] <= math.ceil(10 * math.log2(n)) and min(apart) > code.shape[1] // 5
    assert (el.codebook(n) == code).all()


def test_decoding_equals_plain_python_and_mends_one_wrong_bit():
    r = np.random.default_rng(1)
    code = el.codebook(4)
    trust = r.random(code.shape)
    odds = r.normal(0, 8, (30, code.shape[1]))
    want = [[sum(t * math.log1p(math.exp(-c * max(-el.CAP, min(el.CAP, z)))) for t, c, z in zip(trust[k], code[k], row))
             for k in range(4)] for row in odds]
    assert np.allclose(el.decode(odds, code, trust), want)
    even = np.full(code.shape, 1 / code.shape[1])
    for lang in range(4):
        for wrong in range(code.shape[1]):
            z = 3.0 * code[lang].astype(float)
            z[wrong] = -z[wrong]
            assert el.decode(z[None], code, even)[0].argmin() == lang


def test_weights_equal_plain_python(spark):
    r = np.random.default_rng(2)
    letters = {"aa": "abcd", "bb": "cdef", "cc": "efgh", "dd": "xyz"}
    data = [(k, " ".join("".join(r.choice(list(v), 5)) for _ in range(20))) for k, v in letters.items() for _ in range(6)]
    model = el.fit(spark.createDataFrame(data, "lang string, text string"), buckets=1 << 10, orders=2)
    counts = {k: Counter() for k in letters}
    for k, t in data:
        counts[k] += plain_grams(t, 1 << 10, 2)
    weights = np.frombuffer(model.weights, np.float32).reshape(1 << 10, -1)
    share = {k: lambda g, k=k: (counts[k][g] + el.SMOOTHING) / (sum(counts[k].values()) + el.SMOOTHING * 1024) for k in letters}
    for g in list(counts["aa"] | counts["dd"])[:40] + [5]:
        for b in range(model.code.shape[1]):
            up = [share[k](g) for i, k in enumerate(model.languages) if model.code[i, b] > 0]
            down = [share[k](g) for i, k in enumerate(model.languages) if model.code[i, b] < 0]
            assert abs(weights[g, b] - math.log(np.mean(up) / np.mean(down))) < 1e-5
    assert np.allclose(model.trust.sum(axis=1), 1)


def test_long_texts_are_read_whole(spark, plain):
    model = el.fit(spark.createDataFrame([("aa", "abcab bca"), ("bb", "xyzxy zyx")], "lang string, text string"))
    grams, w = el.Grams(el.BUCKETS, el.ORDERS), np.frombuffer(model.weights, np.float32).reshape(el.BUCKETS, -1)
    text = "abc " * 40_000 + "xyz " * 60_000
    pieces = sum(len(g) for g in grams(text))
    assert abs(pieces - 4 * len(text)) < 20
    got = {r.doc_id: r.lang_pred for r in el.predict(plain([text, "abc " * 60_000 + "xyz " * 40_000]), model).collect()}
    assert got == {0: "bb", 1: "aa"} and w.shape[1] == 1


def test_held_out_accuracy_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    got = op13_ecoc_language(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    judged = [r for r in got if r.held_out and any(c.isalpha() for c in truth[r.doc_id][1] or "")]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in judged) > 0.97 * len(judged)
    by_lang = {}
    for r in judged:
        by_lang.setdefault(truth[r.doc_id][0], []).append(r.lang_pred == truth[r.doc_id][0])
    assert all(np.mean(v) > 0.9 for v in by_lang.values())


def test_labels_of_held_out_rows_and_other_columns_are_no_input(spark):
    docs = [(i, f"{'la le lu' if i % 2 else 'kra kro kri'} {i}", "en" if i % 2 else "de", "s") for i in range(60)]
    shown = [(d, t, lang if not held(d) else "xx", "t") for d, t, lang, _ in docs]
    frames = [spark.createDataFrame(x, "doc_id long, text string, lang string, source string") for x in (docs, shown)]
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in el.identify(f).collect()} for f in frames)
    assert a == b and {v[0] for v in a.values()} == {"en", "de"}


def test_near_texts_are_flagged(spark):
    rows_ = [(i, "abab baba" if i % 2 else "xyxy yxyx", "en" if i % 2 else "de") for i in range(40)]
    rows_.append((999, "q" * 400, None))
    got = {r.doc_id: r for r in el.identify(spark.createDataFrame(rows_, "doc_id long, text string, lang string")).collect()}
    assert got[999].ambiguous and not got[1].ambiguous


def test_odd_rows(odd):
    got = el.identify(odd).collect()
    assert sorted((str(r.doc_id), r.held_out) for r in got) == sorted((str(d[0]), held(d[0])) for d in rows())
    letters = {str(d[0]): any(c.isalpha() for c in d[1] or "") for d in rows() if d[0] not in (None,)}
    for r in got:
        if r.doc_id is not None and not letters[str(r.doc_id)]:
            assert (r.lang_pred, r.score, r.ambiguous) == ("und", 0.0, True)
    assert {r.lang_pred for r in got} == {"und", "de"}


def test_nothing_to_learn_and_empty_table(spark, empty, plain):
    assert el.identify(empty).collect() == []
    got = el.identify(plain(["some text", None], lang=None)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
