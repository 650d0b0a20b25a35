import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weeklens.llm import sentence_spans as ss
from weeklens.llm.common import CLEANUP, stage

from .conftest import rows


def brute(data, sentences=ss.SENTENCES, words=ss.WORDS):
    """Texts without the sentences that a later occurrence of a span covers."""
    first, hits = {}, {}
    order = sorted(range(len(data)), key=lambda i: (data[i][0] is None, data[i][0] or 0, i))
    for i in order:
        for pos, n, *h in zip(*(x.tolist() for x in ss.Pieces(data[i][1] or "", ss._Words()).spans(sentences, words))):
            h = tuple(h)
            if h in first:
                hits.setdefault(i, set()).update(range(pos, pos + n))
            else:
                first[h] = (i, pos)
    out = []
    for i, (d, t) in enumerate(data):
        t, at, kept = t or "", 0, []
        for k, end in enumerate(ss.Pieces(t, ss._Words()).chars.tolist()):
            if k not in hits.get(i, ()):
                kept.append(t[at:end])
            at = end
        out.append((d, "".join(kept) if t.strip() else t))
    return sorted(out, key=str)


def result(docs, **kw):
    return sorted(((r.doc_id, r.text) for r in ss.remove_repeats(docs, **kw).collect()), key=str)


def test_odd_rows(odd):
    assert result(odd) == brute([(r[0], r[1]) for r in rows()])


def test_empty_table(empty):
    assert result(empty) == []


def prose(r, words):
    out = []
    while sum(len(s.split()) for s in out) < words:
        out.append(" ".join(f"w{r.randrange(5000)}" for _ in range(r.randrange(2, 14))).capitalize() + r.choice([".", "!", "?", ".\n"]))
    return " ".join(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(plain, seed):
    r = random.Random(seed)
    passage, other = prose(r, 60), prose(r, 80)
    texts = [" ".join([prose(r, r.randrange(80)), r.choice([passage, other, ""]), prose(r, r.randrange(60))]) for _ in range(60)]
    texts += [passage + " " + passage, "", "Short. Text.", "Short. Text."]
    got = result(plain(texts))
    assert got == brute(list(enumerate(texts)))
    middle = " ".join(passage.split()[12:48])
    assert sum(middle in " ".join(t.split()) for _, t in got) == 1
    assert dict(got)[len(texts) - 1] == "Short. Text."  # below a span's size


def test_pieces_make_up_the_text(monkeypatch):
    r = random.Random(4)
    for t in [prose(r, 100), "no end in sight " * 200, "", "\n\n", "a.b.c", " ...", "x\n\n\ny", rows()[10][1][:5000], "Ü. É! 東"]:
        p = ss.Pieces(t, ss._Words())
        ends, words = p.chars.tolist(), p.words.tolist()
        assert ends == sorted(set(ends)) and (ends[-1] == len(t) if t.strip() else not ends)
        assert all(b - a <= ss.LONG for a, b in zip([0, *words], words)) and (words or [0])[-1] == len(t.split())
        monkeypatch.setattr(ss, "_BLOCK", 11)
        again = ss.Pieces(t, ss._Words())
        assert again.chars.tolist() == ends and again.words.tolist() == words
        monkeypatch.undo()


def test_span_hashes_depend_on_the_words_alone():
    r = random.Random(5)
    p = prose(r, 60)
    known = ss._Words()
    alone = ss.Pieces(p, known).spans(2, 20)
    inside = ss.Pieces("Something else. " + prose(r, 50) + "\n" + p.replace(" ", "  "), known).spans(2, 20)
    assert set(alone[2].tolist()) <= set(inside[2].tolist()) and set(alone[3].tolist()) <= set(inside[3].tolist())
    assert len(set(inside[2].tolist())) == len(inside[2])


def test_removed_pieces_and_sources_are_told(plain):
    r = random.Random(9)
    p = prose(r, 60)
    got = {x.doc_id: x for x in ss.remove_repeats(plain([p, "Own start here. " + p, prose(r, 50)])).collect()}
    assert got[0].removed == [] and got[2].n_removed == 0 and got[1].first_docs == [0]
    span = got[1].removed[0]
    assert ("Own start here. " + p)[span.start:span.end].strip() in p


def loose(r, words, ends):
    """Words in which a sentence ends here and there, or nowhere."""
    return [f"w{r.randrange(50_000)}" + (r.choice([".", "!", "\n"]) if r.random() < ends else "") for _ in range(words)]


def left_windows(texts, size):
    """Runs of ``size`` words that stand in more than one place."""
    seen, again = set(), 0
    for t in texts:
        w = t.lower().split()
        for i in range(len(w) - size + 1):
            run = tuple(w[i:i + size])
            again += run in seen
            seen.add(run)
    return again


@pytest.mark.parametrize("ends,size", [(0.1, 51), (0, 51), (0, 80), (0.02, 120)])
def test_passages_inside_sentences_go_to_the_word(plain, ends, size):
    r = random.Random(size)
    texts, rest = [], []
    for _ in range(60):
        passage = loose(r, size, ends)
        for copy in range(2):
            before, behind = loose(r, r.randrange(5, 90), ends), loose(r, r.randrange(5, 90), ends)
            before[-1], behind[0] = f"before{len(texts)}", f"behind{len(texts)}"
            texts.append(" ".join(before + passage + behind))
            rest.append(before + behind if copy else before + passage + behind)
    got = {x.doc_id: x for x in ss.remove_passages(plain(texts)).collect()}
    assert left_windows(texts, 50) == 60 * (size - 49) and left_windows([x.text for x in got.values()], 50) == 0
    assert [got[i].text.split() for i in range(len(texts))] == [" ".join(w).split() for w in rest]
    assert all(got[i].first_docs == [i - 1] for i in range(1, len(texts), 2))


def test_passages_of_odd_rows(odd, empty):
    got = sorted(((x.doc_id, x.text) for x in ss.remove_passages(odd).collect()), key=str)
    expected = sorted(((d, "" if d == 9 else t or "") for d, t, *_ in rows()), key=str)
    texts = {d: t for d, t in got}
    assert [g for g in got if g[0] not in (8, 9)] == [e for e in expected if e[0] not in (8, 9)]
    assert texts[9] == "" and left_windows([texts[8]], 50) == 0
    assert ss.remove_passages(empty).collect() == []


def test_repeated_runs_of_one_text_leave_its_first(plain):
    got = {x.doc_id: x.text for x in ss.remove_passages(plain(["no end in sight " * 200, "own " + "no end in sight " * 30])).collect()}
    assert got[0].split() == "no end in sight".split() * (len(got[0].split()) // 4) and 20 <= len(got[0].split()) <= 30
    assert got[1].split() == ["own"]


def match_by_match(texts, reach=ss.PASSAGE - ss.WORDS):
    """Texts without the words of later matches, each of which is held against its first occurrence by itself."""
    cut = [ss.Pieces(t, ss._Words()) for t in texts]
    runs = [list(zip(*(c.tolist() for c in p.runs(ss.SENTENCES, ss.WORDS, ss.PASSAGE)))) for p in cut]
    counts = Counter(h for of in runs for *_, h in of)
    again = [h for h, n in counts.items() if n > 1]
    bits = max(16, (len(again) * 16).bit_length())
    known = set(ss._places(np.array(again, dtype=np.uint64), bits).tolist())
    first, out = {}, []
    for i, (text, p) in enumerate(zip(texts, cut)):
        words = (p.hashes >> np.uint64(32)).tolist()
        hits = [r for r in runs[i] if int(ss._places(np.array([r[2]], dtype=np.uint64), bits)[0]) in known]
        short = [a for a, b, _ in hits if b - a == ss.WORDS]
        gone = set()
        for a, b, h in hits:
            told = b - a == ss.WORDS or not any(a - ss.WORDS < s < b for s in short)
            if h not in first:
                first[h] = (i, a, told, words)
                continue
            doc, fa, first_told, other = first[h]
            start, end, least = a, b, fa + b - a if doc == i else 0
            if told and first_told:
                while start > 0 and fa - (a - start) > 0 and a - start < reach and words[start - 1] == other[fa - (a - start) - 1]:
                    start -= 1
                while end < len(words) and end - b < reach and end - a + fa < len(other) and words[end] == other[end - a + fa]:
                    end += 1
            gone.update(range(max(start, least), end))
        out.append([w for k, w in enumerate(text.split()) if k not in gone])
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stretches_remove_what_single_matches_do(plain, seed):
    r = random.Random(seed)
    base = [loose(r, 400, 0.08) for _ in range(4)]
    texts = []
    for _ in range(50):  # near copies, parts of copies, parts beside each other, one part twice
        words = [w if r.random() > r.choice([0, 0.01, 0.04]) else f"x{r.randrange(50_000)}" for w in r.choice(base)]
        a, b = r.randrange(200), r.randrange(200, 400)
        words = r.choice([words, words[a:b], words[a:b] + r.choice(base)[a:b], words[a:b] + words[a:b]])
        texts.append(" ".join(loose(r, r.randrange(40), 0.1) + words + loose(r, r.randrange(40), 0.1)))
    texts.append(" ".join(["a line that comes again and again."] * 60))
    got = {x.doc_id: x.text.split() for x in ss.remove_passages(plain(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == match_by_match(texts)


def test_long_copies_ask_for_the_words_at_their_ends_only(spark):
    r = random.Random(11)
    passage = loose(r, 3000, 0.1)
    texts = [" ".join(loose(r, 50, 0.1) + passage + loose(r, 50, 0.1)) for _ in range(3)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id as _rid", "doc_id", "text")
    marks = ss.repeated_runs(rows)
    assert "binary" not in {kind for _, kind in marks.dtypes}
    kinds = Counter((m["_rid"], m["kind"]) for m in marks.collect())
    assert sum(kinds.values()) <= 6 and kinds[1, ss._GONE] == kinds[2, ss._GONE] == 1
    assert not any(rid == 0 for rid, _ in kinds)


def test_runs_are_read_back_as_they_were_cut(monkeypatch):
    r = random.Random(12)
    monkeypatch.setattr(ss, "_ROWS", 3)
    texts = ["", " ".join(loose(r, 500, 0.1)), "short", " ".join(loose(r, 130, 0)), " ".join(loose(r, 900, 0.02))]
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts)], names=["_rid", "doc_id", "text"])

    class Full:
        value = b"\xff" * (1 << 13)

    cut = list(ss._cut_task(2, 20, 50)([batch]))
    assert len(cut) > 1 and [x for c in cut for x in c.column("_rid").to_pylist()] == list(range(n))
    whole = pa.Table.from_batches(cut).combine_chunks().to_batches()
    found = pa.Table.from_batches(list(ss._run_task(2, 20, 50, Full, 16)(whole))).to_pydict()
    expected = [(i, a, b, h) for i, t in enumerate(texts) for a, b, h in zip(*(c.tolist() for c in ss.Pieces(t, ss._Words()).runs(2, 20, 50)))]
    assert [(i, a, b, h & (1 << 64) - 1) for i, a, b, h in zip(*(found[c] for c in ("_rid", "a", "b", "h1")))] == expected


def test_tidy_stages_leave_no_shuffle_files(spark):
    before = spark.conf.get(CLEANUP, None)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {b.toString() for b in _items(blocks.getAllBlocks()) if b.isShuffle()}
    kept = files()
    staged = stage(spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).count(), "tidy", tidy=True)
    for _ in range(50):
        if not files() - kept:
            break
        time.sleep(0.1)
    assert not files() - kept and spark.conf.get(CLEANUP, None) == before
    assert staged.count() == 1000


def _items(seq):
    return [seq.apply(i) for i in range(seq.size())]
