import random
import re

import numpy as np
import pytest

from weeklens.llm import template_decontam as td

from .conftest import rows

ITEM = "If Maria buys 12 apples for 3 dollars each and sells 5 km of rope to Peter, how much money does Maria have left over?"
OTHER = "The quick brown fox jumps over the lazy dog while seven wise owls are watching from the old tree."


def bench(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def found(docs, benchmark, **kw):
    return sorted((r.doc_id, r.item_id, r.verbatim) for r in td.leaks(docs, benchmark, **kw).collect())


def test_verbatim_and_changed_questions(spark, plain):
    r = random.Random(1)
    filler = lambda n: " ".join(f"w{r.randrange(999)}x" for _ in range(n))
    changed = ITEM.replace("Maria", "Anton").replace("12", "40").replace("Peter", "Olga").replace("km", "miles")
    mixed = ITEM.replace("how much money does Maria", "how much money does Anton").replace("buys 12 apples for 3", "buys 4 apples for 4")
    texts = [filler(50) + ". " + ITEM + " " + filler(40), f"start {changed} end", filler(80), OTHER.lower(),
             " ".join(ITEM.split()[:6]) + " " + filler(30), mixed, " ".join(ITEM.split()[:18])]
    got = found(plain(texts), bench(spark, [ITEM, OTHER]))
    # the last but one changes one of six values half-way: consistent enough
    assert got == [(0, 0, True), (1, 0, False), (3, 1, True), (5, 0, False), (6, 0, True)]


def test_inconsistent_slots_do_not_count(spark, plain):
    item = "first Anna gave Bert 4 pears and then Anna asked Bert for the 4 pears that Anna had once given to Bert"
    swapped = "first Carl gave Dora 4 pears and then Emil asked Finn for the 9 pears that Gina had once given to Hugo"
    steady = "first Carl gave Dora 7 pears and then Carl asked Dora for the 7 pears that Carl had once given to Dora"
    assert found(plain([item, swapped, steady]), bench(spark, [item])) == [(0, 0, True), (2, 0, False)]


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "The same text, twice. It has two sentences.", "x"), (1, "The same text, twice. It has two sentences.", "x"),
         (None, "Another text under a used id.", None), (4, None, "x"), (5, "", "x"), (6, "two words", "x")],
        "item_id long, text string, doc_id string")
    got = td.leaks(odd, items).collect()
    pairs = sorted(((r.doc_id, r.item_id) for r in got), key=str)
    assert pairs == sorted([(1, 1)] * 2 + [(2, 1)] * 4 + [(2, None)], key=str)
    assert td.leaks(empty, items).collect() == []
    assert td.leaks(odd, items.limit(0)).collect() == []
    left = td.drop_contaminated(odd, items)
    assert left.columns == odd.columns and left.count() == len(rows()) - 4


def test_block_borders_lose_no_window(monkeypatch):
    r = random.Random(3)
    text = " ".join(r.choice(["Name", "word", "12", "km", "end.", "x"]) + str(r.randrange(3)) * r.randrange(2) for _ in range(400))
    whole = list(td.Canon().blocks(text, 7))
    monkeypatch.setattr(td, "_BLOCK", 50)
    parts = list(td.Canon().blocks(text, 7))
    assert len(whole) == 1 and len(parts) > 10
    expected = td.window_hashes(whole[0][0], 8)[0]
    seen = {}
    for h, _, _, place in parts:
        for i, x in enumerate(td.window_hashes(h, 8)[0].tolist()):
            assert seen.setdefault(place + i, x) == x
    assert [seen[i] for i in range(len(expected))] == expected.tolist()


@pytest.mark.parametrize("table", ["sf0.01"])
def test_planted_items(spark, table):
    """Against a search for each item's words, one after the other, in each document."""
    import re
    d = f"/root/testdata/{table}"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    words = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    texts = {r.doc_id: f" {words(r.text)} " for r in docs.collect()}
    whole = {(doc, r.item_id) for r in items.collect() for doc, t in texts.items() if f" {words(r.text)} " in t}
    got = {(r.doc_id, r.item_id) for r in td.leaks(docs, items).collect()}
    assert whole and whole <= got and len({d for d, _ in got - whole}) <= max(1, len(texts) // 200)


def test_hashes_are_of_the_whole_window():
    h = np.arange(20, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = td.window_hashes(h, 8)
    assert len(set(a.tolist())) == len(set(b.tolist())) == 13
    assert td.window_hashes(h[5:13], 8)[0][0] == a[5] and len(td.window_hashes(h[:3], 8)[0]) == 0


@pytest.mark.parametrize("before", ["Quiz question: ", "Q1 ", "He asked ", '"', "7 ", "so "])
def test_short_items_inside_a_line(spark, plain, before):
    item = "What is the boiling point of water?"
    assert found(plain([before + item, before + item.replace("boiling", "freezing")]), bench(spark, [item])) == [(0, 0, True)]


def test_names_that_start_sentences(spark, plain):
    item = "Tom has 5 apples. Tom eats 2 apples. How many apples does Tom have left?"
    changed = item.replace("Tom", "Tim").replace("5", "9").replace("2", "4")
    other = "Tom has 5 apples. Ann eats 2 pears. How many plums does Bob still want?"
    assert found(plain([item, "Task 3: " + changed, other]), bench(spark, [item])) == [(0, 0, True), (1, 0, False)]


def test_items_of_numbers_and_halves(spark, plain):
    numbers, names = "1 2 3 5 8 13 21 34 55 89", "Alice Bob Carol Dave Erin Frank Grace Heidi"
    half = "Tom has 5 apples. Tom eats 2 apples. How many apples does Tom have left?"
    texts = [f"The list {numbers} goes on", "9 8 7 6 5 4 3 2 1 0", f"invited: {names} and more", "so Tom has 5 apples. Tom eats 2 apples. How many apples"]
    assert found(plain(texts), bench(spark, [numbers, names, half])) == [(0, 0, True), (2, 1, True), (3, 2, True)]
    assert found(plain(["so Tom has 5 apples. Tom eats 2 apples. How"]), bench(spark, [half])) == []


def canonical(text):
    """Per view the canonical tokens and slot flags of a text, and its words, in plain Python."""
    tokens = re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?\n]", text or "")
    views, words = [([], []) for _ in range(3)], []
    for k, t in enumerate(tokens):
        if t in ".!?\n":
            continue
        words.append(t)
        low, prior = t.lower(), tokens[k - 1] if k else "."
        number = lambda x: x[0].isdigit() or x.lower() in td.NUMBER_WORDS
        title = not number(t) and low not in td.UNITS and t[0].isupper() and t[1:].islower()
        for view in range(3):
            kind = low
            if view < 2:
                if number(t):
                    kind = "#n"
                elif title and (view == 1 or prior not in ".!?\n"):
                    kind = "#t"
                elif low in td.UNITS and number(prior):
                    kind = "#u"
            views[view][0].append(kind)
            views[view][1].append(kind[0] == "#")
    return views, words


def brute(docs, items, window=8):
    out = []
    for item, text in items:
        views, words = canonical(text)
        if len(words) < td.MIN_WORDS:
            for d, t in docs:
                if words and any(canonical(line)[0][2][0] == views[2][0] for line in (t or "").split("\n")):
                    out.append((d, item, 1, 1, True))
            continue
        size = min(window, len(words))
        for d, t in docs:
            doc_views, doc_words = canonical(t)
            best, plain_ = None, False
            for view in range(3):
                (kinds, slot), (dk, ds) = views[view], doc_views[view]
                telling = [i for i in range(len(words) - size + 1) if sum(slot[i:i + size]) * 2 <= size]
                lines = {}
                for i in telling:
                    for j in range(len(dk) - size + 1):
                        if dk[j:j + size] == kinds[i:i + size]:
                            lines.setdefault(j - i, []).append((i, j))
                matched, verbatim = set(), True
                for hits in lines.values():
                    values = {}
                    for i, j in hits:
                        for k in range(size):
                            if slot[i + k]:
                                values.setdefault(words[i + k], set()).add(doc_words[j + k])
                    if not values or np.mean([len(v) == 1 for v in values.values()]) >= td.CONSISTENCY:
                        matched |= {i for i, _ in hits}
                        verbatim &= all(v == {a} for a, v in values.items())
                if telling and len(matched) / len(telling) >= td.COVERAGE:
                    plain_ |= verbatim
                    best = max(best or (0, 0, 0), (len(matched) / len(telling), len(matched), len(telling)))
            if best:
                out.append((d, item, best[1], best[2], plain_))
    return sorted(out)


def test_leaks_equal_brute_force(spark, plain):
    r = random.Random(7)
    names, things = ["Anna", "Bert", "Carla", "Tom"], ["apples", "km", "pears", "of", "the", "rope", "box", "sells"]
    word = lambda: r.choice([r.choice(names), r.choice(things), str(r.randrange(3)), r.choice(["two", "is.", "a", "by"])])
    items = [" ".join(word() for _ in range(r.choice([2, 3, 5, 6, 8, 9, 14]))) for _ in range(25)]
    docs = []
    for _ in range(150):
        item = r.choice(items).split()
        for i in range(len(item)):
            if r.random() < 0.15:
                item[i] = word()
        lead = [" ".join(word() for _ in range(r.randrange(12)))]
        docs.append(r.choice([" ", "\n", ". "]).join([*lead, " ".join(item), "tail end"]))
    got = sorted((x.doc_id, x.item_id, x.matched, x.windows, x.verbatim) for x in td.leaks(plain(docs), bench(spark, items)).collect())
    want = brute(list(enumerate(docs)), list(enumerate(items)))
    assert got == want and len(want) > 40 and any(len(items[w[1]].split()) < 5 for w in want)


def test_short_items_leak_as_whole_lines(spark, plain):
    texts = ["Intro.\n Two Words! \nmore", "here are two words inside", "two words", "two\nwords", None, "three two words"]
    assert found(plain(texts), bench(spark, ["two words"])) == [(0, 0, True), (2, 0, True)]
