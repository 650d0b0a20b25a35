"""Benchmark decontamination by template canonicalisation.

Words of benchmark items and documents become canonical tokens: numbers, names
(capitalised inside a sentence) and units (after a number) are replaced by
typed placeholders, all else is lower-cased. Every window of ``window`` tokens
is hashed to 128 bits and the windows of both sides are joined on the hash.

A capitalised word that starts a sentence may be a name or not, and the same
word may stand inside a sentence elsewhere. So texts are read in three views:
capitalised words are names inside sentences only; they are names everywhere;
and no word is a placeholder, so that verbatim copies count whatever they are
made of. An item leaks if it leaks in any view. A
matched window brings along the values that stood in its slots.

Matches are laid out by (document, item, alignment). An alignment counts if its
slots are consistent: the same item value always turned into the same document
value, as in a question asked again with other numbers and names, and unlike a
chance likeness of templates. An item leaks into a document if consistent
alignments cover at least ``coverage`` of the item's windows.

Documents are read once and whole. Their windows pass a bit map of the
benchmark's hashes (its size is a bounded parameter and does not grow with the
documents) before any row leaves the task, so the join shuffles matches and
some chance hits, not the corpus.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import column, settled, stage, with_row_id, without_rows

WINDOW = 8
MIN_WORDS = 5
COVERAGE = 0.5
CONSISTENCY = 0.8
MAP_BITS = 27

# Words that stand for numbers, and unit names.
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                "million billion").split()
UNITS = ("mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz pound pounds ounce ounces "
         "gram grams ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h "
         "hr hrs hour hours day days week weeks month months year years meter meters metre metres kilometer "
         "kilometers kilometre kilometres kilogram kilograms centimeter centimeters percent dollar dollars cent cents "
         "euro euros usd eur mph kmh kph hz khz mhz ghz kb mb gb tb w kw v a k c f degrees").split()

VIEWS, _LITERAL = 3, 2
_WORD, _TITLE, _NUMBER, _UNIT, _END = 0, 1, 2, 3, 4
_PLACEHOLDER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?\n]")
_SPACE = re.compile(r"\s")
_BLOCK = 1 << 20
_KNOWN = 1_000_000
_M1, _M2 = np.uint64(0x5851F42D4C957F2D), np.uint64(0xD1342543DE82EF95)


class _Index(dict):
    """Number of each token, and by that number its hash and kind; a new token is learnt as it is looked up."""

    def __init__(self):
        self.hashes, self.kinds = array("Q"), array("b")

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token in ".!?\n":
            kind = _END
        elif token[0].isdigit() or low in _NUMBER_SET:
            kind = _NUMBER
        elif low in _UNIT_SET:
            kind = _UNIT
        else:
            kind = _TITLE if token[0].isupper() and token[1:].islower() else _WORD
        self.hashes.append(xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass")))
        self.kinds.append(kind)
        self[token] = out = len(self.kinds) - 1
        return out


class _Told:
    """The words of a block: some of the block before, then those of its tokens that are words; looked up when
    they are asked for, which is at matches only."""

    def __init__(self, before: list[str], tokens: list[str], at: np.ndarray):
        self.before, self.tokens, self.at = before, tokens, at

    def __len__(self) -> int:
        return len(self.before) + len(self.at)

    def __getitem__(self, i: int) -> str:
        n = len(self.before)
        return self.before[i] if i < n else self.tokens[self.at[i - n]]


class Canon:
    """Canonical tokens of a text: hash, slot flag and the word itself."""

    def __init__(self):
        self.index = _Index()

    def blocks(self, text: str, overlap: int):
        """(hash, is_slot, words, place of the first token) per mebibyte of text; blocks share ``overlap`` tokens."""
        for (h, *_), (slot, *_), words, place in self.views(text, overlap):
            yield h, slot, words, place

    def views(self, text: str, overlap: int):
        """As ``blocks``, with the hashes and slots of each view."""
        at, place, before = 0, 0, _END
        tail = [np.zeros(0, np.uint64)] * VIEWS, [np.zeros(0, bool)] * VIEWS, []
        while at < len(text):
            hit = _SPACE.search(text, at + _BLOCK) if at + _BLOCK < len(text) else None
            end = hit.end() if hit else len(text)
            tokens = _TOKEN.findall(text[at:end])
            at = end
            if not tokens:
                continue
            if len(self.index) > _KNOWN:
                self.index = _Index()
            known = self.index
            ix = np.fromiter(map(known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
            kind, plain = (np.frombuffer(x, t)[ix] for x, t in ((known.kinds, np.int8), (known.hashes, np.uint64)))
            prior = np.concatenate([[before], kind[:-1]])
            before = kind[-1]
            title = kind == _TITLE
            unit = (kind == _UNIT) & (prior == _NUMBER)
            number = kind == _NUMBER
            word = kind != _END
            hashes, slots = [], []
            for name in (title & (prior != _END), title):
                h = plain.copy()
                h[number], h[name], h[unit] = _PLACEHOLDER
                hashes.append(h[word])
                slots.append((number | name | unit)[word])
            hashes.append(plain[word])
            slots.append(np.zeros(len(hashes[0]), bool))
            words = _Told(tail[2], tokens, np.flatnonzero(word))
            hashes = [np.concatenate([t, h]) for t, h in zip(tail[0], hashes)]
            slots = [np.concatenate([t, x]) for t, x in zip(tail[1], slots)]
            yield hashes, slots, words, place
            keep = min(overlap, len(words))
            place += len(words) - keep
            tail = ([h[len(h) - keep:] for h in hashes], [x[len(x) - keep:] for x in slots],
                    [words[i] for i in range(len(words) - keep, len(words))])


_NUMBER_SET, _UNIT_SET = frozenset(NUMBER_WORDS), frozenset(UNITS)


def _first_hashes(h: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(h) - size + 1)
    a = np.full(n, size, np.uint64)
    for i in range(size if n else 0):
        a *= _M1
        a += h[i:i + n]
    return a ^ (a >> np.uint64(31))


def _second_hashes(h: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    b = np.full(len(at), size, np.uint64)
    for i in range(size):
        x = h[at + i]
        b = b * _M2 + (x ^ (x >> np.uint64(29))) * _M2
    return b ^ (b >> np.uint64(31))


def window_hashes(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64 bit hashes of every run of ``size`` tokens."""
    a = _first_hashes(h, size)
    return a, _second_hashes(h, size, np.arange(len(a)))


_OUT = "key long, id long, view int, pos int, size int, total int, h1 long, h2 long, slots array<string>"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=[c.split()[0] for c in _OUT.split(", ")])


def _signed(x) -> int:
    return int(x) - (1 << 64) if int(x) >= 1 << 63 else int(x)


def _item_windows(window: int, min_words: int):
    """All windows of benchmark items; an item of fewer than ``window`` words is one window."""

    def run(batches):
        canon = Canon()
        for batch in batches:
            rows = []
            for key, ident, text in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "text"))):
                parts = list(canon.views(text, 0))
                words = [p[2][i] for p in parts for i in range(len(p[2]))]
                if len(words) < min_words:
                    if words:  # looked for as a whole line: its size is told by a negative number
                        h = np.concatenate([p[0][_LITERAL] for p in parts])
                        a, b = window_hashes(h, len(words))
                        rows.append((key, ident, _LITERAL, 0, -len(words), 1, _signed(a[0]), _signed(b[0]), []))
                    continue
                size = min(window, len(words))
                for view in range(VIEWS):
                    h, slot = (np.concatenate([p[k][view] for p in parts]) for k in (0, 1))
                    a, b = window_hashes(h, size)
                    # a window that is mostly placeholders says nothing
                    telling = [int(size - slot[i:i + size].sum()) * 2 >= size for i in range(len(a))]
                    total = sum(telling)
                    for i, ok in enumerate(telling):
                        if ok:
                            values = [words[j] for j in range(i, i + size) if slot[j]]
                            rows.append((key, ident, view, i, size, total, _signed(a[i]), _signed(b[i]), values))
            if rows:
                yield _batch(rows)

    return run


def _places(h1: np.ndarray, bits: int) -> np.ndarray:
    return ((h1 * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _view_hits(hashes, size: int, known: np.ndarray, bits: int):
    """(view, first hashes, starts the bit map knows) of the windows of one size. All windows of all views are
    hashed: that is cheaper than telling those apart that look alike in several views."""
    for view, h in enumerate(hashes):
        a = _first_hashes(h, size)
        p = _places(a, bits)
        yield view, a, np.flatnonzero((known[p >> 3] >> (p & 7).astype(np.uint8)) & 1)


def _short_lines(text: str, canon: Canon, sizes: set[int]):
    """(line number, hashes of its words) of the lines that have as many words as a short item."""
    for no, line in enumerate(text.split("\n")):
        n = len([t for t in _TOKEN.findall(line) if t not in ".!?"])
        if n in sizes:
            yield no, np.concatenate([h[_LITERAL] for h, *_ in canon.views(line, 0)])


def _doc_windows(sizes: list[int], bitmap, bits: int):
    """Windows of documents whose hash the bit map knows, and whole lines (negative sizes) likewise."""
    lines, sizes = {-s for s in sizes if s < 0}, [s for s in sizes if s > 0]

    def run(batches):
        canon, known = Canon(), np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch in batches:
            rows = []
            keys, ids, texts = batch.column("key").to_pylist(), batch.column("id").to_pylist(), batch.column("text")
            for r, key in enumerate(keys):
                text = texts[r].as_py()
                if lines:
                    for no, h in _short_lines(text, canon, lines):
                        a, b = window_hashes(h, len(h))
                        p = _places(a, bits)
                        if known[p[0] >> 3] >> (p[0] & 7) & 1:
                            rows.append((key, ids[r], _LITERAL, no, -len(h), 0, _signed(a[0]), _signed(b[0]), []))
                for hashes, slots, words, place in canon.views(text, max(sizes, default=1) - 1):
                    for size in sizes:
                        if len(words) < size:
                            continue
                        for view, a, hits in _view_hits(hashes, size, known, bits):
                            if place > 0:  # shorter windows inside the shared tokens were seen with the block before
                                hits = hits[hits >= max(sizes) - size]
                            if not len(hits):
                                continue
                            slot = slots[view]
                            for i, b in zip(hits.tolist(), _second_hashes(hashes[view], size, hits)):
                                values = [words[j] for j in range(i, i + size) if slot[j]]
                                rows.append((key, ids[r], view, place + i, size, 0, _signed(a[i]), _signed(b), values))
                    if len(rows) > 20_000:
                        yield _batch(rows)
                        rows = []
            if rows:
                yield _batch(rows)

    return run


def _bitmap(bits: int):
    def run(batches):
        out = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for batch in batches:
            p = _places(np.asarray(batch.column("h1")).view(np.uint64), bits)
            np.bitwise_or.at(out, p >> 3, (1 << (p & 7)).astype(np.uint8))
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(out[at], pa.int32())], names=["at", "byte"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE,
          consistency: float = CONSISTENCY, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per (document row, benchmark row) that leaks: _rid, doc_id, item_id, matched, windows,
    coverage, verbatim (false: other values in the slots).

    Null texts count as empty and never match. An item of fewer than ``min_words`` words (a common phrase inside
    a text is no evidence) leaks where it is a whole line, as written but for case and punctuation. Null or repeated ids are told apart by their rows; rows repeated in a
    table give repeated results. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    text = lambda df: F.coalesce(column(df, "text", "string"), F.lit("")).alias("text")
    items = stage(with_row_id(benchmark, "key").select("key", column(benchmark, "item_id", "long").alias("id"), text(benchmark))
                  .mapInArrow(_item_windows(window, min_words), _OUT), "item-windows")
    stats = items.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``window`` rows
    empty = "_rid long, doc_id long, item_id long, matched long, windows int, coverage double, verbatim boolean"
    if not stats:
        return spark.createDataFrame([], empty)
    bits = min(MAP_BITS, max(24, (sum(r.n for r in stats) * 64).bit_length()))
    cells = items.select("h1").mapInArrow(_bitmap(bits), "at long, byte int").groupBy("at").agg(F.bit_or("byte").cast("int").alias("byte"))
    known = np.zeros(1 << (bits - 3), dtype=np.uint8)  # 16 MB at most
    cells = cells.toArrow()
    known[np.asarray(cells.column("at").combine_chunks())] = np.asarray(cells.column("byte").combine_chunks())
    bitmap = spark.sparkContext.broadcast(known.tobytes())

    found = stage(with_row_id(docs, "key").select("key", column(docs, "doc_id", "long").alias("id"), text(docs))
                  .mapInArrow(_doc_windows(sorted(r.size for r in stats), bitmap, bits), _OUT), "document-windows")
    i = items.select(F.col("key").alias("item"), F.col("id").alias("item_id"), F.col("pos").alias("ipos"),
                     F.col("total").alias("windows"), "view", "size", "h1", "h2", F.col("slots").alias("islots"))
    pairs = found.select(F.col("key").alias("_rid"), F.col("id").alias("doc_id"), "view", "pos", "size", "h1", "h2", "slots") \
        .join(i, ["view", "size", "h1", "h2"]).withColumn("shift", F.col("pos") - F.col("ipos"))
    who = ["_rid", "item", "view", "shift"]
    # one row per matched window and slot; windows without slots keep one row
    slots = pairs.select("_rid", "doc_id", "item", "item_id", "view", "windows", "shift", "ipos",
                         F.explode_outer(F.arrays_zip(F.col("islots").alias("a"), F.col("slots").alias("b"))).alias("s"))
    values = (slots.filter("s IS NOT NULL").groupBy(*who, F.col("s.a").alias("a"))
              .agg(F.min("s.b").alias("lo"), F.max("s.b").alias("hi"))
              .groupBy(*who).agg(F.avg((F.col("lo") == F.col("hi")).cast("double")).alias("even"),
                                 F.min((F.col("lo") == F.col("a")) & (F.col("hi") == F.col("a"))).alias("verbatim")))
    places = slots.select(*who, "doc_id", "item_id", "windows", "ipos").distinct()
    lines = places.join(values, who, "left").filter(F.coalesce("even", F.lit(1.0)) >= consistency)
    per = (lines.groupBy("_rid", "doc_id", "item", "item_id", "view", "windows")
           .agg(F.countDistinct("ipos").alias("matched"), F.min(F.coalesce("verbatim", F.lit(True))).alias("verbatim"))
           .withColumn("coverage", F.col("matched") / F.col("windows")).filter(F.col("coverage") >= coverage))
    # the view that covers most tells the figures
    best = per.groupBy("_rid", "doc_id", "item", "item_id").agg(
        F.max(F.struct("coverage", "matched", "windows")).alias("b"), F.max("verbatim").alias("verbatim"))
    return best.select("_rid", "doc_id", "item_id", "b.matched", "b.windows", "b.coverage", "verbatim")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows into which an item leaks; columns as given."""
    docs = settled(docs)
    gone = leaks(docs, benchmark, **settings).select("_rid").distinct()
    return without_rows(docs, gone)
