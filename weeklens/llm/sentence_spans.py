"""Substring deduplication over sliding sentence spans.

A text is cut into sentences, and these once more after words chosen by their
hash (one in sixteen): such cuts depend on the words alone, so a passage that
starts or ends inside a sentence is cut like its other copies. From every piece
("sentence" from here) on, the shortest run of at least ``sentences`` sentences and
``words`` words is a span. All spans of all documents are hashed and joined;
the first occurrence of a span (by doc_id, then place) stays, and sentences
that any other occurrence covers are removed (``remove_repeats``).

Cuts of two copies need not align near the ends of a passage that starts and
ends anywhere. ``remove_passages`` therefore hashes runs of ``words`` words
chosen by window minimum as well: of all runs that start within a window of
``passage - words + 1`` words, the one with the least hash. Any two copies of
``passage`` words share a whole window and thus a chosen run. Every match is
extended word by word to both sides, as far as ``passage - words`` words a
side agree with those around the first occurrence; beyond those, the next
chosen run takes over.

Two passes keep the shuffles small. The first counts 64 bit span hashes only
and leaves a bit map of the repeated ones (its size is a bounded parameter; a
fuller map only lets more rows through). The second emits the spans the map
knows, with longer hashes and places, finds each one's first occurrence by a
grouped minimum and joins it back. A passage that sits in a third of all
documents is one row per task in the minimum and is split by the join.

``remove_passages`` cuts every text once: its runs are written as one row per
document, and the second pass reads those. No run carries the words around it.
Matches with the same document that follow each other at the same distance
become one stretch, which can grow at its two ends only; the words at the ends
are fetched once per place of a first occurrence, and each text's own words
are at hand when it is cleaned.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import column, only_rows, settled, split_rows, stage, with_row_id

SENTENCES = 2
WORDS = 20
PASSAGE = 50
LONG = 40
MAP_BITS = 28

_TOKEN = re.compile(r"\S+\s*")
_SPACES = re.compile(r"\s+")
_BLOCK = 1 << 20
_KNOWN = 500_000
_ROWS = 20_000
_FEW = 1 << 16
_M1, _M2 = 0x5851F42D4C957F2D, 0xD1342543DE82EF95


_CODE = np.dtype([("hash", "<u8"), ("size", "<i4")])


class _Words(dict):
    """Per token (a word and the space behind it), as the bytes of a ``_CODE``: its hash, and in the lowest bit whether
    a piece ends here: at the end of a sentence or line, or behind one word in sixteen by its hash; and its length."""

    def __missing__(self, token: str) -> bytes:
        if len(self) > _KNOWN:
            self.clear()
        word = token.rstrip()
        h = xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "replace"))
        ends = word[-1:] in ".!?" or "\n" in token[len(word):] or h >> 60 == 0
        self[token] = out = (h & ~1 | ends).to_bytes(8, "little") + len(token).to_bytes(4, "little")
        return out


def _powers(m: int, n: int) -> np.ndarray:
    return _few_powers(m)[:n] if n <= _FEW else _all_powers(m, n)


@lru_cache(8)
def _few_powers(m: int) -> np.ndarray:
    return _all_powers(m, _FEW)


@lru_cache(8)
def _inverse(m: int) -> int:
    return pow(m, -1, 1 << 64)


def _all_powers(m: int, n: int) -> np.ndarray:
    out = np.full(n, m, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)  # modulo 2^64


def _slide(pick, x: np.ndarray, size: int) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) of every ``size`` following items."""
    width = 1
    while width * 2 <= size:
        x = pick(x[:-width], x[width:])
        width *= 2
    return pick(x[:len(x) - (size - width)], x[size - width:]) if width < size else x


class Pieces:
    """The pieces of a text as arrays: ``chars`` and ``words`` hold where each ends; ``hashes`` the words',
    ``word_chars`` where each word (with the space behind it) ends.
    The text is taken a mebibyte at a time; what stays of a word is 20 bytes."""

    def __init__(self, text: str, known: _Words):
        coded, sizes, at = [], [], 0
        lead = _SPACES.match(text)
        start = at = lead.end() if lead else 0
        while at < len(text):
            hit = _SPACES.search(text, at + _BLOCK) if at + _BLOCK < len(text) else None
            end = hit.end() if hit else len(text)
            tokens = _TOKEN.findall(text, at, end)
            codes = np.frombuffer(b"".join(map(known.__getitem__, tokens)), dtype=_CODE)
            coded.append(np.ascontiguousarray(codes["hash"]))
            sizes.append(np.ascontiguousarray(codes["size"]))
            at = end
        self.hashes = np.concatenate(coded) if coded else np.zeros(0, np.uint64)
        n = len(self.hashes)
        ends = (self.hashes & np.uint64(1)).astype(bool)
        if n:
            ends[-1] = True
        at_word = np.flatnonzero(ends) + 1
        first = np.concatenate([[0], at_word[:-1]])
        for i in np.flatnonzero(at_word - first > LONG).tolist():  # no end in sight: cut every LONG words
            ends[first[i] + LONG - 1:at_word[i]:LONG] = True
        self.words = np.flatnonzero(ends) + 1
        chars = np.cumsum(np.concatenate(sizes), dtype=np.int64) if sizes else np.zeros(0, np.int64)
        self.word_chars = chars + start
        self.chars = self.word_chars[self.words - 1] if n else chars

    def _run_hashes(self, m: int):
        """Function from starts and ends (words) of runs to their hashes."""
        # prefix sums of h_i m^i; a run's share, shifted back to its start, depends on its words alone
        back = _powers(_inverse(m), len(self.hashes) + 1)
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
            (self.hashes | np.uint64(1)) * _powers(m, len(self.hashes)), dtype=np.uint64)])

        def of(a, b):
            h = (run[b] - run[a]) * back[a] + (b - a).astype(np.uint64)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
            return h ^ (h >> np.uint64(29))

        return of

    def _span_ends(self, sentences: int, words: int):
        k = len(self.words)
        first = np.concatenate([[0], self.words[:-1]]) if k else np.zeros(0, np.int64)
        last = np.maximum(np.searchsorted(self.words, first + words) + 1, np.arange(k) + sentences)
        whole = np.flatnonzero(last <= k)
        return whole, last[whole], first[whole], self.words[last[whole] - 1]

    def runs(self, sentences: int, words: int, passage: int):
        """(start, end, hash) of the spans and of the runs chosen by window minimum, by start."""
        _, _, a, b = self._span_ends(sentences, words)
        of, n, window = self._run_hashes(_M1), len(self.hashes), passage - words + 1
        h = of(a, b)
        if n >= passage:
            at = np.arange(n - words + 1)
            each = of(at, at + words)
            least, edge = _slide(np.minimum, each, window), np.zeros(window - 1, np.uint64)
            chosen = np.flatnonzero(_slide(np.maximum, np.concatenate([edge, least, edge]), window) == each)
            chosen = chosen[~np.isin(chosen, a[b - a == words])]  # not those that are spans anyway
            a, b, h = (np.concatenate(c) for c in ((a, chosen), (b, chosen + words), (h, each[chosen])))
            order = np.argsort(a, kind="stable")
            a, b, h = a[order], b[order], h[order]
        return a, b, h

    def second(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._run_hashes(_M2)(a, b)

    def near(self, reach: int):
        """Function from places and a side to 32 bits of the hashes of the ``reach`` words before (side -1) or from
        (side 1) each place on, the nearest first; zero beyond the text."""
        edge = np.zeros(reach, np.uint32)
        held = np.concatenate([edge, (self.hashes >> np.uint64(32)).astype(np.uint32), edge])
        step = np.arange(reach)

        def of(places, side):
            at = places[:, None] + (reach + step if side > 0 else reach - 1 - step)
            return held[np.minimum(at, len(held) - 1)]

        return of

    def spans(self, sentences: int, words: int):
        """(first piece, pieces, hash, second hash) of every span, as arrays."""
        whole, last, a, b = self._span_ends(sentences, words)
        return whole, last - whole, self._run_hashes(_M1)(a, b), self._run_hashes(_M2)(a, b)


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _hash_task(sentences: int, words: int):
    def run(batches):
        known = _Words()
        for batch in batches:
            held = [Pieces(t.as_py(), known).spans(sentences, words)[2] for t in batch.column("text")]
            yield from _hash_batches(np.concatenate(held) if held else np.zeros(0, np.uint64))

    return run


def _hash_batches(h: np.ndarray, step: int = 200_000):
    for i in range(0, len(h), step):
        yield pa.RecordBatch.from_arrays([pa.array(h[i:i + step].view(np.int64), pa.int64())], names=["h"])


def _bitmap_task(bits: int):
    def run(batches):
        known = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for batch in batches:
            p = _places(np.asarray(batch.column("h")).view(np.uint64), bits)
            np.bitwise_or.at(known, p >> 3, (1 << (p & 7)).astype(np.uint8))
        at = np.flatnonzero(known)
        for i in range(0, len(at), 100_000):
            part = at[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(known[part], pa.int32())],
                                             names=["at", "byte"])

    return run


def _span_task(sentences: int, words: int, bitmap, bits: int):
    names = ["_rid", "doc_id", "pos", "n", "h1", "h2"]

    def run(batches):
        repeated, known = np.frombuffer(bitmap.value, dtype=np.uint8), _Words()
        for batch in batches:
            held = []
            for row, text in enumerate(batch.column("text")):
                pos, n, h1, h2 = Pieces(text.as_py(), known).spans(sentences, words)
                p = _places(h1, bits)
                hit = np.flatnonzero((repeated[p >> 3] >> (p & 7).astype(np.uint8)) & 1)
                if len(hit):
                    held.append((np.full(len(hit), row), pos[hit], n[hit], h1[hit], h2[hit]))
            if held:
                row, pos, n, h1, h2 = (np.concatenate(c) for c in zip(*held))
                row = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_rid").take(row), batch.column("doc_id").take(row), pa.array(pos, pa.int32()),
                     pa.array(n, pa.int32()), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], names=names)

    return run


def _cut_task(sentences: int, words: int, passage: int):
    """One row per text: its runs' steps (from the start of the run before), sizes and hashes, as bytes."""
    kind = _step_type(sentences, words, passage)

    def run(batches):
        known = _Words()
        for batch in batches:
            held, size, first = [], 0, 0
            for row, text in enumerate(batch.column("text")):
                pieces = Pieces(text.as_py(), known)
                a, b, h1 = pieces.runs(sentences, words, passage)
                h2 = (pieces.second(a, b) >> np.uint64(32)).astype(np.uint32)
                held.append([np.ascontiguousarray(c).tobytes() for c in (np.diff(a, prepend=0).astype(kind), (b - a).astype(kind), h1, h2)])
                size += len(a)
                if size >= _ROWS * 10 or row == batch.num_rows - 1:
                    part = batch.slice(first, len(held))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_rid"), part.column("doc_id"), *(pa.array(c, pa.binary()) for c in zip(*held))],
                        names=["_rid", "doc_id", "steps", "sizes", "h1", "h2"])
                    held, size, first = [], 0, row + 1

    return run


def _step_type(sentences: int, words: int, passage: int):
    # runs start at most ``passage`` words apart; a span ends with the piece that makes it large enough
    return np.uint16 if max(passage, words + LONG, (sentences + 1) * LONG) < 1 << 16 else np.uint32


def _joined(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _shares(batches, runs: int = _ROWS * 10):
    """Batches of whole texts that hold about ``runs`` runs, and each text's number of runs."""
    for batch in batches:
        counts = np.asarray(pc.binary_length(batch.column("h1"))).astype(np.int64) // 8
        share = np.cumsum(counts) // runs
        cuts = [0, *(np.flatnonzero(share[1:] != share[:-1]) + 1).tolist(), len(counts)]
        for low, high in zip(cuts, cuts[1:]):
            if counts[low:high].any():
                yield batch.slice(low, high - low), counts[low:high]


def _cut_hashes(batches):
    for batch, _ in _shares(batches):
        yield from _hash_batches(_joined(batch.column("h1"), np.uint64))


def _run_task(sentences: int, words: int, passage: int, bitmap, bits: int):
    """The runs the bit map knows; ``told``: whether matches of this run are extended."""
    names, kind = ["_rid", "doc_id", "a", "b", "h1", "h2", "told"], _step_type(sentences, words, passage)

    def run(batches):
        repeated = np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch, counts in _shares(batches):
            h1, h2 = _joined(batch.column("h1"), np.uint64), _joined(batch.column("h2"), np.uint32)
            row = np.repeat(np.arange(len(counts)), counts)
            a = np.cumsum(_joined(batch.column("steps"), kind), dtype=np.int64)
            begun = np.concatenate([[0], a])[np.cumsum(counts) - counts]  # what the texts before add up to
            a -= begun[row]
            n = _joined(batch.column("sizes"), kind).astype(np.int64)
            p = _places(h1, bits)
            hit = np.flatnonzero((repeated[p >> 3] >> (p & 7).astype(np.uint8)) & 1)
            row, a, n, h1, h2 = row[hit], a[hit], n[hit], h1[hit], h2[hit]
            # longer runs that meet a short one leave the extension to it
            short, at = n == words, (row << 40) + a
            starts = at[short]
            last = np.searchsorted(starts, at + n) - 1
            told = short | (last < 0)
            if len(starts):
                told |= starts[np.maximum(last, 0)] <= at - words
            for i in range(0, len(hit), _ROWS):
                c = slice(i, i + _ROWS)
                of = pa.array(row[c], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_rid").take(of), batch.column("doc_id").take(of), pa.array(a[c], pa.int32()),
                     pa.array((a + n)[c], pa.int32()), pa.array(h1[c].view(np.int64)), pa.array(h2[c].view(np.int32)),
                     pa.array(told[c])], names=names)

    return run


#: What a mark says: words a to b go; words before, or from a on go while they agree with ``near``, ``reach`` of them at
#: most; a to b repeats the words from ``reach`` on of the same text, and is extended (_OWN) or not (_OWN_BARE).
_GONE, _BEFORE, _BEHIND, _OWN, _OWN_BARE = range(5)
_MARKS = "_rid long, kind byte, a int, b int, reach int, first_rid long, place int, first_doc long"


def _stretch_task(reach: int):
    """Marks of matches that come sorted by document, first document, distance and start.

    Matches of other documents that meet at one distance become one stretch. An extended one reaches ``reach`` words
    beyond its own ends, so the ends of a stretch reach as far as the furthest of its extended matches.
    """
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rid, first, doc = (batch.column(c) for c in ("_rid", "first_rid", "first_doc"))
            r, f, a, b, fa = (np.asarray(batch.column(c)).astype(np.int64) for c in ("_rid", "first_rid", "a", "b", "first_a"))
            told = np.asarray(batch.column("told").cast(pa.int8())).astype(bool)
            parts = []

            def add(at, kind, x, y, far, place=None):
                n, at = len(at), pa.array(at, pa.int64())
                ends = place is not None
                parts.append(pa.RecordBatch.from_arrays(
                    [rid.take(at), pa.array(np.broadcast_to(kind, n).astype(np.int8)), pa.array(x, pa.int32()), pa.array(y, pa.int32()),
                     pa.array(far, pa.int32()), first.take(at) if ends else pa.nulls(n, pa.int64()),
                     pa.array(place, pa.int32()) if ends else pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()) if ends else doc.take(at)],
                    names=["_rid", "kind", "a", "b", "reach", "first_rid", "place", "first_doc"]))

            own = np.flatnonzero(r == f)
            if len(own):
                add(own, np.where(told[own], _OWN, _OWN_BARE), a[own], b[own], fa[own])
            other = np.flatnonzero(r != f)
            if len(other):
                r, f, a, b, d, told = r[other], f[other], a[other], b[other], (a - fa)[other], told[other]
                new = np.ones(len(r), dtype=bool)
                new[1:] = (r[1:] != r[:-1]) | (f[1:] != f[:-1]) | (d[1:] != d[:-1])
                shift = np.cumsum(new) << 32
                so_far = np.maximum.accumulate(shift + b) - shift
                new[1:] |= a[1:] > so_far[:-1]
                at = np.flatnonzero(new)
                start, end, d = a[at], so_far[np.append(at[1:], len(a)) - 1], d[at]
                left = reach - (np.minimum.reduceat(np.where(told, a, 1 << 40), at) - start)
                right = reach - (end - np.maximum.reduceat(np.where(told, b, -1 << 40), at))
                add(other[at], _GONE, start, end, np.zeros(len(at)))
                for kind, x, far in ((_BEFORE, start, left), (_BEHIND, end, right)):
                    k = np.flatnonzero(far > 0)
                    add(other[at[k]], kind, x[k], x[k], far[k], (x - d)[k])
            yield from parts

    return run


def _near_task(reach: int):
    """The words at the places that matches of other documents ask for."""
    def run(batches):
        known = _Words()
        for batch in batches:
            for rid, text, asked in zip(*(batch.column(c) for c in ("_rid", "text", "asked"))):
                near = Pieces(text.as_py(), known).near(reach)
                kind, place = (np.asarray(asked.values.field(c)) for c in ("kind", "place"))
                for side, k in ((-1, _BEFORE), (1, _BEHIND)):
                    at = place[kind == k].astype(np.int64)
                    for i in range(0, len(at), _ROWS):
                        c = at[i:i + _ROWS]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([rid.as_py()] * len(c), pa.int64()), pa.array(np.full(len(c), k, np.int8)),
                             pa.array(c, pa.int32()), _blobs(near(c, side))], names=["first_rid", "kind", "place", "near"])

    return run


def _blobs(rows: np.ndarray) -> pa.Array:
    ends = (np.arange(len(rows) + 1) * rows.shape[1] * rows.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _agreed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per row, how many items agree from the first on."""
    return np.logical_and.accumulate(x == y, axis=1).sum(axis=1)


def _extended(pieces: Pieces, marks, reach: int):
    """Starts and ends (which may lie beyond the text) of the words that one text's marks remove."""
    kind, a, b, far = (np.asarray(marks.field(c)).astype(np.int64) for c in ("kind", "a", "b", "reach"))
    near, words, start, end = pieces.near(reach), marks.field("near"), a.copy(), b.copy()
    for side, k in ((-1, _BEFORE), (1, _BEHIND)):
        ends = np.flatnonzero(kind == k)
        for i in range(0, len(ends), _ROWS):
            c = ends[i:i + _ROWS]
            theirs = _joined(words.take(pa.array(c)), np.uint32).reshape(-1, reach)
            n = np.minimum(_agreed(near(a[c], side), theirs), far[c])
            if side < 0:
                start[c] -= n
            else:
                end[c] += n
    own = np.flatnonzero(kind == _OWN)
    for i in range(0, len(own), _ROWS):
        c = own[i:i + _ROWS]
        start[c] -= _agreed(near(a[c], -1), near(far[c], -1))
        end[c] += _agreed(near(b[c], 1), near(far[c] + b[c] - a[c], 1))
    # a match that overlaps its first occurrence starts behind it, so that this one stays whole
    start = np.maximum(np.maximum(start, 0), np.where(kind >= _OWN, far + b - a, 0))
    return start, np.maximum(end, start)


def _repeated_bitmap(hashes: DataFrame, map_bits: int):
    """Broadcast bit map of the hashes that occur more than once, and its bits."""
    spark = hashes.sparkSession
    again = stage(hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "repeated-hashes", tidy=True)
    bits = min(map_bits, max(16, (again.count() * 16).bit_length()))
    cells = (again.mapInArrow(_bitmap_task(bits), "at long, byte int").groupBy("at")
             .agg(F.bit_or("byte").cast("int").alias("byte")))
    known = np.zeros(1 << (bits - 3), dtype=np.uint8)  # 2^(map_bits - 3) bytes at most, whatever the corpus
    for r in _in_parts(cells, 1 << (bits - 3)):
        known[r[0]] = r[1]
    return spark.sparkContext.broadcast(known.tobytes()), bits


def repeated_runs(rows: DataFrame, sentences: int = SENTENCES, words: int = WORDS, passage: int = PASSAGE,
                  map_bits: int = MAP_BITS) -> DataFrame:
    """Marks (``_MARKS``) of the occurrences of runs that are not their first one, written. ``rows`` hold _rid, doc_id
    and text; the words that ``_BEFORE`` and ``_BEHIND`` are held against lie at ``place`` of the row ``first_rid``."""
    cut = stage(rows.mapInArrow(_cut_task(sentences, words, passage),
                                "_rid long, doc_id long, steps binary, sizes binary, h1 binary, h2 binary"), "cut-runs", tidy=True)
    bitmap, bits = _repeated_bitmap(cut.select("h1").mapInArrow(_cut_hashes, "h long"), map_bits)
    found = stage(cut.mapInArrow(_run_task(sentences, words, passage, bitmap, bits),
                                 "_rid long, doc_id long, a int, b int, h1 long, h2 int, told boolean"), "runs", tidy=True)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_rid", "a", "told")
    first = stage(found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("rows"), F.min(order).alias("first"))
                  .filter("rows > 1").select("h1", "h2", "first.doc_id", "first._rid", "first.a", "first.told")
                  .toDF("h1", "h2", "first_doc", "first_rid", "first_a", "first_told"), "first-runs", tidy=True)
    matches = (found.drop("doc_id").join(first.hint("shuffle_hash"), ["h1", "h2"])
               .filter((F.col("first_rid") != F.col("_rid")) | (F.col("first_a") != F.col("a")))
               .select("_rid", "a", "b", "first_rid", "first_a", "first_doc", (F.col("told") & F.col("first_told")).alias("told")))
    return stage(matches.repartition("_rid").sortWithinPartitions("_rid", "first_rid", F.col("a") - F.col("first_a"), "a")
                 .mapInArrow(_stretch_task(passage - words), _MARKS), "marks", tidy=True)


def _with_near(marks: DataFrame, rows: DataFrame, reach: int) -> DataFrame:
    """``marks`` with the words that the ends of stretches are held against."""
    ends = F.col("kind").isin(_BEFORE, _BEHIND)
    places = (marks.filter(ends).select("first_rid", "kind", "place").distinct()
              .groupBy("first_rid").agg(F.collect_list(F.struct("kind", "place")).alias("asked")))  # one text's places
    asked = stage(places.withColumnRenamed("first_rid", "_rid"), "asked", tidy=True)
    near = stage(only_rows(rows.select("_rid", "text"), "_rid", asked).join(asked, "_rid")
                 .mapInArrow(_near_task(reach), "first_rid long, kind byte, place int, near binary"), "near", tidy=True)
    told = ["_rid", "kind", "a", "b", "reach", "first_doc", "near"]
    return (marks.filter(ends).join(near.hint("shuffle_hash"), ["first_rid", "kind", "place"]).select(*told)
            .unionByName(marks.filter(~ends).withColumn("near", F.lit(None).cast("binary")).select(*told)))


def repeated_spans(docs: DataFrame, sentences: int = SENTENCES, words: int = WORDS, map_bits: int = MAP_BITS) -> DataFrame:
    """(_rid, doc_id, pos, n, first_doc): occurrences of spans that are not their first one."""
    rows = with_row_id(docs).select("_rid", column(docs, "doc_id", "long").alias("doc_id"),
                                    F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    bitmap, bits = _repeated_bitmap(rows.select("text").mapInArrow(_hash_task(sentences, words), "h long"), map_bits)
    found = stage(rows.mapInArrow(_span_task(sentences, words, bitmap, bits),
                                  "_rid long, doc_id long, pos int, n int, h1 long, h2 long"), "spans")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_rid", "pos")
    # written, so that the join deals out both sides anew and can split a span that very many documents hold
    first = stage(found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("rows"), F.min(order).alias("first"))
                  .filter("rows > 1").drop("rows"), "first-spans")
    return (found.join(first, ["h1", "h2"])
            .filter((F.col("first._rid") != F.col("_rid")) | (F.col("first.pos") != F.col("pos")))
            .select("_rid", "doc_id", "pos", "n", F.col("first.doc_id").alias("first_doc")))


def _in_parts(cells: DataFrame, size: int, step: int = 1 << 20):
    """Arrays (at, byte) of a sparse bit map, a bounded part at a time."""
    cells = stage(cells, "bitmap", tidy=True)
    for low in range(0, size, step):
        t = cells.filter((F.col("at") >= low) & (F.col("at") < low + step)).toArrow() if size > step else cells.toArrow()
        yield np.asarray(t.column("at").combine_chunks()), np.asarray(t.column("byte").combine_chunks()).astype(np.uint8)


def _clean_task(reach: int | None = None):
    """Texts without the pieces that their marks hold; with ``reach`` without the words (``_extended``)."""
    def run(batches):
        known = _Words()
        for batch in batches:
            out = {"text": [], "n_sentences": [], "n_removed": [], "removed": []}
            for text, marks in zip(batch.column("text"), batch.column("marks")):
                if not marks.is_valid or not len(marks):
                    for c, v in zip(out, (text.as_py(), 0, 0, [])):
                        out[c].append(v)
                    continue
                text, marks = text.as_py(), marks.values
                pieces = Pieces(text, known)
                if reach is None:
                    ends, start = pieces.chars, np.asarray(marks.field("pos")).astype(np.int64)
                    end = start + np.asarray(marks.field("n"))
                else:
                    ends, (start, end) = pieces.word_chars, _extended(pieces, marks, reach)
                drop = np.zeros(len(ends) + 1, dtype=np.int64)
                np.add.at(drop, np.minimum(start, len(ends)), 1)
                np.add.at(drop, np.minimum(end, len(ends)), -1)
                gone = np.cumsum(drop)[:len(ends)] > 0
                touched = gone
                if reach is not None:
                    touched = np.add.reduceat(gone, np.concatenate([[0], pieces.words[:-1]])) > 0
                # the text in stretches of words that stay and words that go
                turns = np.append(np.flatnonzero(gone[1:] != gone[:-1]), len(ends) - 1)
                kept, removed, at = [], [], 0
                for end, dead in zip(ends[turns].tolist(), gone[turns].tolist()):
                    if dead:
                        removed.append({"start": at, "end": end})
                    else:
                        kept.append(text[at:end])
                    at = end
                for c, v in zip(out, ("".join(kept), len(touched), int(touched.sum()), removed)):
                    out[c].append(v)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_rid"), batch.column("doc_id"), pa.array(out["text"], pa.string()),
                 pa.array(out["n_removed"], pa.int64()), pa.array(out["removed"], span), batch.column("first_docs")],
                names=["_rid", "doc_id", "text", "n_removed", "removed", "first_docs"])

    return run


def remove_repeats(docs: DataFrame, sentences: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: _rid, doc_id, text (without the removed sentences), n_removed, removed
    (start and end of each removed piece in code points), first_docs (where they occur first, sorted).

    Texts without removals come back unchanged (null as empty). Of repeated rows the first of the scan
    keeps its text; null doc_ids come after all others. Texts shorter than a span are never touched. An
    empty table gives an empty result.
    """
    docs = settled(docs)
    marks = (repeated_spans(docs, sentences, words).groupBy("_rid")  # one document's spans
             .agg(F.collect_list(F.struct("pos", "n")).alias("marks"),
                  F.sort_array(F.collect_set("first_doc")).alias("first_docs")))
    rows = with_row_id(docs).select("_rid", column(docs, "doc_id", "long").alias("doc_id"),
                                    F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    joined = rows.join(marks.hint("shuffle_hash"), "_rid", "left")
    return joined.mapInArrow(
        _clean_task(), "_rid long, doc_id long, text string, n_removed long, "
        "removed array<struct<start:long,end:long>>, first_docs array<long>")


def remove_passages(docs: DataFrame, sentences: int = SENTENCES, words: int = WORDS, passage: int = PASSAGE) -> DataFrame:
    """As ``remove_repeats``, to the word: besides repeated spans, every later copy of a passage of ``passage``
    words goes wherever it starts and ends, and all matches go with the words around them that repeat too.

    n_removed counts the sentences that lose words, removed holds the ranges of the removed words. Of a run
    that an earlier document holds in other company, only what agrees with its first occurrence goes.
    """
    docs = settled(docs)
    rows = with_row_id(docs).select("_rid", column(docs, "doc_id", "long").alias("doc_id"),
                                    F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    found = repeated_runs(rows, sentences, words, passage)
    marks = (_with_near(found, rows, passage - words).groupBy("_rid")  # one document's matches
             .agg(F.collect_list(F.struct("kind", "a", "b", "reach", "near")).alias("marks"),
                  F.sort_array(F.collect_set("first_doc")).alias("first_docs")))
    marked, rest = split_rows(rows, "_rid", found)
    clean = "_rid long, doc_id long, text string, n_removed long, removed array<struct<start:long,end:long>>, first_docs array<long>"
    joined = marked.join(marks.hint("shuffle_hash"), "_rid", "left").mapInArrow(_clean_task(passage - words), clean)
    if rest is None:
        return joined
    none = {"n_removed": F.lit(0).cast("long"), "removed": F.array().cast("array<struct<start:long,end:long>>"),
            "first_docs": F.lit(None).cast("array<long>")}
    return joined.unionByName(rest.withColumns(none))
