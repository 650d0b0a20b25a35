"""Runs of repeated words: every maximal periodic stretch of every text.

A run is a maximal stretch of words with smallest period q that is at least
``repeats`` periods and ``least`` words long. Texts are worked on where they
lie, whole, without a shuffle; the texts of a batch are laid behind each other
with a separator of its own behind each, so no run crosses a border and the
array work is shared.

Multi-scale minimizers. At the scale of k words, which is in charge of periods
from above 2k/3 to k, the hashes of all k-word windows are taken, and of any
``w`` neighbouring ones the least. Inside a run of such a period q the windows
at i and i + q hold the same words, so their minima lie q apart; a run of three
periods is long enough for that to happen at least once (w + q <= 3q - k + 1).
As k >= q, equal k-word windows inside the run are never closer than q, so
equal minimizers that follow each other at a distance in the scale's range seed
all its runs. A seed is extended word by word, in slices, to both sides at its
lag; what reaches the length is a run. Periods too short for a scale are found
by comparing the words at each lag directly. The hash only proposes seeds: all
runs come from comparing words.

A stretch with period d that has a smaller period too is reported once, with
the smallest (which divides d, as the stretch is three times as long as d).
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import column

LEAST = 24
REPEATS = 3
CHUNK_WORDS = 400_000

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_MIX1, _MIX2, _MULT = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x5851F42D4C957F2D


class _Ids(dict):
    """Number of each word, given out as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def _scatter(ids: np.ndarray) -> np.ndarray:
    """A 64 bit hash of each number (splitmix64, a bijection)."""
    z = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * _MIX1
    z = (z ^ (z >> np.uint64(27))) * _MIX2
    return z ^ (z >> np.uint64(31))


def _slide(pick, x: np.ndarray, size: int) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) of every ``size`` following items."""
    width = 1
    while width * 2 <= size:
        x = pick(x[:-width], x[width:])
        width *= 2
    return pick(x[:len(x) - (size - width)], x[size - width:]) if width < size else x


def scales(least: int, repeats: int, longest: int):
    """(k, w, smallest period) per scale, up to periods of ``longest`` // ``repeats`` words."""
    low = max(1, least // repeats)
    while (low + 1) * repeats <= longest:
        k = max(low + 1, low * 3 // 2)
        yield k, max(1, (repeats - 1) * (low + 1) - k + 1), low + 1
        low = k


def _minimizers(x: np.ndarray, powers: np.ndarray, back: np.ndarray, k: int, w: int):
    """Places and hashes of the k-word windows that are least among some ``w`` neighbouring ones."""
    n = len(x) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * powers[:len(x)], dtype=np.uint64)])
    h = (total[k:] - total[:-k]) * back[:n]
    h = (h ^ (h >> np.uint64(32))) * _MIX1
    h ^= h >> np.uint64(29)
    if n <= w:
        return np.arange(n), h
    least, edge = _slide(np.minimum, h, w), np.zeros(w - 1, np.uint64)
    at = np.flatnonzero(_slide(np.maximum, np.concatenate([edge, least, edge]), w) == h)
    return at, h[at]


def _agree(ids: np.ndarray, i: int, j: int) -> int:
    """How many words from i on equal those from j on (i < j)."""
    n, got, step = len(ids) - j, 0, 64
    while got < n:
        size = min(step, n - got)
        same = ids[i + got:i + got + size] == ids[j + got:j + got + size]
        if not same.all():
            return got + int(same.argmin())
        got += size
        step *= 2
    return got


def _agree_before(ids: np.ndarray, i: int, j: int) -> int:
    """How many words before i equal those before j (i < j)."""
    got, step = 0, 64
    while got < i:
        size = min(step, i - got)
        same = (ids[i - got - size:i - got] == ids[j - got - size:j - got])[::-1]
        if not same.all():
            return got + int(same.argmin())
        got += size
        step *= 2
    return got


def _lag_scan(ids: np.ndarray, lag: int, length: int):
    """(start, length) of the maximal stretches of at least ``length`` words that repeat at ``lag``."""
    if len(ids) < max(length, lag + 1):
        return
    same = np.concatenate([[False], ids[lag:] == ids[:-lag], [False]])
    turns = np.flatnonzero(same[1:] != same[:-1])
    starts, ends = turns[::2], turns[1::2] + lag
    long = ends - starts >= length
    yield from zip(starts[long].tolist(), (ends - starts)[long].tolist())


def find_runs(ids: np.ndarray, least: int = LEAST, repeats: int = REPEATS, lengths=None) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a sequence of word numbers, by start, then period.

    ``ids`` may be several sequences behind each other, each ended by a number that occurs nowhere else;
    ``lengths`` are then their lengths without it, which must not rise: later scales look at the long ones only.
    """
    lengths = np.array([len(ids)] if lengths is None else lengths, dtype=np.int64)
    ends = np.cumsum(lengths + 1)
    found: list[tuple[int, int, int]] = []
    short = max(1, least // repeats)
    for lag in range(1, short + 1):
        found += [(s, size, lag) for s, size in _lag_scan(ids, lag, max(least, repeats * lag))]
    x = powers = back = None
    for k, w, low in scales(least, repeats, int(lengths.max(initial=0))):
        held = int(np.searchsorted(-lengths, -low * repeats, side="right"))
        end = min(len(ids), int(ends[held - 1]))
        if x is None:
            x = _scatter(ids[:end])
            powers, back = (np.full(end + 1, m, np.uint64) for m in (_MULT, pow(_MULT, -1, 1 << 64)))
            powers[0] = back[0] = 1
            powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
        part = ids[:end]
        at, h = _minimizers(x[:end], powers, back, k, w)
        order = np.argsort(h, kind="stable")
        at, h = at[order], h[order]
        lag = at[1:] - at[:-1]
        seed = np.flatnonzero((h[1:] == h[:-1]) & (lag >= low) & (lag <= k))
        lag, at = lag[seed], at[seed]
        order = np.lexsort((at, lag))
        reached = (0, 0)  # lag, and where its last stretch ended
        for d, p in zip(lag[order].tolist(), at[order].tolist()):
            if reached[0] == d and p + d < reached[1]:
                continue
            start = p - _agree_before(part, p, p + d)
            stop = p + d + _agree(part, p, p + d)
            reached = (d, stop)
            if stop - start >= max(least, repeats * d):
                found.append((start, stop - start, d))
    smallest: dict[tuple[int, int], int] = {}
    for start, size, d in found:
        smallest[start, size] = min(d, smallest.get((start, size), d))
    return sorted((s, n, d) for (s, n), d in smallest.items())


def _task(least: int, repeats: int, prepare):
    def chunk(docs: list[list[bytes]]):
        """Runs of each text of a chunk, found together."""
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        known = _Ids()
        lengths = np.array([len(docs[i]) for i in order], dtype=np.int64)
        words = np.fromiter(map(known.__getitem__, chain.from_iterable(docs[i] for i in order)), dtype=np.int64,
                            count=int(lengths.sum()))
        starts = np.cumsum(lengths + 1) - lengths - 1
        ids = np.empty(len(words) + len(docs), dtype=np.int64)
        border = np.zeros(len(ids), bool)
        border[starts + lengths] = True
        ids[~border] = words
        ids[border] = len(known) + np.arange(len(docs))
        out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
        runs = find_runs(ids, least, repeats, lengths)
        if runs:
            owner = np.searchsorted(starts, [r[0] for r in runs], side="right") - 1
            for (s, n, d), j in zip(runs, owner.tolist()):
                out[order[j]].append((s - int(starts[j]), n, d))
        return out

    def collapse(words: list[bytes], runs) -> bytes:
        if not runs:
            return b" ".join(words)
        step = np.zeros(len(words) + 1, dtype=np.int64)
        for s, n, d in runs:
            step[s + d] += 1
            step[s + n] -= 1
        kept = np.cumsum(step)[:-1] == 0
        return b" ".join([w for w, k in zip(words, kept.tolist()) if k])

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.binary())
            first = 0
            while first < batch.num_rows:
                docs, size, row = [], 0, first
                while row < batch.num_rows and size < CHUNK_WORDS:
                    words = texts[row].as_py().split()
                    if prepare is not None:
                        words = prepare(ids[row].as_py(), words)
                    docs.append(words)
                    size += len(words)
                    row += 1
                runs = chunk(docs)
                plain = [collapse(w, r) for w, r in zip(docs, runs)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, row - first), pa.array([len(w) for w in docs], pa.int64()),
                     pa.array([[{"start": s, "length": n, "period": d} for s, n, d in r] for r in runs], pa.list_(_RUN)),
                     pa.array(plain, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
                first = row

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS, prepare=None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start, length, period, by start, then
    period; counted in words from 0) and collapsed: the text's words joined by one space, without the words
    that any run holds behind its first period.

    Words are what stands between ASCII white space. A null text is empty: no words, no runs, an empty
    ``collapsed``. Null or repeated ids are ordinary rows, every row is worked on by itself. Other columns are
    not looked at. An empty table gives an empty result. ``prepare`` may map (doc_id, words as UTF-8 bytes) to
    the words to work on. ``repeats`` must be at least 3: the seeds rely on it.
    """
    if repeats < 3:
        raise ValueError("runs of fewer than three periods have no certain seed")
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"),
                       F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_task(least, repeats, prepare), "doc_id long, n_words long, "
                           "runs array<struct<start:long,length:long,period:long>>, collapsed string")
