"""Mixture-controlled packing: deficit round robin over source queues.

Every source is a queue of tokens. A window of ``window_tokens`` takes from
each queue its quantum (target share x window size); the fraction of a token
that a quantum leaves over is the queue's deficit and is carried to the next
window. Written with fixed-point quanta k (2^-16 tokens), a queue has given
floor(w * k / 2^16) tokens after w windows, so the deficits need no state that
walks from window to window or from partition to partition: the place of any
token follows from its position in its queue. Sequences are the consecutive
``seq_len`` tokens of the joined windows; only the last one is padded.

When a queue runs dry the shares of the others grow in proportion. That gives
at most two schedule phases per queue, computed on the driver from one total
per queue (the queue count is checked against ``max_queues``).

Texts are read and tokenized once; their ids are staged in the shared folder.
A queue's order is (partition, place in the partition) of that stage, so the
only shuffle is one sum per (queue, partition). A queue that holds any share
of all rows is spread over all tasks.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weeklens.llm.common import column, stage

SHIFT = 16
END_ID = 1
SHORT = 64  # code points of a text whose ids a worker remembers
CACHE_WORDS = 50_000  # a worker's table of short texts: about 13 MB
BATCH_ROWS = 500  # rows whose ids or pieces a task holds beside its input
# The added tokens of the vocabulary file: found inside texts too, as the tokenizer does.
ADDED = {"<|endoftext|>": 50256}

# White space as the vocabulary's own split pattern has it
# (Unicode White_Space), and that pattern.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBpe:
    """Byte-level BPE ids of whole texts as little-endian uint16 bytes.

    A text is given to the tokenizer in one call: most runs of real text are new to a worker, so that remembering
    them costs more than it saves. Only the ids of short texts are remembered (a bounded table). ``added`` tokens
    are cut out first.
    """

    def __init__(self, ranks_file: bytes, added: dict[str, int] | None = None):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        self.encoder = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}
        self.added = {t: array("H", [i]).tobytes() for t, i in (added or {}).items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.parts = re.compile(f"({'|'.join(map(re.escape, longest))})").split

    def __call__(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            # every second part is an added token
            return b"".join([self.added[p] if i % 2 else self._plain(p) for i, p in enumerate(self.parts(text))])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if len(text) > SHORT:
            return self._ids(text)
        if text not in self.known:
            if len(self.known) > CACHE_WORDS:
                self.known.clear()
            self.known[text] = self._ids(text)
        return self.known[text]

    def _ids(self, text: str) -> bytes:
        return self.encoder.encode_to_numpy(text, disallowed_special=()).astype("<u2").tobytes()


def _sliced(batches):
    """The rows of ``batches``, at most ``BATCH_ROWS`` at a time, so that what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _tokenize(ranks, end_id: int, added: dict[str, int]):
    def run(batches):
        bpe = ByteBpe(ranks.value, added)
        end = array("H", [end_id]).tobytes()
        part = TaskContext.get().partitionId()
        given: dict[str, int] = {}
        for batch in _sliced(batches):
            queues = batch.column("queue").to_pylist()
            texts = batch.column("text")
            ids, starts, sizes = [], [], []
            for i, queue in enumerate(queues):
                row = bpe(texts[i].as_py()) + end
                start = given.get(queue, 0)
                ids.append(row)
                starts.append(start)
                sizes.append(len(row) // 2)
                given[queue] = start + len(row) // 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("queue"), pa.array([part] * len(ids), pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "queue", "part", "part_start", "doc_tokens", "ids"])

    return run


def schedule(totals: list[int], weights: list[float], window_tokens: int) -> list[dict]:
    """Phases of the round robin: stream start, window count, and per queue its start and quantum k."""
    left = list(totals)
    taken = [0] * len(totals)
    stream, window, phases = 0, 0, []

    def add(n: int, k: list[int]):
        nonlocal stream, window
        phases.append({"stream": stream, "window": window, "n": n, "start": list(taken), "k": k})
        window += n
        for s, q in enumerate(k):
            gave = (n * q) >> SHIFT
            taken[s] += gave
            left[s] -= gave
            stream += gave

    while any(left):
        whole = sum(w for w, r in zip(weights, left) if r)
        k = [max(1, round(window_tokens * (w / whole) * (1 << SHIFT))) if r else 0 for w, r in zip(weights, left)]
        n = min((r << SHIFT) // q for r, q in zip(left, k) if r)
        if n:
            add(n, k)
        if any(left):
            # queues that hold less than a quantum end in this window, the others give theirs
            add(1, [min(r, (q >> SHIFT) + 1) << SHIFT for r, q in zip(left, k)])
    return phases


class _Placer:
    """Pieces of a queue interval: (start in the interval, length, stream place, window)."""

    def __init__(self, phases):
        self.k = [np.array(p["k"], dtype=np.int64) for p in phases]
        self.starts = np.array([p["start"] for p in phases], dtype=np.int64)
        self.stream = [p["stream"] for p in phases]
        self.window = [p["window"] for p in phases]
        self.n = [p["n"] for p in phases]

    def pieces(self, s: int, at: int, size: int):
        end, x = at + size, at
        own = self.starts[:, s]
        p = int(np.searchsorted(own, x, side="right")) - 1
        while x < end:
            while True:  # the phase that gives token x: the last one starting at or before it that is not empty
                k = int(self.k[p][s])
                y = x - int(own[p])
                if k and y < (self.n[p] * k) >> SHIFT:
                    break
                p += 1 if k == 0 or y >= (self.n[p] * k) >> SHIFT else 0
            w = (((y + 1) << SHIFT) - 1) // k
            stop = min(end, int(own[p]) + (((w + 1) * k) >> SHIFT))
            quanta = self.k[p]
            place = (self.stream[p] + y + int((((w + 1) * quanta[:s]) >> SHIFT).sum())
                     + int(((w * quanta[s + 1:]) >> SHIFT).sum()))
            yield x - at, stop - x, place, self.window[p] + w
            x = stop


def _place(plan, seq_len: int, with_ids: bool):
    def run(batches):
        phases, index = plan.value
        placer = _Placer(phases)
        for batch in _sliced(batches):
            out = {c: [] for c in ("doc_id", "queue", "start", "length", "ids_crc32", "doc_tokens",
                                   "sequence_id", "offset", "window_id", "ids")}
            ids_col = batch.column("ids")
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "queue", "part_start", "queue_before",
                                                               "doc_tokens")))
            for i, (doc, queue, part_start, before, size) in enumerate(rows):
                ids = np.frombuffer(ids_col[i].as_buffer(), dtype="<u2")
                for start, length, place, window in placer.pieces(index[queue], part_start + before, size):
                    while length:
                        offset = place % seq_len
                        n = min(length, seq_len - offset)
                        data = ids[start:start + n].astype("<u4").tobytes()
                        for c, v in (("doc_id", doc), ("queue", queue), ("start", start), ("length", n),
                                     ("ids_crc32", zlib.crc32(data)), ("doc_tokens", size),
                                     ("sequence_id", place // seq_len), ("offset", offset), ("window_id", window),
                                     ("ids", data if with_ids else None)):
                            out[c].append(v)
                        start, place, length = start + n, place + n, length - n
            types = {"queue": pa.string(), "ids": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(c, pa.int64())) for c, v in out.items()],
                                             names=list(out))

    return run


def pack(docs: DataFrame, ranks_path: str, targets: dict[str | None, float] | None = None, seq_len: int = 2048,
         window_tokens: int = 1 << 17, source: str = "source", end_id: int = END_ID, max_queues: int = 65_536,
         with_ids: bool = False, added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece of a document: doc_id, source, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, window_id (and ids as little-endian uint32, if asked for).

    ``targets`` gives each source its share (any positive numbers); without it the
    corpus's own proportions hold, and every window has them. With it, every
    source that occurs must be named. A null source is a queue of its own, a
    missing source column is one null source. Null text counts as empty (just the end
    id). Null or repeated doc_ids are packed row by row. ``ranks_path`` is a
    vocabulary file with one base64 token and rank per line and at most 65,536 ranks;
    it is read on the driver. ``added`` are the vocabulary's added tokens (``ADDED`` unless given), which get
    their own ids wherever a text holds them. An empty table gives no piece.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())  # a vocabulary file: bounded by the 65,536 ranks
    name = column(docs, source, "string")
    queued = docs.select(column(docs, "doc_id", "long").alias("doc_id"),
                         F.when(name.isNull(), "-").otherwise(F.concat(F.lit("+"), name)).alias("queue"),
                         F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    tokens = stage(queued.mapInArrow(
        _tokenize(ranks, end_id, ADDED if added is None else added), "doc_id long, queue string, part int, part_start long, doc_tokens long, ids binary"),
        "token-ids")
    by_part = tokens.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("tokens"))
    # a row per task that tokenized, whatever share of the rows the queue holds
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a short table, written so that the engine knows its size and need not deal the ids out again
    offsets = stage(by_part.select("queue", "part",
                                   F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("queue_before")), "offsets")
    sums = by_part.groupBy("queue").agg(F.sum("tokens").alias("tokens")).limit(max_queues + 1).collect()
    if len(sums) > max_queues:
        raise ValueError(f"more than {max_queues} sources; map them to fewer classes first (column {source!r})")
    sums = sorted((r.queue, r.tokens) for r in sums)
    names = [None if q == "-" else q[1:] for q, _ in sums]
    if targets is None:
        weights = [float(n) for _, n in sums]
    else:
        unnamed = [n for n in names if not targets.get(n, 0) > 0]
        if unnamed:
            raise ValueError(f"no target share for sources {unnamed[:5]}")
        weights = [float(targets[n]) for n in names]
    phases = schedule([n for _, n in sums], weights, window_tokens)
    plan = spark.sparkContext.broadcast((phases, {q: i for i, (q, _) in enumerate(sums)}))
    pieces = tokens.join(offsets, ["queue", "part"]).mapInArrow(
        _place(plan, seq_len, with_ids),
        "doc_id long, queue string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, window_id long, ids binary")
    pieces = pieces.withColumn("source", F.when(F.col("queue") != "-", F.substring("queue", 2, 1 << 30)))
    return pieces.drop("queue") if with_ids else pieces.drop("queue", "ids")
