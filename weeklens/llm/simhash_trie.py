"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are the leaves of a binary trie. Two nodes of one depth are
visited together with the number of bits in which their prefixes differ; the
pair is dropped as soon as that number exceeds the error budget, and otherwise
gives its children pairs.

Budget. k errors spread over three blocks of the 64 bits leave some block with
at most k // 3. So three tries are walked, each over the fingerprint rotated to
put another block first, with the small budget inside that block and the whole
budget k behind it. Every pair within k bits is found in at least one trie, and
far fewer node pairs are alive at any depth than with budget k from the root.

Distribution. The first ``depth`` levels (chosen from the count of distinct
fingerprints, so that a node holds a few thousand) are walked by Spark: each
fingerprint is sent to the node pairs its prefix belongs to, and each pair of
nodes is walked on inside one task over arrays of 8 byte numbers. Equal
fingerprints are one leaf, so exact copies cost nothing however many.

No group is expanded into all its pairs. Tasks keep a union-find forest of the
links found so far; a node pair whose leaves already hang together is dropped,
and only forest edges leave the task. They are joined to components by
large-star / small-star rounds, written to the shared folder each time.
"""

from __future__ import annotations

import math
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import column, settled, stage, with_row_id, without_rows

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCKS = (21, 21, 22)
NODE_LEAVES = 2048
_TEXT_BLOCK = 1 << 20
_FRONTIER = 100_000
_LEAF_PAIRS = 32


# ---------------------------------------------------------------- fingerprints

def _word_blocks(data: bytes):
    """Lists of words, about a mebibyte of text at a time."""
    space = re.compile(rb"[\x20\t-\r]")
    at = 0
    while at < len(data):
        hit = space.search(data, at + _TEXT_BLOCK) if at + _TEXT_BLOCK < len(data) else None
        end = hit.start() if hit else len(data)
        yield data[at:end].split()
        at = end


def simhash(text: str, words: int = SHINGLE_WORDS) -> int:
    """64 bit fingerprint: a bit is set if it is set in over half of the shingle hashes."""
    digest = xxhash.xxh64_intdigest
    votes, shingles, carry = np.zeros(64, dtype=np.int64), 0, []
    total, first = 0, []
    for block in _word_blocks(text.encode("utf-8").lower()):  # bytes.lower() changes A-Z only
        total += len(block)
        if len(first) < words:
            first = (first + block)[:words]
        run = carry + block
        carry = run[max(0, len(run) - words + 1):]
        if len(run) < words:
            continue
        joined = b" ".join(run)
        ends = np.cumsum([len(w) + 1 for w in run])
        lo = [0, *ends[:len(run) - words].tolist()]
        hi = (ends[words - 1:] - 1).tolist()
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(lo, hi)], dtype="<u8")
        for i in range(0, len(h), 65_536):
            votes += np.unpackbits(h[i:i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
                .sum(axis=0, dtype=np.int64)
        shingles += len(h)
    if total == 0:
        return 0
    if total < words:
        return digest(b" ".join(first), SEED)
    return int(np.packbits(2 * votes > shingles, bitorder="little").view("<u8")[0])


def _fingerprint_task(words: int):
    def run(batches):
        for batch in batches:
            fps = [simhash(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_rid"), batch.column("doc_id"),
                 pa.array(np.array(fps, dtype=np.uint64).view(np.int64), pa.int64())], names=["_rid", "doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """_rid, doc_id, fp (signed 64 bits) per row; null text counts as empty (fp 0)."""
    rows = with_row_id(docs).select("_rid", column(docs, "doc_id", "long").alias("doc_id"),
                                    F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_fingerprint_task(words), "_rid long, doc_id long, fp long")


# ------------------------------------------------------------- trie self-join

def _joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Component labels (least index) after adding the links x-y to a forest of stars."""
    a, b = label[x], label[y]
    while True:
        m = np.minimum(a, b)
        np.minimum.at(label, a, m)
        np.minimum.at(label, b, m)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped
        a, b = label[a], label[b]
        if (a == b).all():
            return label


def _neighbour_links(v: np.ndarray, label: np.ndarray, max_bits: int) -> np.ndarray:
    """Links between close places of the sorted orders of eight rotations. All are true links; they only
    make the forest of a dense group early, so that its node pairs are dropped high up."""
    for turn in range(0, 64, 8):
        r = (v << np.uint64(turn)) | (v >> np.uint64(64 - turn)) if turn else v
        order = np.argsort(r, kind="stable")
        for step in (1, 2, 3):
            x, y = order[:-step], order[step:]
            near = np.bitwise_count(v[x] ^ v[y]) <= max_bits
            if near.any():
                _joined(label, x[near], y[near])
    return label


def _walk(v: np.ndarray, parts: tuple[int, int] | None, depth: int, first_bits: int, first_budget: int,
          max_bits: int) -> np.ndarray:
    """Component labels of the sorted distinct fingerprints ``v`` (already rotated).

    ``parts``: None to join a node with itself; (size of the first node, bits in which the prefixes
    differ) to join the two nodes that ``v`` holds one behind the other.
    """
    n = len(v)
    label = _neighbour_links(v, np.arange(n), max_bits) if n > 1 else np.arange(n)

    def changes():
        return np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])

    one = lambda x: np.array([x], dtype=np.int64)
    if parts is None:
        blocks = [(depth, one(0), one(n), one(0), one(n), one(0))]
    else:
        blocks = [(depth, one(0), one(parts[0]), one(parts[0]), one(n), one(parts[1]))]
    change = changes()
    while blocks:
        d, alo, ahi, blo, bhi, err = blocks.pop()
        hang = ((change[ahi - 1] == change[alo]) & (change[bhi - 1] == change[blo]) & (label[alo] == label[blo]))
        if hang.any():
            alo, ahi, blo, bhi, err = (z[~hang] for z in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        same = alo == blo
        pairs = (ahi - alo) * (bhi - blo)
        leaf = (pairs <= _LEAF_PAIRS) | (d >= 64)
        if leaf.any():
            lo, width, count = alo[leaf], (bhi - blo)[leaf], pairs[leaf]
            which = np.repeat(np.arange(len(lo)), count)
            at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            x = lo[which] + at // width[which]
            y = blo[leaf][which] + at % width[which]
            near = np.flatnonzero((np.bitwise_count(v[x] ^ v[y]) <= max_bits) & (label[x] != label[y]))
            if len(near):
                _joined(label, x[near], y[near])
                change = changes()
            inner = ~leaf
            alo, ahi, blo, bhi, err, same = (z[inner] for z in (alo, ahi, blo, bhi, err, same))
            if not len(alo):
                continue
        bit = np.uint64(1 << (63 - d))
        head = ~np.uint64((1 << (64 - d)) - 1) if d else np.uint64(0)
        amid = np.clip(np.searchsorted(v, (v[alo] & head) | bit), alo, ahi)
        bmid = np.clip(np.searchsorted(v, (v[blo] & head) | bit), blo, bhi)
        apart = ~same
        kids = [(alo, amid, blo, bmid, err, None), (amid, ahi, bmid, bhi, err, None),
                (alo, amid, bmid, bhi, err + 1, None), (amid, ahi, blo, bmid, err + 1, apart)]
        budget = first_budget if d + 1 <= first_bits else max_bits
        got = []
        for a0, a1, b0, b1, e, only in kids:
            ok = (a1 > a0) & (b1 > b0) & (e <= budget)
            if only is not None:
                ok &= only
            got.append(tuple(z[ok] for z in (a0, a1, b0, b1, e)))
        cols = [np.concatenate([g[i] for g in got]) for i in range(5)]
        # the pairs with fewer errors come first, and off the stack first
        cuts = list(range(0, len(cols[0]), _FRONTIER))
        for c in reversed(cuts):
            blocks.append((d + 1, *(z[c:c + _FRONTIER] for z in cols)))
    return label


def _rotate(v: np.ndarray, turn: int) -> np.ndarray:
    return v if turn == 0 else (v << np.uint64(turn)) | (v >> np.uint64(64 - turn))


def _group_task(depth: int, max_bits: int):
    first_budget = max_bits // len(BLOCKS)

    def run(key, table):
        trie, low, high = (k.as_py() for k in key)
        turn = sum(BLOCKS[:trie])
        fps = np.asarray(table.column("fp").combine_chunks()).view(np.uint64)
        v = np.sort(_rotate(fps, turn))
        parts = None
        if low != high:
            first = int(np.searchsorted(v, np.uint64(high << (64 - depth))))
            parts = (first, (low ^ high).bit_count())
            if first in (0, len(v)):
                v = v[:0]
        label = _walk(v, parts, depth, BLOCKS[trie], first_budget, max_bits) if len(v) > 1 else np.arange(len(v))
        child = np.flatnonzero(label != np.arange(len(v)))
        back = (64 - turn) % 64
        x, y = _rotate(v[child], back).view(np.int64), _rotate(v[label[child]], back).view(np.int64)
        return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})

    return run


def trie_links(distinct: DataFrame, count: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Forest edges (x, y) over the distinct fingerprints (column fp, signed): x and y hang together by
    links of at most ``max_bits`` bits, and all such links are covered."""
    depth = min(min(BLOCKS), max(6, math.ceil(math.log2(max(1, count) / NODE_LEAVES))))
    flips = [0] + [sum(1 << b for b in bits) for n in range(1, max_bits // len(BLOCKS) + 1)
                   for bits in combinations(range(depth), n)]
    sent = None
    for trie in range(len(BLOCKS)):
        turn = sum(BLOCKS[:trie])
        r = F.col("fp") if not turn else F.shiftleft("fp", turn).bitwiseOR(F.shiftrightunsigned("fp", 64 - turn))
        prefix = F.shiftrightunsigned(r, 64 - depth)
        other = prefix.bitwiseXOR(F.col("flip"))
        part = (distinct.withColumn("flip", F.explode(F.array(*[F.lit(x).cast("long") for x in flips])))
                .select(F.lit(trie).alias("trie"), F.least(prefix, other).alias("low"),
                        F.greatest(prefix, other).alias("high"), "fp"))
        sent = part if sent is None else sent.unionByName(part)
    return sent.groupBy("trie", "low", "high").applyInArrow(_group_task(depth, max_bits), "x long, y long").distinct()


# ----------------------------------------------------------------- components

def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): root is the least node of the component; only nodes with an edge appear.

    Large-star and small-star rounds: each gives every edge of a node to the node's least neighbour. A
    node's neighbours are never gathered, only their minimum; a hub's edges are split by the join.
    """
    # least node on the right
    e = stage(edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
              .filter("u <> v").distinct(), name)
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        e = stage(small, name)
        # a sum of hashes tells whether a round changed anything
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now


def _classes(docs: DataFrame, words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Staged fingerprints per row, and per distinct fingerprint its component's smallest doc_id and first row."""
    rows = stage(fingerprints(docs, words), "simhash")
    distinct = stage(rows.groupBy("fp").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_rid")).alias("first")),
        "simhash-distinct")
    found = components(trie_links(distinct.select("fp"), distinct.count(), max_bits), "simhash-links")
    rooted = (distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    best = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("first"))
    # written, so that the join with the rows can split a fingerprint that very many rows share
    return rows, stage(rooted.select("fp", "root").join(best, "root").drop("root"), "simhash-classes")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: _rid, doc_id, fingerprint (16 hex digits), component_id, kept.

    component_id is the smallest doc_id reachable over links of at most ``max_bits`` differing bits
    (null doc_ids are passed over; null if there is no other). Empty and null texts have fingerprint
    zero and link like any other. ``kept`` marks one row per component: the smallest doc_id, and of
    repeated rows the first of the scan. An empty table gives an empty result.
    """
    rows, classes = _classes(docs, words, max_bits)
    return rows.join(classes, "fp").select(
        "_rid", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("first._rid") == F.col("_rid")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component; columns as given."""
    docs = settled(docs)
    gone = near_duplicates(docs, words, max_bits).filter(~F.col("kept")).select("_rid")
    return without_rows(docs, gone)
