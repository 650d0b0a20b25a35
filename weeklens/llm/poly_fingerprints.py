"""Exact deduplication by composable polynomial fingerprints.

A text's UTF-8 bytes b_0 .. b_(n-1) have the fingerprint
H = sum((b_i + 1) * B^(n-1-i)) mod P, taken for two primes P with one base B
each. For a text cut into chunks, H(xy) = H(x) * B^len(y) + H(y): every chunk
is hashed on its own and multiplied by the power that belongs to the number of
bytes behind it, and the sum of these terms is the fingerprint. Texts longer
than ``chunk_bytes`` are cut into chunk rows in the JVM, dealt over all tasks,
hashed there and combined by a grouped sum; no task ever holds more than a
chunk of a huge text in Python.

Equal fingerprints are only candidates. Their texts are compared chunk by chunk
in one grouped pass (smallest chunk = largest chunk at every place, partial
aggregates first, so a group of any size streams through); a group that fails,
that is a collision, is split exactly by the digest of its texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import column, only_rows, settled, stage, with_row_id, without_rows

# Two primes below 2^31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)

CHUNK_BYTES = 1 << 20


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod prime by doubling."""
    out = np.ones(max(1, n), dtype=np.uint64)
    have = 1
    step = base % prime
    while have < n:
        take = min(have, n - have)
        out[have:have + take] = out[:take] * np.uint64(step) % np.uint64(prime)
        step = step * step % prime
        have += take
    return out


def chunk_hash(data, prime: int, powers: np.ndarray) -> int:
    """Fingerprint of one byte chunk (at most 2^24 bytes, so sums stay below 2^63)."""
    n = len(data)
    if n == 0:
        return 0
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    return int(np.dot(b, powers[:n][::-1]) % np.uint64(prime))


def combine(left: tuple[int, int], right: tuple[int, int], prime: int, base: int) -> tuple[int, int]:
    """(hash, length) of the text xy from those of x and y."""
    return (left[0] * pow(base, right[1], prime) + right[0]) % prime, left[1] + right[1]


def _hash_rows(passed: list[str], chunk_bytes: int):
    """Arrow task: (passed columns, data, behind) -> (passed columns, h1, h2), each hash
    already shifted by the ``behind`` bytes that follow the chunk."""

    def run(batches):
        powers = [_powers(b, p, chunk_bytes + 4) for b, p in zip(BASES, PRIMES)]
        for batch in batches:
            data, behind = batch.column("data"), batch.column("behind").to_pylist()
            offsets = np.frombuffer(data.buffers()[1], dtype=np.int32)[data.offset:data.offset + len(data) + 1]
            raw = data.buffers()[2]
            view = memoryview(raw) if raw is not None else memoryview(b"")
            hashes = [[], []]
            for i, after in enumerate(behind):
                piece = view[offsets[i]:offsets[i + 1]]
                for k in (0, 1):
                    h = chunk_hash(piece, PRIMES[k], powers[k])
                    hashes[k].append(h * pow(BASES[k], after, PRIMES[k]) % PRIMES[k] if after else h)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in passed] + [pa.array(h, pa.int64()) for h in hashes],
                names=[*passed, "h1", "h2"])

    return run


def _chunks(df: DataFrame, data: str, chunk_bytes: int) -> DataFrame:
    """One row per chunk of binary column ``data``: idx, data, behind."""
    last = F.greatest(((F.octet_length(data) + chunk_bytes - 1) / chunk_bytes).cast("int"), F.lit(1)) - 1
    cut = F.transform(F.sequence(F.lit(0), last),
                      lambda i: F.substring(F.col(data), i * chunk_bytes + 1, F.lit(chunk_bytes)))
    rest = [c for c in df.columns if c != data]
    # the array is made from the text once; only its items go on, not the text
    return (df.select(*rest, F.octet_length(data).alias("_n"), F.posexplode(cut).alias("idx", data))
            .withColumn("behind", F.greatest(F.col("_n") - (F.col("idx") + 1) * F.lit(chunk_bytes).cast("long"),
                                             F.lit(0)).cast("long")).drop("_n"))


def fingerprints(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, text: str = "text") -> DataFrame:
    """Rows (_rid, doc_id, text_sha256, n_bytes, h1, h2), one per row of ``docs``.

    Null text counts as empty (length 0, hashes 0). Null or repeated doc_id and
    extra columns do no harm: rows are told apart by their place in the scan.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = with_row_id(docs).select(
        "_rid", column(docs, "doc_id", "long").alias("doc_id"), F.sha2(body, 256).alias("text_sha256"),
        F.octet_length(body).cast("long").alias("n_bytes"), F.encode(body, "UTF-8").alias("data"))
    keep = ["_rid", "doc_id", "text_sha256", "n_bytes"]
    schema = "_rid long, doc_id long, text_sha256 string, n_bytes long, h1 long, h2 long"
    task = _hash_rows(keep, chunk_bytes)
    small = (base.filter(F.col("n_bytes") <= chunk_bytes).withColumn("behind", F.lit(0).cast("long"))
             .mapInArrow(task, schema))
    huge = (_chunks(base.filter(F.col("n_bytes") > chunk_bytes), "data", chunk_bytes)
            .select(*keep, "idx", "behind", "data").repartition("_rid", "idx").mapInArrow(task, schema)
            .groupBy(*keep).agg((F.sum("h1") % PRIMES[0]).alias("h1"), (F.sum("h2") % PRIMES[1]).alias("h2")))
    return small.unionByName(huge)


def _confirm(docs: DataFrame, fp: DataFrame, classes: DataFrame, chunk_bytes: int, text: str) -> DataFrame:
    """Fingerprints of candidate classes whose texts are not all the same (collisions)."""
    key = ["n_bytes", "h1", "h2"]
    members = fp.select("_rid", *key).join(classes.filter("rows > 1").select(*key), key)
    texts = with_row_id(docs).select(F.col("_rid").alias("_tid"),
                                     F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8").alias("data"))
    # only the candidates' texts leave their scan
    members = stage(members, "candidates")
    texts = only_rows(texts, "_tid", members)
    pairs = texts.join(members.hint("shuffle_hash"), F.col("_tid") == F.col("_rid"))
    return (_chunks(pairs, "data", chunk_bytes).groupBy(*key, "idx")
            .agg(F.min("data").alias("lo"), F.max("data").alias("hi"))
            .filter(F.col("lo") != F.col("hi")).select(*key).distinct())


def exact_duplicates(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: _rid, doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; of rows that tie in it
    (repeated rows), the one that comes last in the scan. Null doc_ids rank
    lowest. Null text equals empty text. An empty table gives an empty result.
    """
    docs = settled(docs)
    fp = stage(fingerprints(docs, chunk_bytes, text), "fingerprints")
    key = ["n_bytes", "h1", "h2"]

    def classed(part: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
        # a struct of two numbers: hash aggregation with partial results, so a hot class is small
        last = part.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                                     F.max(F.struct("doc_id", "_rid")).alias("last"))
        return part, last

    _, classes = classed(fp, key)
    classes = stage(classes, "classes")
    bad = stage(_confirm(docs, fp, classes, chunk_bytes, text), "collisions")
    good = fp.join(classes, key).join(bad, key, "left_anti")
    split = fp.join(bad, key)
    _, by_digest = classed(split, [*key, "text_sha256"])
    both = good.unionByName(split.join(by_digest, [*key, "text_sha256"]), allowMissingColumns=False) \
        if not bad.isEmpty() else good
    return both.select("_rid", "doc_id", F.col("last.doc_id").alias("keep_id"),
                       F.col("rows").alias("group_size"),
                       (F.col("last._rid") == F.col("_rid")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` does not keep; columns as given."""
    docs = settled(docs)
    gone = exact_duplicates(docs, chunk_bytes).filter(~F.col("kept")).select("_rid")
    return without_rows(docs, gone)
