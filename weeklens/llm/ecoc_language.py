"""Language identification by error-correcting output codes.

Every language has a codeword of bits (+1, -1). Per bit, one binary classifier
over hashed character n-grams tells the languages with +1 from those with -1;
a text gets the language whose codeword its bits come nearest to.

Learning takes two passes over all learnable rows, none of which gathers more
than a table bounded by ``buckets`` x languages:

1. n-gram counts per language, summed inside each task before they are shuffled,
   so a language or source that holds most rows is a few rows per task. A bit's
   weight of an n-gram is the log of its mean probability in the languages on
   the one side over that on the other (smoothed), so a rare language weighs as
   much as a common one inside its side.
2. Margins (mean weight over a text's n-grams) of the same rows. Per bit they
   give the scale that turns a margin into log odds (two normal distributions
   of equal spread, ``APART`` deviations apart at most), and per language and bit the share of rows whose sign is
   right.

Decoding is loss-weighted: language l costs the sum over bits b of
M[l, b] * log(1 + exp(-code[l, b] * odds[b])), where M[l, b] is the share of
l's rows that bit b got right, in proportion to the language's other bits, so
that bits which cannot tell a language say little about it. The cheapest
language wins; if the next one costs less than ``ambiguity`` more (by default: is
more than half as likely), the row is flagged as ambiguous. The score is the softmax of the negative costs.

Up to ``EXHAUSTIVE`` languages the code holds every way to part them in two
(2^(L-1) - 1 bits: any two codewords differ in 2^(L-2)); beyond it, a seeded
draw of 10 log2 L bits, the one of several with the largest least distance.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import column, stage

BUCKETS = 1 << 16
ORDERS = 4
EXHAUSTIVE = 6
DRAWS = 50
SMOOTHING = 0.5
AMBIGUITY = math.log(2)
APART = 6.0  # standard deviations between a bit's sides at most
CAP = 20.0  # of log odds: one bit alone decides nothing
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_PIECE = 1 << 17
_MULTS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], dtype=np.uint32)


class Grams:
    """Buckets of the character n-grams of 1 to ``orders`` letters: lower case, all that is no letter one space."""

    def __init__(self, buckets: int, orders: int):
        if not 1 <= orders <= len(_MULTS) or buckets & (buckets - 1):
            raise ValueError("orders must be 1 to 4 and buckets a power of two")
        self.shift, self.orders = np.uint32(32 - (buckets.bit_length() - 1)), orders
        chars = [chr(i) for i in range(0x110000)]
        self.letter = np.array([c.isalpha() for c in chars])
        self.lower = np.arange(0x110000, dtype=np.uint32)
        for i, c in enumerate(chars):
            low = c.lower()
            if low != c and len(low) == 1:
                self.lower[i] = ord(low)
        self.lower[~self.letter] = 32

    def __call__(self, text: str):
        """Arrays of buckets, a bounded piece of the text at a time; pieces share the letters that n-grams span."""
        for at in range(0, len(text), _PIECE):
            part = text[max(0, at - self.orders + 1):at + _PIECE]
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            held = self.letter[codes]
            kept = held.copy()
            kept[1:] |= held[:-1]  # of several that are no letters, the first
            codes = self.lower[codes[kept]]
            if at == 0:
                codes = np.concatenate([np.array([32], np.uint32), codes])
            h, out = np.zeros(len(codes), np.uint32), []
            for n in range(self.orders):
                if len(codes) <= n:
                    break
                h = (h[:len(codes) - n] + codes[n:]) * _MULTS[n]
                h ^= h >> np.uint32(15)
                out.append((h * np.uint32(0x2C1B3C6D)) >> self.shift)
            if out:
                yield np.concatenate(out)


def codebook(languages: int, seed: int = 0) -> np.ndarray:
    """Codewords (languages x bits, +1 and -1), no bit the same for all languages."""
    if languages < 2:
        return np.ones((languages, 0), dtype=np.int8)
    if languages <= EXHAUSTIVE:
        bits = [b for b in itertools.product((1, -1), repeat=languages - 1) if -1 in b]
        return np.array([(1, *b) for b in bits], dtype=np.int8).T
    rng, best = np.random.default_rng(seed), (-1, None)
    for _ in range(DRAWS):
        code = rng.choice(np.array([1, -1], np.int8), (languages, math.ceil(10 * math.log2(languages))))
        code = code[:, np.abs(code.sum(axis=0, dtype=np.int64)) < languages]
        apart = (code.shape[1] - code.astype(np.int64) @ code.T) // 2
        least = int(apart[~np.eye(languages, dtype=bool)].min())
        if least > best[0]:
            best = least, code
    return best[1]


def margins(grams: Grams, weights: np.ndarray, text: str) -> np.ndarray:
    """Mean weight over the text's n-grams, per bit."""
    total, n = np.zeros(weights.shape[1]), 0
    for g in grams(text):
        # a product with ones sums rows much faster than sum() does; a piece of text bounds its length
        total += np.ones(len(g), np.float32) @ weights.take(g.astype(np.intp), axis=0, mode="clip")
        n += len(g)
    return total / max(1, n)


def decode(odds: np.ndarray, code: np.ndarray, trust: np.ndarray) -> np.ndarray:
    """Cost of each language (rows x languages) for log odds (rows x bits)."""
    z = np.clip(odds, -CAP, CAP)[:, None, :] * code[None, :, :]
    return (np.logaddexp(0.0, -z) * trust[None, :, :]).sum(axis=2)


def _count_task(buckets: int, orders: int):
    def run(batches):
        grams, counts = Grams(buckets, orders), {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                held = counts.setdefault(lang, np.zeros(buckets, np.int64))
                for g in grams(text.as_py()):
                    held += np.bincount(g, minlength=buckets) if len(g) > 4096 else 0
                    if len(g) <= 4096:
                        np.add.at(held, g, 1)
            if len(counts) > 64:  # many languages: hand them on before they fill the task
                yield from _emit(counts)
                counts = {}
        yield from _emit(counts)

    def _emit(counts):
        for lang, held in counts.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(held[at], pa.int64())], names=["lang", "bucket", "n"])

    return run


def _margin_task(buckets: int, orders: int, weights):
    """Per language and bit: rows, rows with a margin above zero, sums of the margins and of their squares."""

    def run(batches):
        grams, w, sums = Grams(buckets, orders), np.frombuffer(weights.value, np.float32).reshape(buckets, -1), {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                m = margins(grams, w, text.as_py())
                s = sums.setdefault(lang, np.zeros((4, len(m))))
                s += np.stack([np.ones_like(m), m > 0, m, m * m])
        for lang, s in sums.items():
            bits = s.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * bits, pa.string()), pa.array(range(bits), pa.int32()), *[pa.array(x, pa.float64()) for x in s]],
                names=["lang", "bit", "n", "above", "total", "squares"])

    return run


class Model:
    """languages, code, weights (bytes of float32, buckets x bits; None for fewer than two languages), and per bit
    the ``slope`` and ``middle`` that make log odds of a margin; trust is languages x bits."""

    def __init__(self, languages, code, weights=None, slope=None, middle=None, trust=None):
        self.languages, self.code, self.weights = languages, code, weights
        self.slope, self.middle, self.trust = slope, middle, trust


def _weights(counts: DataFrame, totals: dict, languages: list[str], code: np.ndarray, buckets: int) -> np.ndarray:
    """Log ratios (buckets x bits), summed by Spark; the driver sees one number per bucket and bit."""
    spark = counts.sparkSession
    signs = [(lang, b, int(code[i, b]), float(totals[lang] + SMOOTHING * buckets))
             for i, lang in enumerate(languages) for b in range(code.shape[1])]
    book = spark.createDataFrame(signs, "lang string, bit int, sign int, whole double")
    share = F.col("n") / F.col("whole")
    sums = (counts.join(F.broadcast(book), "lang").groupBy("bucket", "bit")
            .agg(F.sum(F.when(F.col("sign") > 0, share).otherwise(0.0)).alias("plus"),
                 F.sum(F.when(F.col("sign") < 0, share).otherwise(0.0)).alias("minus"))).toArrow()
    plus, minus = (np.zeros((buckets, code.shape[1])) for _ in range(2))
    at = np.asarray(sums.column("bucket").combine_chunks()), np.asarray(sums.column("bit").combine_chunks())
    plus[at] = np.asarray(sums.column("plus").combine_chunks())
    minus[at] = np.asarray(sums.column("minus").combine_chunks())
    unseen = np.array([SMOOTHING / (totals[lang] + SMOOTHING * buckets) for lang in languages])
    up, down = ((code == s) for s in (1, -1))
    plus = (plus + unseen @ up) / up.sum(axis=0)
    minus = (minus + unseen @ down) / down.sum(axis=0)
    return np.log(plus / minus).astype(np.float32)


def fit(rows: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS, seed: int = 0) -> Model:
    """The model of all ``rows`` (lang, text) with a lang and a letter in the text."""
    spark = rows.sparkSession
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select("lang", "text")
    counts = stage(rows.mapInArrow(_count_task(buckets, orders), "lang string, bucket int, n long")
                   .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "gram-counts")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # one row per language
    languages = sorted(totals)
    code = codebook(len(languages), seed)
    if len(languages) < 2:
        return Model(languages, code)
    weights = _weights(counts, totals, languages, code, buckets).tobytes()
    shared = spark.sparkContext.broadcast(weights)  # buckets x bits floats, whatever the corpus
    sums = rows.mapInArrow(_margin_task(buckets, orders, shared), "lang string, bit int, n double, above double, total double, squares double") \
        .groupBy("lang", "bit").agg(*[F.sum(c).alias(c) for c in ("n", "above", "total", "squares")]).collect()
    n, above, total, squares = (np.zeros(code.shape) for _ in range(4))
    for r in sums:
        i = languages.index(r.lang)
        n[i, r.bit], above[i, r.bit], total[i, r.bit], squares[i, r.bit] = r.n, r.above, r.total, r.squares
    mean = total / n
    spread = np.maximum(squares / n - mean ** 2, 0.0)
    up, down = code > 0, code < 0
    # every language counts alike on its side, however many rows it has
    high, low = ((mean * s).sum(axis=0) / s.sum(axis=0) for s in (up, down))
    gap = np.maximum(high - low, 1e-6)
    slope, middle = gap / np.maximum(spread.mean(axis=0), (gap / APART) ** 2), (high + low) / 2
    right = np.where(up, above, n - above) / n
    trust = np.maximum(right - 0.5, 0.01)
    return Model(languages, code, weights, slope, middle, trust / trust.sum(axis=1, keepdims=True))


def _predict_task(buckets: int, orders: int, shared, model: Model, ambiguity: float):
    languages, code, slope, middle, trust = model.languages, model.code, model.slope, model.middle, model.trust

    def run(batches):
        grams = w = None
        for batch in batches:
            texts = batch.column("text")
            lang, score, vague = [UNKNOWN] * len(texts), [0.0] * len(texts), [not languages] * len(texts)
            rows, found = [], []
            for i, t in enumerate(texts):
                text = t.as_py()
                if not text or not _LETTER.search(text):
                    vague[i] = True
                elif len(languages) == 1:
                    lang[i], score[i] = languages[0], 1.0
                elif languages:
                    if grams is None:
                        grams, w = Grams(buckets, orders), np.frombuffer(shared.value, np.float32).reshape(buckets, -1)
                    rows.append(i)
                    found.append(margins(grams, w, text))
            if rows:
                cost = decode((np.array(found) - middle) * slope, code, trust)
                best = cost.argmin(axis=1)
                odds = np.exp(cost.min(axis=1, keepdims=True) - cost)
                share = 1 / odds.sum(axis=1)
                order = np.sort(cost, axis=1)
                for i, b, s, gap in zip(rows, best.tolist(), share.tolist(), (order[:, 1] - order[:, 0]).tolist()):
                    lang[i], score[i], vague[i] = languages[b], s, gap < ambiguity
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in batch.schema.names if c != "text"] +
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(vague, pa.bool_())],
                names=[c for c in batch.schema.names if c != "text"] + ["lang_pred", "score", "ambiguous"])

    return run


def predict(docs: DataFrame, model: Model, buckets: int = BUCKETS, orders: int = ORDERS, ambiguity: float = AMBIGUITY) -> DataFrame:
    """``docs`` (any columns and text) without text, with lang_pred, score (0 to 1) and ambiguous."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.weights) if model.weights else None
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(_predict_task(buckets, orders, shared, model, ambiguity),
                           f"{schema}, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame, folds: int = 4, held: int = 2, **settings) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, ambiguous.

    Rows whose CRC-32 of the doc_id (as text; null: of the empty text) modulo ``folds`` is ``held`` are held out:
    the model learns from all others with a lang and a letter in their text. A prediction sees the text only. A
    null, empty or letterless text is "und" with score 0 and ambiguous, and so is every text if there is nothing
    to learn from; with one language to learn, all texts with letters get it with score 1. Repeated rows get
    equal results, ties go to the first language by name. An empty table gives an empty result.
    """
    ident = column(docs, "doc_id", "string")
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"),
                       (F.crc32(F.coalesce(ident, F.lit("")).cast("binary")) % folds == held).alias("held_out"),
                       column(docs, "lang", "string").alias("lang"),
                       F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    model = fit(rows.filter(~F.col("held_out")).select("lang", "text"), **settings)
    return predict(rows.select("doc_id", "held_out", "text"), model, **{k: v for k, v in settings.items() if k != "seed"})
