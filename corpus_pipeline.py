"""Corpus pipeline: quality, exact and near duplicates, decontamination, packing.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame. ``run`` writes each stage to the shared checkpoint
folder as Parquet and reads it again as the next stage's documents, so a lost
executor never costs more than the stage it was working on.
"""

from __future__ import annotations

import public_tokenizers

from weeklens.llm.bayes_quality import drop_rejected
from weeklens.llm.common import stage
from weeklens.llm.mixture_packing import pack
from weeklens.llm.poly_fingerprints import drop_exact_duplicates
from weeklens.llm.simhash_trie import drop_near_duplicates
from weeklens.llm.template_decontam import drop_contaminated

# the vocabulary of byte_bpe_50k.json as ranks
TOKENIZER_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier rejects (bad or toxic ones) go.

    A null text counts as empty and is judged by its host and path alone; null or repeated ids and repeated rows
    are judged row by row. Without labels, or without documents, nothing is dropped.
    """
    return drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark, docs, sf_dir):
    """Of equal texts, the document with the largest doc_id stays.

    Null counts as empty; a null doc_id ranks lowest, and of rows that tie the last in the scan stays. An empty
    table stays empty.
    """
    return drop_exact_duplicates(docs)


def near_dedup(spark, docs, sf_dir):
    """Of documents linked by SimHash (four words, at most four bits), the one with the least doc_id stays.

    Texts without words (null, empty) have the fingerprint zero and are linked like any other; a row with an id
    stays before one without, and of repeated rows the first of the scan. An empty table stays empty.
    """
    return drop_near_duplicates(docs, words=4, max_bits=4)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold a benchmark item go.

    Null and empty texts hold none and stay; repeated rows go or stay together. An empty benchmark, or one of null
    texts, drops nothing.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark, docs, sf_dir):
    """Pieces of documents in sequences of 2048 tokens, every window mixed like the whole.

    A null text is empty and still gives its end token; null ids are carried along, documents of a null source are
    a queue of their own. No documents give no pieces.
    """
    return pack(docs, TOKENIZER_RANKS)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# A trained classifier and tokenizer ids are no SQL; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
