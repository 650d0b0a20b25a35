"""The training-data queries of the driver contract and their DuckDB oracles.

Every query reads its whole table through its operator; where a contract asks
for digest columns, they are derived here from the operator's own result.
"""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weeklens.llm import (
    bayes_quality,
    credential_links,
    ecoc_language,
    line_blocks,
    mixture_packing,
    periodic_runs,
    poly_fingerprints,
    sentence_spans,
    shard_propagation,
    simhash_trie,
    template_decontam,
    token_alignment,
    warc_assembly,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_label_propagation(spark, sf_dir):
    return shard_propagation.shard_documents(_table(spark, sf_dir, "documents"))


def op2_warc_transactions(spark, sf_dir):
    return warc_assembly.archive_roundtrip(_table(spark, sf_dir, "pages"))


def op3_mixture_packing(spark, sf_dir):
    return mixture_packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op4_sentence_spans(spark, sf_dir):
    found = sentence_spans.remove_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_removed", "removed", "first_docs")


def op5_line_blocks(spark, sf_dir):
    return line_blocks.extract(_table(spark, sf_dir, "pages"))


def op6_template_leaks(spark, sf_dir):
    return template_decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("_rid")


def op9_bayes_quality(spark, sf_dir):
    return bayes_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("_rid")


def op8_credential_links(spark, sf_dir):
    return credential_links.scan(_table(spark, sf_dir, "documents")).drop("findings")


def op10_simhash_trie(spark, sf_dir):
    found = simhash_trie.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op7_exact_dedup(spark, sf_dir):
    found = poly_fingerprints.exact_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def planted_words(doc_id: int | None, words: list) -> list:
    """The words op12 works on: of one document in ten (by its id's CRC-32) the words from a place on are
    replaced by repeats of the first of them. A document without an id is left as it is."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def run_digests(found: DataFrame) -> DataFrame:
    """Per document the count of its runs, the one with the greatest exponent (exactly: by cross
    multiplication; of equal ones the first) and digests of all runs and of the collapsed text."""
    larger = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.reduce("runs", none, lambda a, r: F.when(larger(a, r), r).otherwise(a))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


def op12_periodic_runs(spark, sf_dir):
    return run_digests(periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), prepare=planted_words))


def op11_token_alignment(spark, sf_dir):
    return token_alignment.link_statistics(_table(spark, sf_dir, "documents"))


def op13_ecoc_language(spark, sf_dir):
    return ecoc_language.identify(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_label_propagation": op1_label_propagation,
    "op2_warc_transactions": op2_warc_transactions,
    "op3_mixture_packing": op3_mixture_packing,
    "op4_sentence_spans": op4_sentence_spans,
    "op5_line_blocks": op5_line_blocks,
    "op6_template_leaks": op6_template_leaks,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_credential_links": op8_credential_links,
    "op9_bayes_quality": op9_bayes_quality,
    "op10_simhash_trie": op10_simhash_trie,
    "op11_token_alignment": op11_token_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ecoc_language": op13_ecoc_language,
}

ORACLE = {
    "op2_warc_transactions": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n,
                          trim(regexp_replace(url, '[\\r\\n]+', ' ', 'g')) AS request_uri,
                          row_number() OVER () - 1 AS rid FROM pages),
        u AS (SELECT *, '|' || rid || '|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || sha1(body) AS own FROM p),
        i AS (SELECT *, md5('request' || own) AS q, md5('metadata' || own) AS m FROM u),
        r AS (SELECT *, n >= 1000 AND row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) > 1 AS again,
                     max(page_id) OVER (PARTITION BY body) AS first FROM i)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first END AS refers_to, request_uri,
               '<urn:uuid:' || q[1:8] || '-' || q[9:12] || '-' || q[13:16] || '-' || q[17:20] || '-' || q[21:32] || '>' AS request_id,
               '<urn:uuid:' || m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] || '>' AS metadata_id
        FROM r""",
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
