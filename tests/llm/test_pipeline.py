import corpus_pipeline as cp
from weeklens.llm import simhash_trie
from weeklens.llm.queries import QUERIES

from .conftest import rows

SF = "/root/testdata/sf0.001"
TABLES = "documents"


def test_stages(spark):
    """Each stage on what its predecessor kept, with its decisions in effect."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, [docs.count()]
    for name, step in cp.STAGES[:-1]:
        from weeklens.llm.common import stage
        docs = stage(step(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns, name
        left.append(docs.count())
    assert left == sorted(left, reverse=True) and left[-1] > left[0] // 2
    texts = [r.text for r in docs.select("text").collect()]
    assert len(set(texts)) == len(texts)
    fps = [simhash_trie.simhash(t) for t in texts]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(fps) for b in fps[:i])
    pieces = cp.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_stages_take_odd_and_empty_documents(spark, odd, empty):
    for name, step in cp.STAGES[:-1]:
        assert step(spark, odd, SF).columns == odd.columns, name
        assert step(spark, odd, SF).count() > 0 and step(spark, empty, SF).count() == 0, name
    pieces = cp.packing(spark, odd, SF).collect()
    assert {p.doc_id for p in pieces} == {r[0] for r in rows()} and cp.packing(spark, empty, SF).count() == 0


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in cp.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "packing"]
