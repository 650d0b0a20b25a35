import hashlib

from weeklens.llm import queries
from weeklens.llm import warc_assembly as wa
from weeklens.llm.common import stage_path

BIG = "<p>" + "long page " * 200 + "\r\n\r\nWARC/1.0\r\n\r\n</p>"
PAGES = [
    (1, "http://a.example/x?y=1", BIG, "x"), (2, "http://a.example/", BIG, None), (2, None, BIG, "x"),
    (3, "bad url \r\n with lines", "<p>short</p>", "x"), (4, "http://b.example", "<p>short</p>", "x"),
    (None, "http://c.example/ü", None, None), (5, "http://d.example/", "", "x"),
    (None, None, "é" * 600, "x"), (None, None, "é" * 600, "x"), (6, "http://e.example/", "z" * 200_000, "x"),
]
SCHEMA = "page_id long, url string, html string, digest string"


def table(spark, rows=PAGES):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    groups = {}
    for place, (page, _, html, _) in enumerate(rows):
        groups.setdefault((html or "").encode(), []).append((page if page is not None else -1, place, page))
    out = []
    for body, members in groups.items():
        last = max(members)
        for m in members:
            again = len(body) >= 1000 and m != last
            out.append((m[2], len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
                        last[2] if again else None))
    return sorted(out, key=str)


def test_roundtrip(spark):
    got = wa.archive_roundtrip(table(spark)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(PAGES)


def test_the_query_reads_and_joins_all_three_kinds(spark):
    path = stage_path(spark, "warc-test")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    wa.write_archive(pages, path)
    captures = wa.read_captures(spark, path, False).select("record_id", "request.record_id", "metadata.record_id")
    plan = captures._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 3 and plan.count("Join") == 2
    got = queries.op2_warc_transactions(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == pages.count()
    ids = {k: [getattr(r, k) for r in got] for k in ("request_id", "metadata_id")}
    assert all(len(set(v)) == len(got) and None not in v for v in ids.values()) and not set(ids["request_id"]) & set(ids["metadata_id"])
    kept = {kind: {h["warc-record-id"]: h["warc-concurrent-to"] for f in spark.read.format("binaryFile").load(f"{path}/{kind}").collect()
                   for h, _ in wa._records(memoryview(bytes(f.content)))} for kind in ("request", "metadata")}
    assert set(kept["request"]) == set(ids["request_id"]) and set(kept["metadata"]) == set(ids["metadata_id"])
    assert all(kept["request"][r.request_id] == kept["metadata"][r.metadata_id] for r in got)
    urls = {r.page_id: r.url for r in pages.collect()}
    assert all(r.request_uri == urls[r.page_id] for r in got)


def test_empty_table(spark):
    assert wa.archive_roundtrip(table(spark, [])).collect() == []


def test_captures_hold_payload_request_and_metadata(spark):
    path = stage_path(spark, "warc-test")
    wa.write_archive(table(spark), path, file_bytes=4096)
    got = wa.read_captures(spark, path).collect()
    assert len(got) == len(PAGES) and all(r.request is not None and r.metadata is not None for r in got)
    kept = sorted(bytes(r.response.payload) for r in got if r.response.type == "response")
    bodies = [(p[2] or "").encode() for p in PAGES]
    assert kept == sorted([b for b in bodies if len(b) < 1000] + list({b for b in bodies if len(b) >= 1000}))
    first = next(r for r in got if r.page_id == 1)
    assert bytes(first.request.block).startswith(b"GET /x?y=1 HTTP/1.1\r\nHost: a.example\r\n")
    assert first.response.target_uri == "http://a.example/x?y=1"


def test_mixed_records_and_orphans(spark):
    path = stage_path(spark, "warc-test")
    wa.write_archive(table(spark), path)
    parts = [wa.read_records(spark, f"{path}/{k}") for k in ("response", "request", "metadata")]
    mixed = parts[0].unionByName(parts[1].limit(0)).unionByName(parts[2])
    orphan = spark.createDataFrame([("<urn:uuid:0>", "metadata", "<urn:uuid:none>", 9)],
                                   "record_id string, type string, concurrent_to string, page_id long")
    mixed = mixed.unionByName(orphan, allowMissingColumns=True)
    got = wa.assemble(mixed, mixed, mixed).collect()
    assert len(got) == len(PAGES) and all(r.request is None and r.metadata is not None for r in got)


def test_records_are_cut_by_length(tmp_path):
    body = b"HTTP/1.1 200 OK\r\n\r\nx\r\n\r\nWARC/1.0\r\n"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(body), body)
    got = list(wa._records(memoryview(record * 3)))
    assert [bytes(b) for _, b in got] == [body] * 3
