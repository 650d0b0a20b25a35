import hashlib
import random
import re

import pytest

from weeklens.llm import credential_links as cl

from .conftest import rows

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{cl.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def check(got, data):
    assert len(got) == len(data)
    known = {}
    for d, t in data:
        known.setdefault(d, set()).add(base_spans(t or ""))
    for r in got:
        base = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in cl.KINDS[:3])
        assert base in known[r.doc_id], (r, known[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(base.count(k + ":") for k in cl.KINDS[:3])


def test_odd_rows(odd):
    check(cl.scan(odd).collect(), [(r[0], r[1]) for r in rows()])


def test_empty_table(empty):
    assert cl.scan(empty).collect() == []


def test_base_patterns_on_hard_texts(plain):
    r = random.Random(11)
    parts = ["secret", "=", "token", ": ", "abc", "abcdef12", "AKIA", "A1B2C3D4E5F6G7H8", "\U0001F600", " ", "'", '"', "\n",
             "0123456789abcdef01234567", "é", "api_key", "APIKEY", "passwd", "KIA", "deadbeef", "ſecret", "==", "/x"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(1, 40))) for _ in range(400)]
    texts += ["secret=token: abcdefgh", "AKIAAKIA" + "B" * 30, "token=" + "a" * 5, "f" * 24 + "g" + "f" * 23, "x" * 10_000]
    check(cl.scan(plain(texts)).collect(), list(enumerate(texts)))


def kinds(row):
    return [f.kind for f in row.findings]


def test_weak_parts_need_their_complement(plain):
    key, opaque = "AKIA" + "Q7" * 8, "Zk3pQ9xLm2Vt8RwYb5"
    texts = [
        f"user: alice password = hunter22x at https://db.example/x",  # login, secret and endpoint
        "user: alice at https://db.example/x",  # nothing secret
        f"login=bob {opaque}",  # two weak parts that complete each other
        f"{opaque} https://db.example",  # no identifier
        f"{key} {opaque} 10.0.0.1:5432",  # access key, opaque secret, address
        f"user: alice {'x ' * 150} password = hunter22x",  # too far apart
        f"user: alice {'x ' * 90} password = hunter22x",
    ]
    got = {r.doc_id: kinds(r) for r in cl.scan(plain(texts)).collect()}
    assert got == {0: ["login", "assign", "endpoint"], 1: [], 2: ["login", "opaque"], 3: [],
                   4: ["access", "opaque", "endpoint"], 5: ["assign"], 6: ["login", "assign"]}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_match_brute_force(plain, seed):
    r = random.Random(seed)
    words = [f"user: alice{i}" for i in range(4)] + ["password=abcdef9", "filler", "some words here", "http://h.example/p",
                                                     "Zk3pQ9xLm2Vt8RwYb5", "AKIA" + "Z" * 16]
    texts = [" | ".join(r.choice(words) + " " * r.randrange(120) for _ in range(r.randrange(1, 14))) for _ in range(120)]
    docs = plain(texts)
    parts = cl.spans(cl.candidates(docs)).collect()
    ident = {(p._rid, p.start) for p in parts if p.kind in cl.IDENT}
    secret = {(p._rid, p.start) for p in parts if p.kind in cl.SECRET}
    near = lambda p, those: any(d == p._rid and abs(s - p.start) <= cl.REACH for d, s in those)
    expected = sorted((p._rid, p.kind, p.start, p.end) for p in parts if p.kind in cl.BASE
                      or {3: near(p, secret), 5: near(p, ident), 4: near(p, ident) and near(p, secret)}[p.kind])
    got = sorted(tuple(x) for x in cl.linked(cl.spans(cl.candidates(docs))).select("_rid", "kind", "start", "end").collect())
    assert got == expected and any(k == 3 for _, k, _, _ in got)
