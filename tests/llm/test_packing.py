import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from weeklens.llm import mixture_packing as mp

from .conftest import rows

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(pieces, data, tokenizer, seq_len):
    """Every id of every row in exactly one piece, every sequence full but the last."""
    whole = sorted((str(d), len(ids_of(tokenizer, t))) for d, t in data)
    assert sum(p.length for p in pieces) == sum(n for _, n in whole)
    at = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == at.get(p.sequence_id, 0) and p.length > 0
        at[p.sequence_id] = p.offset + p.length
    assert sorted(at) == list(range(len(at)))
    assert all(n == seq_len for s, n in at.items() if s != max(at, default=0))


def test_ids_match_the_vocabulary_file(tokenizer):
    bpe = mp.ByteBpe(open(RANKS, "rb").read())
    r = random.Random(7)
    alphabet = "ab Z09 \n\t\r'.,!éß東\U0001F600  　\x1c\x85|#s"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(1500)]
    texts += ["it's  we'll I'M\n\n x", "   ", "a" * 300, "<|endoftext|> end", "x \n y\n", "1 2  3   4"]
    for t in texts:
        assert np.frombuffer(bpe(t), dtype="<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("window", [64, 1 << 17])
def test_odd_rows(odd, tokenizer, window):
    data = [(r[0], r[1]) for r in rows()]
    pieces = mp.pack(odd, RANKS, seq_len=256, window_tokens=window).collect()
    check(pieces, data, tokenizer, 256)
    known = {}
    for d, t in data:
        known.setdefault(d, []).append(ids_of(tokenizer, t))
    for p in pieces:
        assert any(len(i) == p.doc_tokens and p.ids_crc32 == zlib.crc32(
            np.array(i[p.start:p.start + p.length], dtype="<u4").tobytes()) for i in known[p.doc_id])


def test_empty_table(empty):
    assert mp.pack(empty, RANKS).collect() == []


def mixed(spark, counts):
    r = random.Random(3)
    data = [(i, " ".join(str(r.random()) for _ in range(r.randrange(1, 60))), s)
            for i, s in enumerate([s for s, n in counts.items() for _ in range(n)])]
    return data, spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)


def test_every_window_has_the_mixture(spark, tokenizer):
    data, docs = mixed(spark, {"a": 300, "b": 100, None: 40})
    pieces = mp.pack(docs, RANKS, seq_len=128, window_tokens=1000).collect()
    check(pieces, [(d, t) for d, t, _ in data], tokenizer, 128)
    total = {}
    for p in pieces:
        total[p.source] = total.get(p.source, 0) + p.length
    share = {s: n / sum(total.values()) for s, n in total.items()}
    last = max(p.window_id for p in pieces)
    for w in range(last - 3):
        for s in total:
            assert abs(sum(p.length for p in pieces if p.window_id == w and p.source == s) - 1000 * share[s]) <= 1.01


def test_targets_hold_until_a_queue_ends(spark, tokenizer):
    data, docs = mixed(spark, {"a": 200, "b": 200})
    pieces = mp.pack(docs, RANKS, targets={"a": 3, "b": 1}, seq_len=128, window_tokens=400).collect()
    check(pieces, [(d, t) for d, t, _ in data], tokenizer, 128)
    given = [sum(p.length for p in pieces if p.window_id == w and p.source == "a") for w in range(5)]
    assert all(abs(n - 300) <= 1 for n in given)
    with pytest.raises(ValueError, match="no target"):
        mp.pack(docs, RANKS, targets={"a": 1})
    with pytest.raises(ValueError, match="more than 1"):
        mp.pack(docs, RANKS, max_queues=1)


def test_schedule_gives_every_token_once():
    r = random.Random(5)
    for _ in range(200):
        totals = [r.randrange(1, 5000) for _ in range(r.randrange(1, 6))]
        phases = mp.schedule(totals, [r.random() + 0.01 for _ in totals], r.randrange(1, 700))
        placer = mp._Placer(phases)
        places = []
        for s, n in enumerate(totals):
            x = 0
            for start, length, place, _ in placer.pieces(s, 0, n):
                assert start == x and length > 0
                places.append((place, length))
                x += length
            assert x == n
        at = 0
        for place, length in sorted(places):
            assert place == at
            at += length
        assert at == sum(totals)


def test_added_tokens_inside_texts(spark):
    own = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y \n<|endoftext|>", "<|endoftext |> <|endoftext", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = mp.pack(docs, RANKS, seq_len=4096, with_ids=True).collect()
    got = {p.doc_id: b"" for p in pieces}
    for p in sorted(pieces, key=lambda p: p.start):
        got[p.doc_id] += p.ids
    assert {d: np.frombuffer(i, dtype="<u4").tolist() for d, i in got.items()} == {d: ids_of(own, t) for d, t in enumerate(texts)}
    assert got[0] == np.array([64, 220, 50256, 275, 1], dtype="<u4").tobytes()


def test_a_task_holds_few_rows_and_few_known_runs():
    """Memory of a worker: what is made of a batch is bounded, and so is its table of known runs."""
    import pyarrow as pa

    from weeklens.llm import mixture_packing as mp
    batch = pa.RecordBatch.from_arrays([pa.array(range(1201))], names=["doc_id"])
    parts = list(mp._sliced([batch]))
    assert [p.num_rows for p in parts] == [500, 500, 201] and pa.Table.from_batches(parts).column(0).to_pylist() == list(range(1201))
    with open(mp_path(), "rb") as f:
        bpe = mp.ByteBpe(f.read(), mp.ADDED)
    for i in range(600):
        bpe(" ".join(f"w{i}x{k}" for k in range(100)))
    assert len(bpe.known) <= mp.CACHE_WORDS + 100 <= 50_100


def test_a_text_goes_to_the_tokenizer_in_one_call(tokenizer):
    """New words cost no call of their own, whatever their number; the ids are those of the vocabulary file."""
    bpe, calls = mp.ByteBpe(open(RANKS, "rb").read(), mp.ADDED), []

    class Counted:
        def __getattr__(self, name, own=bpe.encoder):
            calls.append(name)
            return getattr(own, name)

    bpe.encoder = Counted()
    r = random.Random(11)
    text = " \n".join("".join(r.choice("abcdeéß東 '9.,") for _ in range(r.randrange(1, 30))) for _ in range(2000))
    for t in (text, "a short text", "a short text"):
        assert np.frombuffer(bpe(t), dtype="<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert len(calls) == 2


def mp_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")
