import base64
import binascii
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from posegrid.llm import bpe, byte_bpe, pretoken, token_counts, token_files

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
KINDS = pretoken.kinds_by_tiktoken()
LIBRARY = Tokenizer.from_file(JSON)
COUNTER = token_counts._counter(JSON)
END = "<|endoftext|>"
ODD = st.lists(st.sampled_from(list("abz' \n\t1²é漢!-\u0085\U0001F600") + ["'s", "'re", "'ll", " the", END, "===", "  "]), max_size=40).map("".join)
SCHEMA = "doc_id long, text string, ids_sha256 string, part int"
ROWS = [(3, "The cat's  hat.\n\n", "x", 1), (1, None, None, None), (2, "", "y", 2), (2, "", "y", 2), (None, "null id", "z", 3),
        (4, "na " * 40_000 + END, "long", 4), (5, "ü" * 5000, "w", 5)]


def tiktoken_codec():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, max_size=6))
def test_slices_are_the_patterns_matches(texts):
    pattern = regex.compile(P.PATTERN)
    want = [pattern.findall(t) for t in texts]
    got, sizes = pretoken.slices(texts, KINDS)
    assert got == [w for t in want for w in t] and sizes == [len(t) for t in want]


def test_kinds_agree_with_the_tokenizers_library():
    table = pretoken._table(KINDS)
    rng = random.Random(0)
    for c in [*range(0, 0x3000), *(rng.randrange(0xE000, 0x110000) for _ in range(3000))]:
        pieces = [p for p, _ in LIBRARY.pre_tokenizer.pre_tokenize_str(f"a{chr(c)}")]
        assert (len(pieces) == 1) == (table[c] == pretoken.LETTER), hex(c)


@pytest.mark.parametrize("lane", [2, 3, 128])
def test_prefix_scan_is_composition(lane):
    fns = np.array([random.Random(1).randrange(15) for _ in range(1000)], dtype=np.uint8)
    compose, acc, want = pretoken.machine()[1], 0, []
    for f in fns.tolist():
        want.append(acc)
        acc = int(compose[acc << 4 | f])
    assert pretoken.prefix_scan(fns, lane).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=6))
def test_machine_counts_as_the_library(texts):
    mark, memo = COUNTER
    pieces, sizes = pretoken.slices(texts, KINDS, mark)
    counts, at, got = memo.of(pieces), 0, []
    for n in sizes:
        got.append(sum(counts[at : at + n]))
        at += n
    assert got == [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_machine_on_every_token_and_long_runs():
    vocab, _ = bpe.from_json(JSON)
    machine = token_counts.compiled(JSON)
    pieces = [*list(vocab.ids)[::7], b"=" * 3000, b"a" * 700, bytes(range(256)) * 3]
    assert machine.count(pieces).tolist() == [len(vocab.encode(p)) for p in pieces]


@settings(max_examples=60, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=5))
def test_codec_round_trip_as_tiktoken(texts):
    codec, library = byte_bpe.codec_of(RANKS, KINDS), tiktoken_codec()
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
        assert codec.offsets(ids)[-1] == len(text.encode())


def test_queries_on_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    want = {(r[0], len((r[1] or "").encode()), len(LIBRARY.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS}
    got = token_counts.token_counts(docs, JSON).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(ROWS)
    library = tiktoken_codec()
    got = byte_bpe.round_trip(docs, RANKS).collect()
    want = sorted(hashlib.sha256(np.array(library.encode_ordinary(r[1] or ""), "<u4").tobytes()).hexdigest() for r in ROWS)
    assert sorted(r.ids_sha256 for r in got) == want
    assert sorted(r.decoded_sha256 for r in got) == sorted(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in ROWS)
    back = byte_bpe.decode(byte_bpe.encode(docs, RANKS), RANKS).collect()
    assert sorted(r.text for r in back) == sorted(r[1] or "" for r in ROWS)
    for op in (token_counts.token_counts(docs.limit(0), JSON), byte_bpe.round_trip(docs.limit(0), RANKS)):
        assert op.count() == 0


@pytest.mark.parametrize("kind", [token_files.BITS, token_files.BYTES])
@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=70))
def test_planes_round_trip(kind, ids):
    a = np.array(ids, dtype="<u4")
    assert (token_files.from_planes(token_files.to_planes(a, kind), len(a), kind) == a).all()


@pytest.mark.parametrize("kind", [token_files.BITS, token_files.BYTES])
def test_file_round_trip(tmp_path, kind, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK", 64)
    rng = np.random.default_rng(1)
    docs = [(i if i else None, rng.integers(0, 50257, n, dtype=np.uint32)) for i, n in enumerate([0, 1, 63, 64, 65, 500, 0, 3])]
    with open(tmp_path / "f", "wb") as f:
        writer = token_files.Writer(f, kind)
        for doc_id, ids in docs:
            writer.add(doc_id, ids)
        writer.close()
    system, path = token_files.file_system(str(tmp_path / "f"))
    with system.open_input_file(path) as source:
        got = list(token_files.Reader(source).documents())
    assert [(d, i.tolist()) for d, i in got] == [(d, i.tolist()) for d, i in docs]


def test_token_files_query(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in token_files.round_trip(docs, JSON, 2).collect()}
    at, want = 0, {}
    for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*LIBRARY.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        want[r[0], at] = (len(ids), binascii.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want
    assert token_files.round_trip(docs.limit(0), JSON, 2).count() == 0
