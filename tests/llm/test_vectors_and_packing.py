"""Operators 11 to 13 against plain loops and the tokenizers library."""

import math
import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest

from posegrid.llm import hard_negatives, packing, queries, vector_codes

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=300, dim=16, seed=3, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dim))
    x = (centres[rng.integers(0, 7, n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32) / 4
    return [(i, [float(c) for c in x[i]], int(rng.integers(0, labels))) for i in range(n)]


ODD = [
    (None, None, 1),
    (7000, None, 1),
    (7001, [float("nan")] * 16, 1),
    (7002, [float("inf")] + [0.0] * 15, 1),
    (7003, [None] + [0.0] * 15, 2),
    (7004, [0.5] * 3, 2),
    (7005, [], 2),
]


# -- operator 11


def plain_lloyd(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Plain Lloyd rounds, anew each time, in Python integers."""
    kept = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    ints = [[math.floor(scale * c) for c in r[1]] for r in kept]
    raw = lambda v: np.array(v, dtype="<i4").tobytes()
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, raw(ints[i])))
    width = len(ints[order[0]]) // parts
    kept, ints = zip(*[(k, v) for k, v in zip(kept, ints) if len(v) == width * parts])
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, raw(ints[i])))[:entries]
    books = [[ints[i][p * width : (p + 1) * width] for i in order] for p in range(parts)]

    def nearest(v, p):
        part = v[p * width : (p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for v in ints:
                members[nearest(v, p)[1]].append(v[p * width : (p + 1) * width])
            for k, got in members.items():
                books[p][k] = [sum(c) // len(got) for c in zip(*got)]
    out = []
    for r, v in zip(kept, ints):
        found = [nearest(v, p) for p in range(parts)]
        out.append((r[0], "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), r[2]))
    return out, books


def check_codes(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = vector_codes.fit(df)
    wanted, books = plain_lloyd(rows)
    got = vector_codes.with_label_error(found.rows).collect()
    by_label = defaultdict(int)
    for _, _, error, label in wanted:
        by_label[label] += error
    key = lambda r: (r[0] is None, r[0] or 0, r[1:3])
    assert sorted(((r["vec_id"], bytes(r["code"]).hex(), r["error"], r["label_error"]) for r in got), key=key) == sorted(
        ((i, c, e, by_label[label]) for i, c, e, label in wanted), key=key
    )
    assert found.books.tolist() == books


def test_codes_equal_plain_lloyd(spark):
    check_codes(spark, vectors())


def test_codes_of_odd_rows(spark):
    rows = vectors(120) + ODD
    rows += [(5, rows[9][1], None), (5, rows[9][1], None), (None, rows[3][1], None), (60, rows[60][1], 1)]  # repeats and nulls
    rows += [(8000 + i, rows[20][1], 3) for i in range(90)]  # many ties
    check_codes(spark, rows)


def test_codes_of_few_rows_and_none(spark):
    check_codes(spark, vectors(5))
    empty = spark.createDataFrame(ODD[:4], SCHEMA)
    assert vector_codes.with_label_error(vector_codes.fit(empty).rows).collect() == []


def test_codes_rounds_send_what_changed(spark):
    """The deltas of a round are those of the parts that moved, and a fixpoint ends the rounds."""
    rows = [(i, [float(i % 2)] * 8, 0) for i in range(40)]
    found = vector_codes.fit(spark.createDataFrame(rows, SCHEMA), entries=2)
    assert found.changed[0] > 0 and found.changed[1:] == [0]


def test_codes_refuse_what_does_not_fit(spark):
    df = spark.createDataFrame([(0, [1.0] * 12, 0)], SCHEMA)
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.fit(df)
    far = spark.createDataFrame([(0, [1e9] * 8, 0)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        vector_codes.fit(far)


# -- operator 13


def plain_mining(rows, every, k=5, low=80, scale=256):
    kept = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v):
            kept[(i, tuple(math.floor(scale * c) for c in v), label)] = True
    kept = list(kept)
    width = len(min(kept)[1])
    kept = [r for r in kept if len(r[1]) == width]
    out = []
    for a in kept:
        if a[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[1], r[1])), r[0], r) for r in kept)
        like = [(-s, i) for s, i, r in scored if r[2] == a[2] and r != a][:k]
        for score, i in like:
            other = [(-s, j) for s, j, r in scored if r[2] != a[2] and low * score <= -100 * s <= 100 * score][:k]
            out += [(a[0], i, n, j, score, s) for n, (s, j) in enumerate(other, 1)]
    return sorted(out)


def mined(df, every, **settings):
    from pyspark.sql import functions as F

    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % every == 0, **settings).collect())


def test_negatives_equal_plain_sort(spark):
    rows = vectors(400)
    got = mined(spark.createDataFrame(rows, SCHEMA), 10)
    assert got and got == plain_mining(rows, 10)


def test_negatives_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 37)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 5)
    monkeypatch.setattr(hard_negatives, "SCORES", 50)
    rows = vectors(300, seed=8)
    assert mined(spark.createDataFrame(rows, SCHEMA), 7) == plain_mining(rows, 7)


def test_negatives_of_odd_rows(spark):
    rows = vectors(150, seed=5)
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(200)]  # one vector in a large group, all ties
    rows += [*ODD, (20, rows[20][1], None), rows[10], rows[10], (None, rows[4][1], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS a", "2 AS b", "3 AS rid", "4 AS v", "5 AS score")
    assert mined(df, 10) == plain_mining(rows, 10)


def test_negatives_of_negative_scores_and_of_none(spark):
    rows = [(0, [1.0] * 4, 0), (1, [-1.0] * 4, 0), (2, [-0.9] * 4, 1), (3, [-1.1] * 4, 1)]
    assert mined(spark.createDataFrame(rows, SCHEMA), 2) == plain_mining(rows, 2)
    assert mined(spark.createDataFrame(ODD, SCHEMA).where("vec_id >= 7005"), 10) == []
    assert mined(spark.createDataFrame(rows, SCHEMA).where("vec_id = 1"), 10) == []


def test_large_scores_stay_exact(spark):
    rows = [(i, [60000.0 + i, 59999.0 - 3 * i] * 8, i % 2) for i in range(30)]
    assert mined(spark.createDataFrame(rows, SCHEMA), 5, scale=4096) == plain_mining(rows, 5, scale=4096)


# -- operator 12


def library_pieces(texts, end_id=0, capacity=2048):
    from tokenizers import Tokenizer

    library, out = Tokenizer.from_file(TOKENIZER), {}
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end_id]
        for k in range(0, len(ids), capacity):
            piece = np.array(ids[k : k + capacity], dtype="<u4")
            out[doc_id, k // capacity] = (k, len(piece), zlib.crc32(piece.tobytes()))
    return out


def check_packed(rows, capacity):
    """No two pieces meet, none leaves its sequence, nothing but the end is empty."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op12_best_fit_packing(spark, SF).collect()
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    assert len(got) == len(rows) and got == library_pieces(docs)
    n = check_packed(rows, 2048)
    total = sum(r["length"] for r in rows)
    assert n <= math.ceil(total / 2048) + 1


HOSTILE = [
    None, "", " \n\t ", "Hello, WORLD's don't 123 I'LL", "<|endoftext|>a<|startoftext|> b<|endoftext", "ΣΑΣ ΟΔΟΣ İstanbul ẞ", "é ́x à́",
    "a\x1cb c\x85d e f g h i­j", "中文没有空格。日本語テキスト", "한국어 한", "🙂🙃 👨‍👩‍👧 x²½Ⅷ", "ａｂｃ ﬁ ⁵", "x" * 70 + " " + "7" * 40,
    "word " * 3000, "longrun" * 2000, "؀۝١ ـكتاب", "\U0001f1e6‍﻿�",
]


def test_packing_of_hostile_texts(spark):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(HOSTILE)], "doc_id long, text string, task int, nth int")
    cut = packing.pieces(df, TOKENIZER, 0, 2048)
    placed = packing.place(cut)
    rows = placed.collect()
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in rows}
    assert got == library_pieces(enumerate(HOSTILE))
    check_packed(rows, 2048)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(placed).collect()}
    for r in rows:
        at = 4 * r["offset"]
        assert whole[r["sequence_id"]][at : at + 4 * r["length"]] == bytes(r["ids"])


def test_packing_of_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b")] * 50 + [(None, "c")] * 3, "doc_id long, text string")
    rows = packing.place(packing.pieces(df, TOKENIZER, 0, 8), 8).collect()
    assert len(rows) == 53 and check_packed(rows, 8) == 25  # 3 + 3 + 2 thrice, then 3 + 3
    none = packing.place(packing.pieces(df.limit(0), TOKENIZER, 0, 8), 8)
    assert none.collect() == [] and "sequence_id" in none.columns


def one_at_a_time(lengths, capacity):
    """Best-two-fit on the pieces themselves, one sequence after the other."""
    free, bins = sorted(lengths, reverse=True), []
    while free:
        held, gap = [], capacity
        for x in list(free):
            if x <= gap:
                held.append(x)
                free.remove(x)
                gap -= x
        if gap and len(held) > 1:
            room = gap + held[-1]
            pairs = [
                (a + b, a, b) for a, b in combinations_with_replacement(sorted(set(free), reverse=True), 2)
                if a + b <= room and (a != b or free.count(a) > 1)
            ]
            if pairs and max(pairs)[0] > held[-1]:
                _, a, b = max(pairs)
                free.remove(a)
                free.remove(b)
                free = sorted([*free, held.pop()], reverse=True)
                held += [a, b]
        bins.append(sorted(held, reverse=True))
    return bins


@pytest.mark.parametrize("seed", range(60))
def test_patterns_are_those_of_single_pieces(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 40))
    lengths = rng.integers(1, capacity + 1 if seed % 2 else capacity // 2 + 1, int(rng.integers(1, 120)))
    got = []
    for p in packing.best_two_fit(np.bincount(lengths, minlength=capacity + 1), capacity):
        got += [sorted((x for x, n in p.uses for _ in range(n)), reverse=True)] * p.times
    assert got == one_at_a_time(lengths.tolist(), capacity)


def test_patterns_do_not_grow_with_the_pieces():
    rng = np.random.default_rng(1)
    few = np.bincount(np.minimum(2048, rng.lognormal(5.5, 1.1, 20_000).astype(int) + 1), minlength=2049)
    n = len(packing.best_two_fit(few, 2048))
    many = len(packing.best_two_fit(few * 100_000 + rng.integers(0, 99, 2049) * (few > 0), 2048))
    assert many < 6000 and n < 6000


# -- the contracts' columns


@pytest.mark.parametrize(
    "name, types",
    [
        ("op11_vector_codes", {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}),
        ("op12_best_fit_packing", {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}),
        ("op13_hard_negatives", dict.fromkeys(["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"], "bigint") | {"rank": "int"}),
    ],
)
def test_contract_columns(spark, name, types):
    assert dict(queries.queries()[name](spark, SF).dtypes) == types


def test_query_codes_and_negatives_of_the_table(spark):
    import hashlib

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    wanted, books = plain_lloyd(rows)
    got = queries.op11_vector_codes(spark, SF).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == sorted(w[:3] for w in wanted)
    flat = ",".join(str(c) for p in books for e in p for c in e)
    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(flat.encode()).hexdigest()}
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert sorted(tuple(r) for r in queries.op13_hard_negatives(spark, SF).collect()) == plain_mining(moved, 100)
