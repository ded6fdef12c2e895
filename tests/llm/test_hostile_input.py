"""Inputs that broke or slowed the operators once."""

import random
import time

import numpy as np
import public_tokenizers as P
import pytest

from posegrid.llm import bpe, byte_bpe, decontaminate, html_text, language_id, minhash, pretoken, span_dedup, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ('<table><tr><td colspan="²">x<td>y</table>', "x  y"),
        ('<ol start="--5"><li>a</ol>', "1. a"),
        ('<ol start="²"><li>a</ol>', "1. a"),
        ("<table><tr><td colspan=" + "9" * 5000 + ">x<td>y</table>", "x  y"),
        ("&#" + "1" * 5000 + ";", "�"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("<table><tr><td>a<br>b<td>c<tr><td>dd<td>e</table>", "a   c\nb\ndd  e"),
        ("<table><tr><td>L<table><tr><td>1<td>2</table>R<td>S</table>", "L\n\n1  2\n\nR\nS"),
        ("<table><tr><td>a<td>" + "w" * 121 + "<tr><td>bb<td>c</table>", "a   " + "w" * 121 + "\nbb  c"),
    ],
)
def test_html_numbers_spans_and_wide_cells(markup, text):
    assert html_text.extract(markup) == text


@pytest.mark.parametrize("part", ["<table><tr><td>x", "<table><tr><td>x<td>", "<ul><li>x", "</a", "<a '>", "<a x='>"])
def test_html_time_grows_with_the_markup(part):
    began = time.process_time()
    html_text.extract(part * 20_000)
    assert time.process_time() - began < 20


def test_wording_that_many_items_share():
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n))
    opening = "choose the best answer to the question below: "
    items = [(i, opening + words(12)) for i in range(2000)]
    index = decontaminate.Index(items)
    text = " ".join(opening + words(8) for _ in range(500)) + " " + items[7][1].replace("e", "3", 1) + " " + items[9][1]
    assert [(i, e) for _, i, e, *_ in index.matches([text])] == [(7, 1), (9, 0)]


def test_items_of_common_grams_only(monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 50)
    items = [(i, f"what is the capital city of {chr(97 + i % 26)}{i}?") for i in range(300)]
    index = decontaminate.Index(items)
    assert not index.rare.any()
    found = index.matches([f"so, {items[123][1]} it went", "nothing of the kind here"])
    assert (0, 123, 0) in [f[:3] for f in found] and {f[0] for f in found} == {0}


def test_short_items_stand_as_whole_words():
    index = decontaminate.Index([(1, "tiny"), (2, ""), (3, "2+2=4")])
    assert [m[:2] for m in index.matches(["a tiny one", "destiny", "so 2+2=4.", ""])] == [(0, 1), (2, 3)]


def test_counts_of_long_runs_are_composed(monkeypatch):
    machine, rng = token_counts.compiled(JSON), random.Random(5)
    letters = "".join(rng.choices("etaoinshrdlu", k=12_000)).encode()
    runs = []
    monkeypatch.setattr(machine, "_run", lambda piece, run=machine._run: runs.append(len(piece)) or run(piece))
    pieces = [letters, b"abc" * 3000, b"=" * 9001, bytes(range(256)) * 20]
    assert machine.count(pieces).tolist() == [len(machine.vocab.encode(p)) for p in pieces]
    assert len(letters) not in runs


def test_unknown_ids_are_refused_and_parts_decode():
    codec = byte_bpe.Codec(RANKS, pretoken.kinds_by_tiktoken())
    with pytest.raises(ValueError):
        codec.decode(np.array([10**6], dtype="<u4"))
    text = "Three words, and então more."
    (ids, ends), = codec.encode_with_ends([text])
    pieces, _ = pretoken.slices([text], pretoken.kinds_by_tiktoken())
    assert [codec.decode_part(ids, ends, k, k).decode() for k in range(len(ends))] == pieces


def test_distinct_pieces_make_up_the_slices():
    rng = random.Random(1)
    texts = ["".join(rng.choices(["a", "the", " ", "\n", "é", "<|endoftext|>", "12", "!"], k=60)) for _ in range(40)]
    for mark in (None, "<|endoftext|>"):
        pieces, number, per_text = pretoken.distinct(texts, pretoken.kinds_by_tiktoken(), mark)
        assert ([pieces[k] for k in number], per_text) == pretoken.slices(texts, pretoken.kinds_by_tiktoken(), mark)
        assert len(set(pieces)) == len(pieces)


def test_scores_are_naive_bayes_by_hand(spark):
    docs = spark.createDataFrame([("ab ab", "x"), ("ba", "x"), ("cd cd cd", "y")], "text string, lang string")
    model = language_id.train(docs, bits=8)
    counts = np.zeros((2, 256))
    for text, lang in docs.collect():
        for b in language_id.features(text, 8):
            counts["xy".index(lang), b] += 1
    log = np.log((counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True))
    for text in ("ab", "cd ab", "dcd"):
        at = language_id.features(text, 8)
        want = np.log([2 / 3, 1 / 3]) + log[:, at].sum(axis=1)
        score = 1 / np.exp((want - want.max()) / len(at) ** 0.5).sum()
        preds, scores = model.score([None, text, "12"])
        assert preds == ["und", "xy"[int(want.argmax())], "und"] and scores[1] == pytest.approx(score)


def test_many_labels_get_fewer_buckets(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_MODEL_BYTES", 8 * 64 * 300)
    docs = spark.range(300).selectExpr("concat('word', id) AS text", "concat('l', id) AS lang")
    model = language_id.train(docs, bits=10)
    assert len(model.langs) == 300 and model.log_prob.nbytes <= language_id.MAX_MODEL_BYTES and model.bits == 6


def test_rows_of_one_id_and_wide_scripts(spark):
    passage = "One sentence of several words here. Then another one of words. And a third one ends it."
    rows = [(1, f"{passage} Own end a."), (1, f"{passage} Own end b."), (2, "今天的天气非常好。我们一起去公园散步吧。晚上再回来吃饭。"), (3, "開頭。今天的天气非常好。我们一起去公园散步吧。晚上再回来吃饭。")]
    left = sorted(r.text for r in span_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert sum(passage in t for t in left) == 1 and sum("公园" in t for t in left) == 1


@pytest.mark.parametrize("head, part, tail", [("<a><button>", "<i>", "</a>"), ("<form><button>", "<b>", "</form>"), ("<p><table><td>", "<u>", "</p>")])
def test_html_time_grows_with_end_tags_that_a_fence_hides(head, part, tail):
    began = time.process_time()
    html_text.extract(head + part * 60_000 + "x" + tail * 60_000)
    assert time.process_time() - began < 20


CLASHING = "_id _rid _ranges _gone gone covered_id covered_rid covered_ranges key node first part tail text_".split()


def test_columns_of_any_name_pass_through(spark):
    """The pipeline's row filters keep columns that are named like their own."""
    passage = "One sentence of the passage here. Another sentence of the passage there. And a third one that ends the whole passage now."
    before = "Before it there stood quite some other words that differ from all the words of these."
    texts = [passage, f"{before} {passage}", passage, "Nothing of the kind stands in this text of some words."]
    rows = [(i, t, *range(len(CLASHING))) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} int" for c in CLASHING))
    benchmark = spark.createDataFrame([(1, "Nothing of the kind stands in this text")], "item_id long, text string")
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 3]
    left = span_dedup.remove_repeats(df)
    assert left.columns == df.columns and {r.doc_id: r.text.strip() for r in left.collect()} == {0: passage, 1: before, 3: texts[3]}
    clean = decontaminate.keep_clean(df, benchmark)
    assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == [0, 1, 2]
    assert [tuple(r)[2:] for r in left.collect()] == [tuple(range(len(CLASHING)))] * 3
