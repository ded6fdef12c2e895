import binascii
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from posegrid.llm import chat_format, decontaminate, fingerprint, html_text, language_id, shingles, span_dedup

CHAT = st.lists(st.sampled_from(list("\\#</turn>\n:=aé ") + ["###", "</turn>", "\n</turn>\n", "### User:\n", "\\n", "\\#"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.sampled_from(["user", "assistant", "User", "="]), CHAT), CHAT)
def test_chat_grammar_round_trip(role, text):
    segment, _, a, b = chat_format.render(role, text)
    other = chat_format.render("user", "x")[0]
    assert chat_format.parse(segment + other) == [(role, text), ("user", "x")]
    assert chat_format.unescape(segment[a:b]) == text


def test_chat_query_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "### x </turn>"), (None, 0, None, "n"),
            (2, None, "assistant", "a" * 50_000), (2, None, "assistant", "a" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    turns = "user\nhi\nassistant\n\nassistant\n### x </turn>\n"
    assert got[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert (got[1].n_turns, got[1].loss_chars) == (3, 13) and got[None].n_turns == 1
    assert got[2].loss_sha256 == hashlib.sha256(b"a" * 100_000).hexdigest()
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).count() == 0


WORDS = st.lists(st.sampled_from(["a", "B", "b", "cc", "d\u00a0d", "É"]), max_size=12).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(WORDS, max_size=5), st.integers(1, 5))
def test_shingle_sets(texts, size):
    import re

    for text, got in zip(texts, shingles.shingles(texts, size)):
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))
        want = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        assert len(got) == len(want) and (np.diff(got.astype(object)) > 0).all()


def test_equal_shingles_hash_alike_anywhere():
    a, b = shingles.shingles(["x y z w", "q q q x Y z w v"], 4)
    assert set(a) <= set(b)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.lists(st.integers(0, 2**64 - 1), max_size=60))
def test_bottom_k_merges(a, b):
    sketch = lambda x: np.unique(np.array(x, dtype=np.uint64))[:16]
    assert (fingerprint.merge(sketch(a), sketch(b), 16) == sketch(a + b)).all()


def test_bottom_k_estimates():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    a, b = np.unique(base[:2000])[:512], np.unique(base[1000:])[:512]
    assert abs(fingerprint.resemblance(a, b, 512) - 1 / 3) < 0.08
    assert abs(fingerprint.containment(a, b, 512) - 1 / 2) < 0.12
    assert abs(fingerprint.distinct_count(a, 512) / 2000 - 1) < 0.15
    assert (fingerprint.from_text(fingerprint.to_text(a)) == a).all()


@pytest.mark.parametrize("parts", ["1", "4", "13"])
def test_fingerprint_successors(spark, parts):
    rows = [(7, "g h i j k l"), (None, "first of all"), (2, None), (2, "b"), (5, "e" * 100_001), (5, "e"), (9, ""), (7, "g h i j k l")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    got = fingerprint.edited_likeness(df).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        want.append((doc_id, len(text), hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got)
    assert fingerprint.edited_likeness(df.limit(0)).count() == 0


def test_language_held_out_and_rejects(spark):
    import random

    rng, rows = random.Random(2), []
    for i in range(300):
        lang, words = rng.choice([("en", "the of and with house"), ("de", "der und nicht über haus")])
        rows.append((i, " ".join(rng.choice(words.split()) for _ in range(30)), lang))
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "123 !!", "en"), (None, "the house of", None), (1003, "der und", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(df.where("doc_id % 3 <> 1 or doc_id is null"))
    got = language_id.predict(df, model).collect()
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == lang for i, _, lang in rows[:300])
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, None, 1003)] == ["und", "und", "und", "en", "de"]
    assert all(0 <= r.score <= 1 for r in got)
    assert language_id.keep_identified(df, model).count() == 302
    empty = language_id.train(df.limit(0))
    assert {r.lang_pred for r in language_id.predict(df, empty).collect()} == {"und"}
    held = df.select(language_id.held_out(df.doc_id).alias("h"), "doc_id").collect()
    assert all(r.h == (r.doc_id is not None and binascii.crc32(str(r.doc_id).encode()) % 3 == 1) for r in held)


def distance_within(item, text):
    """Least edits of the item against any stretch of the text (plain DP)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        now = [i + 1]
        for j, x in enumerate(text):
            now.append(min(row[j] + (c != x), row[j + 1] + 1, now[j] + 1))
        row = now
    return min(row)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_decontamination_loses_nothing(data):
    import random

    rng = random.Random(data.draw(st.integers(0, 10**6)))
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n)).strip()
    items = [decontaminate.normalise(make(rng.randrange(60, 160))) for _ in range(3)]
    index = decontaminate.Index(list(enumerate(items)))
    texts = []
    for item in items:
        chars = list(item)
        for _ in range(rng.randrange(0, 12)):
            k = rng.randrange(len(chars))
            chars[k : k + 1] = rng.choice([[], ["x"], [chars[k], "y"]])
        texts.append(decontaminate.normalise(make(50) + " " + "".join(chars) + " " + make(50)))
    found = {(t, i): e for t, i, e, *_ in index.matches(texts)}
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            want = distance_within(item, text)
            budget = int(index.budget[i])
            assert ((t, i) in found) == (want <= budget)
            if want <= budget:
                assert found[t, i] == want


def test_decontamination_rows(spark):
    item = "An item about the long river that runs past nine old towns, and no more."
    docs = spark.createDataFrame(
        [(1, f"x {item.upper()} y"), (2, None), (3, ""), (None, item), (4, "clean words " * 9000), (5, item.replace("river", "rivers")), (5, item)],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame([(7, item), (8, None), (9, "tiny"), (10, item)], "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id, r.edits) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == [("1", 7, 0), ("1", 10, 0), ("5", 7, 0), ("5", 7, 1), ("5", 10, 0), ("5", 10, 1), ("None", 7, 0), ("None", 10, 0)]
    assert sorted(str(r.doc_id) for r in decontaminate.keep_clean(docs, bench).collect()) == ["2", "3", "4"]
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


PASSAGE = (
    "The first of the lines is long enough. Then comes another one of some words. A third one follows it here. "
    "And the last one of the passage ends."
)


def brute_repeats(rows):
    """All occurrences of runs but the first, by a plain dictionary."""
    at = {}
    for doc_id, text in rows:
        for digest, first, last in span_dedup.runs(text or ""):
            at.setdefault(digest, set()).add((doc_id, first, last))
    return {x for places in at.values() for x in places if x[:2] > min(p[:2] for p in places)}


def test_span_dedup_against_brute_force(spark):
    rows = [(i, f"Own words number {i} open this. {PASSAGE} Own words {i * 7} close it well.") for i in range(1, 40)]
    rows += [(50, None), (51, ""), (52, PASSAGE), (53, f"cut in the middle {PASSAGE}"), (54, "word " * 30_000), (54, "word " * 30_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows] + [(None, PASSAGE, 2)], "doc_id long, text string, first int")
    got = {(r["doc_id"], r["first"], r["last"]) for r in span_dedup.repeated_spans(df.repartition(5)).collect()}
    assert got == brute_repeats(set(rows))
    left = {r.doc_id: r for r in span_dedup.remove_repeats(df).where("doc_id is not null").collect()}
    assert 52 not in left and PASSAGE in left[1].text and left[50].text is None and left[51].text == ""
    assert left[2].text.split() == "Own words number 2 open this. Own words 14 close it well.".split()
    assert left[53].text.startswith("cut in the middle The first")
    assert span_dedup.remove_repeats(df).where("doc_id is null").count() == 1
    assert span_dedup.remove_repeats(df.limit(0)).count() == 0 and span_dedup.stripped(df.limit(0)).count() == 0


def test_passages_of_over_fifty_words_hold_a_run():
    import random

    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))
    for _ in range(300):
        lengths = rng.choice([[21, 15, 15], [24, 27], [27, 24], [40, 11], [51], [30, 10, 11], [17, 17, 17], [5, 23, 23]])
        passage = " ".join(f"{words(n)}." for n in lengths)
        texts = [f"{words(rng.randrange(1, 40))} {passage} {words(rng.randrange(1, 40))}" for _ in range(2)]
        shared = set.intersection(*({digest for digest, _, _ in span_dedup.runs(t)} for t in texts))
        assert shared, lengths


@pytest.mark.parametrize("space", [" ", "\t", "\u00a0", "\u2003"])
def test_long_texts_are_cut_whatever_parts_their_words(space):
    words = [f"w{i * 7919 % 1000}" for i in range(400)]
    a, b = (space.join([f"{x}{k}" for k in range(90)] + words[100:200] + [f"{x}{k}z" for k in range(50)]) for x in "pq")
    shared = {h for h, _, _ in span_dedup.runs(a)} & {h for h, _, _ in span_dedup.runs(b)}
    assert shared and len(span_dedup.sentences(a)) == len(span_dedup.sentences(a.replace(space, " ")))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=25))
def test_runs_cover_all_that_any_run_covers(lengths):
    text = " ".join(" ".join(f"w{i}x{k}" for k in range(n)) + "." for i, n in enumerate(lengths))
    held = [len(s.split()) for s in span_dedup.sentences(text)]
    enough = lambda i, j: sum(held[i : j + 1]) >= 27 or (j - i >= 2 and sum(held[i : j + 1]) >= 12)
    every = [(i, j) for i in range(len(held)) for j in range(i, len(held)) if enough(i, j)]
    found = {(i, j) for _, i, j in span_dedup.runs(text)}
    assert found <= set(every)
    for p, q in every:
        inside = {k for i, j in found if p <= i and j <= q for k in range(i, j + 1)}
        assert inside == set(range(p, q + 1))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(list("ab. !?\n\t\"é")), max_size=80).map("".join))
def test_sentences_make_up_the_text(text):
    parts = span_dedup.sentences(text)
    assert "".join(parts) == (text if text.strip() else "") and all(p.strip() for p in parts)


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ("<p>a<p>b", "a\n\nb"),
        ("<ul><li>x<li>y<ol start=3><li>z</ol></ul>", "- x\n- y\n  3. z"),
        ("<table><tr><td>a<td>bbb<tr><th>cccc<td>d</table>", "a     bbb\ncccc  d"),
        ("a <b>b</b>\n  c<br>d", "a b c\nd"),
        ("<pre>  x\n   y</pre>", "  x\n   y"),
        ("<div hidden>n</div><div style='visibility:hidden'>n<i style='visibility:visible'>y</i></div>", "y"),
        ("<title>t</title><style>s</style><script>if(a<b)</script>body &amp;lt; &copy;", "body &lt; ©"),
        ("<dl><dt>t<dd>d</dl><select><option>1<option>2</select>", "t\nd\n\n1\n2"),
        ("a<!-- x > y -->b</span></p>c", "ab\n\nc"),
        ("", ""),
    ],
)
def test_html_layout(markup, text):
    assert html_text.extract(markup) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(list("<>/ab\"'=! ") + ["<p>", "</p>", "<td>", "<table>", "<li>", "</ul>", "<ul>", "<!--", "<a href="]), max_size=60).map("".join))
def test_html_takes_any_markup(markup):
    html_text.extract(markup)


def test_html_rows(spark):
    rows = [(1, "<div>" * 20_000 + "x", "u"), (None, None, "u"), (2, "", None), (2, "", None), (3, "<p>" + "w " * 60_000, "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((str(r.page_id), len(r.text)) for r in html_text.page_texts(df).collect())
    assert got == [("1", 1), ("2", 0), ("2", 0), ("3", 119_999), ("None", 0)]
    assert html_text.page_texts(df.limit(0)).count() == 0
