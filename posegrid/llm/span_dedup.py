"""Operator 8, substring dedup by sliding sentence spans.

A sentence ends after ``.``, ``!`` or ``?`` (and closing marks) before white
space, after an ideographic stop, and at a line end.  Ideographs and kana count
as a word each.  One of more than ``LONG`` words is also cut after
words chosen by their own and their predecessor's hash (the least of every
``WINDOW``), so that cuts fall alike in any context.  A run holds at least ``RUN`` sentences and ``LEAST_WORDS`` words,
or ``ENOUGH`` words in fewer sentences.  The shortest run from every sentence
and the shortest up to every sentence are hashed (words lower-cased, white space
squeezed; 96 bits): together they cover what any run covers.  Over all texts,
the first occurrence of a run is the one with the least (id, place); the
sentences of every other occurrence go.  A repeated passage loses at most its
first and its last ``LONG`` words to the sentences around it, the last ones only
if it stops within a sentence: one of over 50 words up to a sentence end always
holds a run.

A task sends a row for the first occurrence it knows of a run and marks the
others itself: it keeps the runs that repeat within a block of texts from block to
block (the latest ``KNOWN``; one forgotten costs a row more).  So a run that a third
of all texts hold takes a few rows a task in the one shuffle by run, and what is
marked already is spread over all partitions.

Null or empty texts have no sentences and stay; rows with a null id stay and
neither hold first occurrences nor lose sentences; rows that repeat as a whole
(id and text) count as one and stay alike; of rows that share an id only, the one
whose text has the lesser hash comes first.  Other columns pass through
``remove_repeats``.  Empty tables stay empty.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import edit_rows, map_blocks, unused

RUN, LEAST_WORDS, LONG, ENOUGH, WINDOW = 3, 12, 24, 27, 16
#: Runs that a task keeps from block to block, twice over.
KNOWN = 1 << 16
_END = re.compile(r"[.!?]+[\"'”’)\]]*(?=\s)|[。！？]+[”’」』）]*|\n")
_WIDE = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]")
_WORD = re.compile(r"\S+")
SPANS = "h long, g int, doc_id long, rid long, first int, last int, again boolean"


def sentence_ends(text: str) -> list[int]:
    """End offsets of the sentences; each begins where the last one ended, so
    the sentences with the white space around them make up the whole text."""
    ends: list[int] = []
    at = 0
    for stop in [*(m.end() for m in _END.finditer(text)), len(text)]:
        part = text[at:stop]
        if not part.strip():
            if ends:  # white space belongs to the sentence before
                ends[-1] = stop
                at = stop
            continue
        if len(part.split()) > LONG:
            spans = [m.span() for m in _WORD.finditer(part)]
            words = [part[a:b].lower() for a, b in spans[:-1]]
            ranks = [_digest(f"{a} {b}") for a, b in zip(["", *words], words)]
            ends += [at + spans[k][1] for k in _least_places(ranks)]
        ends.append(stop)
        at = stop
    return ends


def _least_places(ranks: list[bytes]) -> list[int]:
    """The place of the least rank of every ``WINDOW`` in turn (the one before,
    if it is as small), so that no two are further apart."""
    out = [-1]
    for stop, rank in enumerate(ranks):
        begin = stop - WINDOW + 1
        if begin < 0:
            continue
        if out[-1] < begin:
            out.append(min(range(stop, begin - 1, -1), key=ranks.__getitem__))
        elif rank < ranks[out[-1]]:
            out.append(stop)
    return out[1:]


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=12).digest()


def sentences(text: str) -> list[str]:
    ends = sentence_ends(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def runs(text: str) -> list[tuple[bytes, int, int]]:
    """(digest, first sentence, last sentence) of the runs of a text."""
    norm = [" ".join(s.lower().split()) for s in sentences(text)]
    n_words = [s.count(" ") + 1 + (0 if s.isascii() else len(_WIDE.findall(s))) for s in norm]
    found: set[tuple[int, int]] = set()
    first, held = 0, 0
    for last, n in enumerate(n_words):
        held += n
        ends = -1  # the last start from which a run ends here
        while first <= last and (held >= ENOUGH or last - first + 1 >= RUN and held >= LEAST_WORDS):
            found.add((first, last))  # the shortest from its start
            ends = first
            held -= n_words[first]
            first += 1
        if ends < 0 and found:  # no start is new: the shortest that ends here begins before
            words, ends = held, first
            while ends > 0 and not (words >= ENOUGH or last - ends + 1 >= RUN and words >= LEAST_WORDS):
                ends -= 1
                words += n_words[ends]
            found.add((ends, last))
    return [(_digest("\n".join(norm[i : j + 1])), i, j) for i, j in sorted(found)]


def _span_rows(docs: DataFrame) -> DataFrame:
    def make():
        young: dict[bytes, tuple] = {}  # the least place known of runs that repeat
        old: dict[bytes, tuple] = {}

        def run(cols: dict[str, list]) -> dict[str, list]:
            nonlocal young, old
            rows: list[tuple] = []
            least: dict[bytes, tuple] = {}
            digests: list[bytes] = []
            for doc_id, rid, text in zip(cols["doc_id"], cols["rid"], cols["text"]):
                for digest, first, last in runs(text or ""):
                    digests.append(digest)
                    rows.append((doc_id, rid, first, last))
                    place = (doc_id, rid, first)
                    if digest not in least:
                        earlier = young.get(digest) or old.get(digest)
                        least[digest] = min(place, earlier) if earlier else place
                        if earlier:
                            young[digest] = least[digest]
                    else:
                        least[digest] = young[digest] = min(place, least[digest])
            again = [r[:3] > least[d] for d, r in zip(digests, rows)]
            if len(young) > KNOWN:
                young, old = {}, young
            raw = np.frombuffer(b"".join(digests), dtype=[("h", "<i8"), ("g", "<i4")])
            return {
                "h": raw["h"],
                "g": raw["g"],
                "doc_id": [r[0] for r in rows],
                "rid": [r[1] for r in rows],
                "first": [r[2] for r in rows],
                "last": [r[3] for r in rows],
                "again": again,
            }

        return run

    return map_blocks(docs, make, SPANS)


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rid, first, last) of every occurrence of a run but its first.

    ``rid`` is a hash of the text: it tells apart rows that share an id.
    """
    cols = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("rid"), F.col(text_col).alias("text")
    ).where("doc_id is not null")
    rows = _span_rows(cols)
    # occurrences already known to repeat travel under keys of their own
    key = F.when(F.col("again"), F.xxhash64("h", "doc_id", "rid", "first")).otherwise(F.col("h"))
    held = Window.partitionBy("key", "g", "again")
    marked = rows.withColumn("key", key).withColumn("least", F.min(F.struct("doc_id", "rid", "first")).over(held))
    return marked.where("again or struct(doc_id, rid, first) > least").select("doc_id", "rid", "first", "last")


def _covered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ranges of sentences to remove, a row a text that loses any."""
    return (
        repeated_spans(docs, id_col=id_col, text_col=text_col)
        .groupBy("doc_id", "rid")
        .agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    )


def strip(text: str, ranges: list[dict]) -> tuple[str, int, int]:
    """(text without the sentences of the ranges, sentences, sentences removed)."""
    parts = sentences(text)
    gone = np.zeros(len(parts) + 1, dtype=np.int64)
    for r in ranges:
        gone[r["first"]] += 1
        gone[r["last"] + 1] -= 1
    drop = np.cumsum(gone)[:-1] > 0
    return "".join(p for p, d in zip(parts, drop.tolist()) if not d), len(parts), int(drop.sum())


_STRIPPED = "doc_id long, rid long, text string, n_sentences int, n_removed int"


def stripped(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts that lose sentences: what is left of them, and counts."""
    covered = _covered(docs, id_col, text_col)
    cols = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("rid"), F.col(text_col).alias("text")
    )

    def make():
        def run(cols: dict[str, list]) -> dict[str, list]:
            done = [strip(t, r) for t, r in zip(cols["text"], cols["ranges"])]
            return {
                "doc_id": cols["doc_id"],
                "rid": cols["rid"],
                "text": [d[0] for d in done],
                "n_sentences": [d[1] for d in done],
                "n_removed": [d[2] for d in done],
            }

        return run

    return map_blocks(cols.join(covered, ["doc_id", "rid"]), make, _STRIPPED)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns, with repeated spans removed; a text of which
    nothing is left goes."""
    own_id, rid, ranges = (unused(c, docs) for c in ("covered_id", "covered_rid", "covered_ranges"))
    covered = _covered(docs, id_col, text_col).select(
        F.col("doc_id").alias(own_id), F.col("rid").alias(rid), F.col("ranges").alias(ranges)
    )
    joined = docs.join(
        covered, (F.col(id_col).cast("long") == F.col(own_id)) & (F.xxhash64(text_col) == F.col(rid)), "left"
    ).drop(own_id, rid)

    def cut(texts: list, ranges: list) -> tuple[list, list[bool]]:
        left = [t if r is None else strip(t, r)[0] for t, r in zip(texts, ranges)]
        return left, [r is None or bool(x.strip()) for x, r in zip(left, ranges)]

    return edit_rows(joined, cut, text_col, ranges)
