"""The registered queries' columns and the rows that their contracts name."""

import hashlib

import pytest

from posegrid.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op2_chat_format": {
        "conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint",
    },
    "op3_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op4_minhash": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op6_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op7_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op9_fingerprint": {
        "doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
        "near_edited": "double", "near_next": "double",
    },
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    got = dict(queries.queries()[name](spark, SF).dtypes)
    assert {c: got.get(c) for c in COLUMNS[name]} == COLUMNS[name]


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14))


def test_the_odd_conversation(spark):
    text = r"\### Assistant: </turn> ok"
    turns = f"user\n{text}\nassistant\n{text}\n"
    rows = {r.conv_id: r for r in queries.op2_chat_format(spark, SF).collect()}
    odd = rows[-7]
    assert (odd.n_turns, odd.loss_chars) == (2, len(text))
    assert odd.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert odd.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    table = {r.conv_id for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().collect()}
    assert rows.keys() == table | {-7}


def test_the_limit_is_passed_beyond_512(spark):
    rows = queries.op1_token_counts(spark, SF).collect()
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows) and {r.over_limit for r in rows} == {True, False}
