import corpus_pipeline
from posegrid.llm import byte_bpe, decontaminate, language_id, pretoken, span_dedup
from tests.llm.test_near_dup import brute
from tests.llm.test_text_ops import brute_repeats

import hashlib

import public_tokenizers
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    preds, scores = model.score([t for _, t in rows])
    rows = [r for r, p, s in zip(rows, preds, scores) if p != "und" and s >= 0.5]
    component, _ = brute(rows, 5)
    rows = [r for r in rows if component[r[0]] == r[0]]
    gone = {}
    for doc_id, first, last in brute_repeats(rows):
        gone.setdefault(doc_id, []).append({"first": first, "last": last})
    left = [(d, span_dedup.strip(t, gone[d])[0] if d in gone else t) for d, t in rows]
    left = [(d, t) for d, t in left if t.strip() or d not in gone]
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.Index(list(enumerate(items)))
    bad = {m[0] for m in index.matches([decontaminate.normalise(t) for _, t in left])}
    assert all(k in bad for k, (_, t) in enumerate(left) if any(i in decontaminate.normalise(t) for i in items))
    left = [r for k, r in enumerate(left) if k not in bad]
    codec = byte_bpe.codec_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pretoken.kinds_by_tiktoken())
    want = {d: (hashlib.sha256(i).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for (d, t), i in zip(left, codec.encode([t for _, t in left]))}
    got = {r.doc_id: (r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30).withColumn("label", F.lit(1)).withColumn("first", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
