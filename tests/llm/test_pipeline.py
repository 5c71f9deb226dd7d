import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from starsync.llm import packing, repeats, secrets, toxicity
from tests.llm.test_passages import plain as plain_passages
from tests.llm.test_repeats import plain as plain_repeats
from tests.llm.test_secrets import plain_base
from tests.llm.test_similar import brute_kept
from tests.llm.test_tokens import gapless


def test_pipeline_equals_plain_versions(spark, sf_dir):
    from tokenizers import Tokenizer

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = {r.doc_id: r._score for r in toxicity.with_scores(
        documents, toxicity.train(documents, labels), ["doc_id"]).collect()}
    docs = sorted((r.doc_id, r.text) for r in documents.collect() if scores[r.doc_id] < 0.7)
    left = set(brute_kept(docs))
    docs = [d for d in docs if d[0] in left]
    assert 0 < len(docs) < documents.count()
    docs = [(i, secrets.redacted(t, "[SECRET]")) for i, t in plain_passages(docs).items()]
    assert not any(plain_base(t) for _, t in docs)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for doc_id, text in docs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        for piece, (a, n) in enumerate(packing.cut(len(ids), 2048)):
            want[doc_id, piece, a, n, zlib.crc32(np.array(ids[a:a + n], "<u4").tobytes())] += 1
    rows = __spark_entry__.queries()["pipeline"](spark, sf_dir).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    gapless([(r.sequence_id, r.offset, r.length) for r in rows], 2048)


def test_stages_take_any_row(spark, tricky, no_docs, sf_dir):
    for start in (tricky, no_docs):
        docs = start
        for name, function in corpus_pipeline.STAGES[:-1]:
            before = {r[5:] for r in docs.collect()}
            docs = spark.createDataFrame(
                function(spark, docs, sf_dir).collect(), docs.schema)
            assert docs.columns == start.columns
            assert {r[5:] for r in docs.collect()} <= before  # the caller's own columns, as they were
            bad = docs.where(~F.col("n_chars").eqNullSafe(F.length("text").cast("long")) & F.col("text").isNotNull())
            assert bad.count() == 0
        last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert last.count() == docs.count()


def test_plain_versions_agree():
    docs = [(1, "é" * 500), (2, "x" + "é" * 500)]
    assert [n for _, _, n, _, _ in plain_repeats(docs)] == [1000, 1000]
    assert plain_passages(docs) == {1: "", 2: "x"}
    assert repeats.LENGTH == 400
