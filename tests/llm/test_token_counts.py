from collections import Counter

import public_tokenizers

from starsync.llm import token_counts
from starsync.llm.queries import QUERIES
from tests.llm.conftest import TRICKY


def library(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t, num_threads=1))
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda t: len(model.encode(t, add_special_tokens=False).ids)


ODD = ["<|endoftext|> a<|startoftext|>b", "don't  I'LL", "ΣΑΣ ΟΔΟΣ İx", "á ́b", "1234 5,6",
       "\x85a b\x1cc", "é" * 700, "x\n\n y"]


def test_counts_equal_the_library(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + ODD
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for name in ("word_bpe_49k.json", "piece_bpe_32k.model"):
        count = library(name)
        got = token_counts.count_tokens(docs, path=public_tokenizers.path(name)).collect()
        assert {r.doc_id: r.n_tokens for r in got} == {i: count(t) for i, t in enumerate(texts)}
        assert {r.doc_id: r.n_bytes for r in got} == {i: len(t.encode()) for i, t in enumerate(texts)}


def test_takes_any_row(spark, tricky, no_docs):
    count = library("word_bpe_49k.json")
    got = token_counts.count_tokens(tricky).collect()
    want = Counter((i, len((t or "").encode()), count(t or ""), count(t or "") > 2048)
                   for i, t, _, _ in TRICKY)
    assert Counter(tuple(r) for r in got) == want
    assert token_counts.count_tokens(no_docs).count() == 0


def test_only_misses_are_encoded(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "c")], "doc_id long, text string")
    token_counts.count_tokens(docs, cache).collect()
    held = spark.read.parquet(cache)
    assert held.count() == 2  # the first two differ in dropped white space only
    more = docs.union(spark.createDataFrame([(4, "d e f")], docs.schema))
    got = token_counts.count_tokens(more, cache).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {1: 2, 2: 2, 3: 1, 4: 3}
    assert spark.read.parquet(cache).count() == 3
    # Another tokenizer has counts of its own.
    version = token_counts.tokenizer_version(public_tokenizers.path(token_counts.TOKENIZER))
    assert {r.version for r in held.collect()} == {version}
    other = public_tokenizers.path("piece_bpe_32k.model")
    token_counts.count_tokens(docs, cache, path=other).collect()
    assert spark.read.parquet(cache).count() == 6  # here white space counts, so three texts differ


def test_query_counts_every_document(spark, sf_dir):
    assert QUERIES["op8_token_counts"](spark, sf_dir).count() == spark.read.parquet(
        f"{sf_dir}/documents.parquet").count()
