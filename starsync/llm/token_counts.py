"""Token counts through a cache keyed by digests.

The cache is a Parquet folder of (version, digest, n_tokens): ``version`` is the digest of the
tokenizer's file and library, ``digest`` that of a text after a normalisation that cannot change
its count (white space that the tokenizer drops is reduced).  Documents are joined to it by digest.
Only distinct texts that it lacks are encoded: each task first leaves out its own repeats, one
shuffle brings the texts of a digest together, and the new counts are appended.  Then every
document takes its count from the cache.  A digest that a third of all rows share is one row for
each task in the shuffle of texts, and the joins of short rows split it (adaptive skew join).

A writer that dies leaves no part of its append behind; one that appends twice adds equal rows,
which readers reduce to one.

Defined cases: a null text is an empty one (0 bytes, 0 tokens); repeated rows are counted each; an
empty table gives no rows and appends nothing of substance; other columns are ignored.
"""

import hashlib
from importlib.metadata import version

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsync.llm.chunks import Memo, kept
from starsync.llm.common import map_texts
from starsync.session import stage, work_dir

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048

CACHE = "version string, digest binary, n_tokens long"


def tokenizer_version(path) -> str:
    """Digest of all that decides a count: the tokenizer's file and the library that reads it."""
    library = "sentencepiece" if str(path).endswith(".model") else "tokenizers"
    with open(path, "rb") as data:
        return hashlib.sha256(f"{library} {version(library)} ".encode() + data.read()).hexdigest()


def normalised(path, text="text"):
    """The text that is digested and encoded: equal ones have equal counts."""
    whole = F.coalesce(F.col(text), F.lit(""))
    if str(path).endswith(".model"):
        return whole
    return F.btrim(F.regexp_replace(whole, r"[ \t\n\r\x0B\f]+", " "))


class Counter:
    """Counts tokens; built once per worker."""

    def __init__(self, path):
        self.whole = str(path).endswith(".model")
        if self.whole:
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            self.model.no_padding()
            self.model.no_truncation()
            self.words = Memo(lambda words: [
                len(e.ids) for e in self.model.encode_batch_fast(words, add_special_tokens=False)])

    def counts(self, texts) -> list:
        if self.whole:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        # The tokenizer drops white space, so a text's tokens are those of its words.
        split = [t.split(" ") for t in texts]
        self.words.learn(set().union(*split))
        find = self.words.young.__getitem__
        return [sum(map(find, words)) for words in split]


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) that the cache holds for a tokenizer; none if the folder is new."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    held = spark.read.schema(CACHE).parquet(cache)
    return held.where(F.col("version") == tokenizer).groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens"))


def _first_of_task():
    """Drops texts whose digest this task has had before."""
    seen = set()

    def fn(rows):
        keep = []
        for i, d in enumerate(rows["digest"]):
            if d not in seen:
                seen.add(d)
                keep.append(i)
        return {c: [v[i] for i in keep] for c, v in rows.items()}

    return fn


def encode_misses(docs: DataFrame, keyed: DataFrame, cache: str, path, tokenizer: str):
    """Append the counts of the distinct texts of ``docs`` that the cache lacks."""
    spark = docs.sparkSession
    missing = keyed.select("digest").distinct().join(
        read_cache(spark, cache, tokenizer), "digest", "left_anti")
    texts = map_texts(
        docs.select(digest(path).alias("digest"), normalised(path).alias("text")),
        _first_of_task, "digest binary, text string")

    def make():
        counter, first = kept(("counter", path), lambda: Counter(path)), _first_of_task()

        def fn(rows):
            rows = first(rows)  # what several tasks have sent
            return {"digest": rows["digest"], "n_tokens": counter.counts(rows["text"])}

        return fn

    # Digests are small next to the texts of the same partition, so they are the hashed side.
    counted = map_texts(
        texts.join(missing.hint("shuffle_hash"), "digest", "left_semi"), make,
        "digest binary, n_tokens long")
    counted.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")).select(
        F.lit(tokenizer).alias("version"), "digest", "n_tokens",
    ).write.mode("append").parquet(cache)


def digest(path):
    return F.unhex(F.sha2(normalised(path).cast("binary"), 256))


def count_tokens(docs: DataFrame, cache: str = None, path=None, limit=LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row for each row of ``docs``.

    ``cache`` is a folder all executors can reach; without it a new one under the session's shared
    folder is used, so that every distinct text is encoded.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path(TOKENIZER)
    cache = cache or work_dir(spark, "token-cache")
    tokenizer = tokenizer_version(path)
    keyed = stage(docs.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        digest(path).alias("digest")), "token-digests")
    encode_misses(docs, keyed, cache, path, tokenizer)
    return keyed.join(read_cache(spark, cache, tokenizer), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
