"""A corpus pipeline: raw documents in, packed token sequences out.

Each stage works on all rows that the one before it kept.  Its result is written as Parquet in the
session's shared folder and read again, so a stage starts from stored rows whatever happens to the
executors.  All stages but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsync.llm import packing, repeats, secrets, similar, toxicity
from starsync.llm.common import table
from starsync.session import stage

#: Documents that score at least this much are rejected as toxic.
TOXIC = 0.7
#: Words of a passage that is not to stand in two places.
PASSAGE = 51


def _measured(docs: DataFrame) -> DataFrame:
    """The length column follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity cutoff; the model learns from the labels of the training fold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model, TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links of a five-word Jaccard similarity of 0.8 or more: the
    one with the least id.

    SimHash fingerprints within two bits are linked first, as ``op6`` does, and verified; MinHash bands
    find the similar documents whose fingerprints differ in more bits.
    """
    return similar.deduplicate(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 400 bytes, or of over 50 words, that stand elsewhere, too."""
    return _measured(repeats.remove(docs, words=PASSAGE))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose secrets are replaced by a mark."""
    return _measured(secrets.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("secrets", hide_secrets),
    ("packing", pack),
]

#: SQL cannot express these stages; the tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
