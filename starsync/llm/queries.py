"""The registered queries of this subpackage and their SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession

from starsync.llm import (
    byte_bpe, conversation_repair, decontamination, fingerprints, packing, prefix_trie, quality_model, quality_rules, repeats, secrets, simhash,
    token_counts, toxicity,
)
from starsync.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and whether it passes the base and the adaptive rules."""
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and the decoded bytes of every document."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.components_of(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, from a cache that is empty at first."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that stand elsewhere, too, and how many
    of its words are in passages of over 50 words that do."""
    return repeats.spans(table(spark, sf_dir, "documents"), words=51).drop("spans")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired rows of every damaged conversation."""
    return conversation_repair.digests(table(spark, sf_dir, "conversations"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in windows of benchmark items."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_fingerprints": op5_fingerprints,
    "op6_simhash": op6_simhash,
    "op7_secret_scan": op7_secret_scan,
    "op8_token_counts": op8_token_counts,
    "op9_repeats": op9_repeats,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_decontamination": op12_decontamination,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL = {
    "op1_quality_rules": quality_rules.SQL,
    "op12_decontamination": decontamination.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
