"""Quality rules and the quality classifier."""

import re
import zlib
from collections import Counter

import numpy as np

from starsync.llm import quality_model, quality_rules
from starsync.llm.queries import QUERIES
from starsync.llm.textstats import SHAPE, base_counts
from tests.llm.conftest import TRICKY


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) for k in range(3)
               if windows[tuple(words[i:i + 3])] > 1}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered))


def test_counts_match_a_plain_version(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for text in texts + [t for _, t, _, _ in TRICKY] + ["a b a b a b", "x\n \n\nx\nx\r\n", "\x85a\xa0b c"]:
        assert base_counts(text) == slow_counts(text)


def test_rules_take_any_row(spark, tricky, no_docs):
    rows = quality_rules.apply_rules(tricky).collect()
    assert len(rows) == len(TRICKY)
    assert all(r.base_failed and not r.kept for r in rows)
    assert {r.n_words for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert quality_rules.apply_rules(no_docs).count() == 0


def test_cutoffs_follow_the_group(spark):
    def doc(i, source, mark):
        return (i, " ".join(f"w{i}x{k}{mark if k % 2 else ''}" for k in range(60)), "en", source)

    rows = [doc(i, "plain", "") for i in range(300)] + [doc(i, "code", "#") for i in range(300, 600)]
    rows += [doc(900, "plain", "#"), doc(901, "code", "#")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs).collect()}
    # What is usual in one source is not in the other.
    assert not got.pop(900) and all(got.values())


def test_sketch_buckets_keep_their_accuracy(spark):
    values = [(i / 10.0,) for i in range(1, 5001)]
    df = spark.createDataFrame(values, "v double")
    b = df.select(quality_rules.bucket(df.v).alias("bucket"), df.v)
    read = b.select(quality_rules.bucket_value(b.bucket).alias("r"), "v").collect()
    assert max(abs(r.r - r.v) / r.v for r in read) < 0.011


def test_additive_model_learns_shapes_and_pairs():
    rng = np.random.default_rng(5)
    x = rng.random((4000, len(SHAPE)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)  # visible in a pair only
    model = quality_model.fit(x[:3000], y[:3000])
    right = ((quality_model.predict(model, x[3000:]) >= 0.5) == y[3000:]).mean()
    assert right > 0.9
    assert (1, 0) in [(a, b) for a, b, _ in model["pairs"]]


def test_classifier_takes_any_row(spark, tricky, no_docs, labels, no_labels):
    rows = quality_model.score(tricky, labels).collect()
    assert len(rows) == len(TRICKY) and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert {r.score for r in quality_model.score(tricky, no_labels).collect()} == {0.5}
    assert quality_model.score(no_docs, labels).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    got = QUERIES["op10_quality_classifier"](spark, sf_dir).where("held_out").join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
