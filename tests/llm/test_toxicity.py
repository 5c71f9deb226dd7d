import numpy as np

from starsync.llm import toxicity
from starsync.llm.queries import QUERIES
from tests.llm.conftest import TRICKY


def test_label_model_finds_good_and_repeated_voters():
    rng = np.random.default_rng(7)
    truth = rng.random(6000) < 0.3
    flip = lambda p: np.where(rng.random(6000) < p, ~truth, truth)
    good, fair, third = flip(0.1), flip(0.25), flip(0.2)
    poor = rng.random(6000) < 0.5
    votes = np.column_stack([good, fair, third, poor, poor, poor, poor]).astype(int) * 2 - 1
    start = np.clip(votes[:, :3].mean(axis=1) / 2 + 0.5, 0.1, 0.9)
    posterior = toxicity.label_model(votes, start)
    assert ((posterior > 0.5) == truth).mean() > 0.88
    parent = toxicity.dependency_forest(toxicity._one_hot(votes), posterior)
    assert sum(parent[3:] >= 0) == 3 and all(parent[:3] == -1)  # the copies hang together


def test_longest_stem_counts_once():
    hits = toxicity.Hits(["abc", "abcd", "xy$"])
    assert hits.counts("abcde ABC xy xyz") == (4, {1: 1, 0: 1, 2: 1})


def test_takes_any_row(spark, tricky, no_docs, labels, no_labels):
    for given in (labels, no_labels):
        rows = toxicity.score(tricky, given).collect()
        assert len(rows) == len(TRICKY) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(no_docs, labels).count() == 0
    insult = spark.createDataFrame([(1, "you idiot and moron"), (2, "a kind word")], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in toxicity.score(insult, no_labels).collect()}
    assert got == {1: 1, 2: 0}


def test_held_out_accuracy(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.1")
    got = QUERIES["op2_toxicity"](spark, sf_dir).where("held_out").join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    marked = [r for r in got if r.predicted]
    toxic = [r for r in got if r.toxic]
    assert sum(r.toxic for r in marked) >= 0.95 * len(marked)
    # About a fifteenth of the toxic documents here were overwritten by junk after labelling.
    assert sum(r.predicted for r in toxic) >= 0.88 * len(toxic)


def test_sample_has_one_row_of_an_id(spark):
    from starsync.llm.common import labelled_sample

    docs = spark.createDataFrame([(2, f"text {i}") for i in range(500)] + [(i, "other") for i in range(3, 60)],
                                 "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 20).collect()
    assert len(rows) == 20 == len({r.doc_id for r in rows})
    assert len(labelled_sample(docs, labels, "toxic", 1000).where("doc_id = 2").collect()) <= 1
