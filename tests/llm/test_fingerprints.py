import hashlib
import random

import numpy as np

from starsync.llm import fingerprints
from starsync.llm.queries import QUERIES


def shingle_set(text):
    words = (text or "").encode().split()
    k = min(5, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs):
    """Rows of the query against documents [(doc_id, text)] with distinct ids."""
    docs = sorted((i, t or "") for i, t in docs)
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) and got.keys() == {i for i, _ in docs}
    errors = []
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        r, n = got[i], len(text) // 4
        want = text[:len(text) - n] + after[:n]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        errors += [r.near_edited - jaccard(text, want), r.near_next - jaccard(text, after)]
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)
    assert np.mean(np.abs(errors)) < 0.06 and np.max(np.abs(errors)) < 0.35
    texts = {}
    for i, text in docs:
        assert texts.setdefault(text, got[i].fingerprint) == got[i].fingerprint


def test_query_matches_a_plain_version(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op5_fingerprints"](spark, sf_dir).collect(), docs)


def test_empty_ranges_and_single_documents(spark, no_docs, tricky):
    assert fingerprints.with_edits(no_docs).count() == 0
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    r = fingerprints.with_edits(one).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b c d e f a b").hexdigest()
    check(fingerprints.with_edits(spark.createDataFrame(
        [(i, t) for i, t in enumerate(["", None, "x", "a b", "a b c d e f g h i", " ", "é" * 9])],
        "doc_id long, text string")).collect(),
        list(enumerate(["", None, "x", "a b", "a b c d e f g h i", " ", "é" * 9])))
    rows = fingerprints.with_edits(tricky).collect()
    assert len(rows) == tricky.count()
    assert len({r.fingerprint for r in rows if r.doc_id == 1}) == 1


def test_long_texts_are_taken_whole():
    signer = fingerprints.Signer()
    rng = random.Random(2)
    words = [f"w{rng.random()}" for _ in range(9000)]
    a, b = " ".join(words), " ".join(words[:8000])
    assert abs(fingerprints.alike(signer.sign(a), signer.sign(b)) - jaccard(a, b)) < 0.2


def test_near_classes_find_verified_near_duplicates(spark, tricky, no_docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    docs, want = [], {}
    for group in range(12):
        words = [word() for _ in range(200)]
        for copy in range(rng.randrange(1, 6)):
            own = list(words)
            for _ in range(copy and 2):  # two changed words: at least 0.9 alike
                own[rng.randrange(200)] = word()
            docs.append((len(docs), " ".join(own)))
            want[docs[-1][0]] = min(want.get(docs[-1][0], len(docs) - 1 - copy), len(docs) - 1 - copy)
        half = words[:120] + [word() for _ in range(80)]  # not alike enough
        docs.append((len(docs), " ".join(half)))
        want[docs[-1][0]] = docs[-1][0]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in fingerprints.near_classes(df).collect()}
    assert got == want
    rows = fingerprints.near_classes(tricky).collect()
    assert len(rows) == tricky.count() and {r.class_id for r in rows if r.doc_id == 1} == {1}
    assert fingerprints.near_classes(no_docs).count() == 0
