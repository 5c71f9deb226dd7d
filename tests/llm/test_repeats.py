import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from starsync.llm import repeats
from starsync.llm.queries import QUERIES
from starsync.llm.run_index import RunIndex
from tests.llm.conftest import TRICKY


def plain(docs, length=400):
    """Rows of the query for documents [(doc_id, text)]."""
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(docs, data):
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
        out.append((doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_index_equals_counting():
    rng = random.Random(5)
    for _ in range(150):
        length = rng.choice([1, 2, 3, 5, 8])
        letters = rng.choice([b"ab", b"abcd", bytes(range(256)), b"\0a"])
        texts = [bytes(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(rng.randrange(1, 8))]
        texts += [texts[0] + b"ab", b"a" * 30] if rng.random() < 0.5 else []
        seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
        index = RunIndex(texts)
        assert index.run_length.sum() == sum(map(len, texts)) + len(texts)
        assert [m.tolist() for m in index.repeated(length)] == [
            [seen[t[i:i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]


def test_repetitive_texts_have_few_runs():
    rng = random.Random(6)
    text = bytes(rng.choice(b"abcdefgh") for _ in range(4000))
    assert len(RunIndex([text[:i] + b"#" + text[i:] for i in range(0, 4000, 100)]).run_symbol) < 40 * 4000 / 15


def documents(rng):
    word = lambda: "".join(rng.choice("abcdefé") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, short = text(150), text(60)[:399]
    docs = [text(rng.randrange(1, 300)) for _ in range(25)]
    docs += [text(40) + passage + text(rng.randrange(30)) for _ in range(12)]  # shared by many
    docs += [text(30) + short + text(30) for _ in range(2)]  # one byte too short to count
    docs += [docs[3], docs[3], docs[4][:-1]]  # copies
    docs += ["ab" * 900, "x" * 399, "x" * 400, "x" * 401, "line one two three\n" * 200, "y" * 9000]
    docs += [passage[:500] + passage[300:900], None, "", docs[5] + docs[6]]
    return list(enumerate(docs))


@pytest.mark.parametrize("crowd", [1024, 3])
def test_equals_a_plain_version(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 20_000)
    docs = documents(random.Random(crowd))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = repeats.spans(df).drop("spans")
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs)


def test_long_texts_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 700)
    docs = documents(random.Random(9))
    rolling = repeats.Rolling(1, 700 + 400)
    for _, text in docs:
        data = (text or "").encode()
        covered = [s for a, b, _, _, _ in repeats.contexts(data, rolling) for s in range(a, b + 1)]
        assert covered == list(range(max(len(data) - 399, 0)))  # each window in one context


def test_query_matches_a_plain_version(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op9_repeats"](spark, sf_dir).collect()), key=str) == plain(docs)


def test_takes_any_row(spark, tricky, no_docs):
    got = repeats.spans(tricky).drop("spans")
    assert sorted(map(tuple, got.collect()), key=str) == plain([(i, t) for i, t, _, _ in TRICKY])
    assert repeats.spans(no_docs).count() == 0
    left = repeats.remove(tricky)
    assert left.columns == tricky.columns
    texts = {r.doc_id: r.text for r in left.where("doc_id IN (2, 5, 8)").collect()}
    assert texts == {2: None, 5: "", 8: TRICKY[-1][1]}
    assert repeats.remove(no_docs).count() == 0


def test_cut_texts_stay_text():
    data = "aé日b".encode()
    assert repeats.whole_characters(data, [(2, 5)]) == []
    assert repeats.without(data, repeats.whole_characters(data, [(1, 6)])).decode() == "ab"


def test_index_takes_words_as_symbols():
    """Codes of words are symbols of their own: repeats are counted from word to word."""
    rng = random.Random(8)
    for length in (1, 2, 4):
        texts = [np.array([rng.choice([3, 2**63 + 5, 2**64 - 1, 7]) for _ in range(rng.randrange(1, 40))], np.uint64)
                 for _ in range(6)]
        seen = Counter(t[i:i + length].tobytes() for t in texts for i in range(len(t) - length + 1))
        assert [m.tolist() for m in RunIndex(texts).repeated(length)] == [
            [seen[t[i:i + length].tobytes()] > 1 for i in range(len(t) - length + 1)] for t in texts]
