"""Benchmark decontamination against a plain version."""

import hashlib
import re
from collections import Counter

import pytest

from starsync.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    """All rows by comparing every window with every place."""
    wins = {}
    for item_id, text in items:
        w = plain_words(text)
        k = min(len(w), d.WINDOW)
        for i in range(len(w) - k + 1) if w else ():
            wins.setdefault(tuple(w[i:i + k]), set()).add(item_id)
    out = Counter()
    for doc_id, text in docs:
        w = plain_words(text)
        hit, found = set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if (t := tuple(w[i:i + k])) in wins:
                    hit |= set(range(i, i + k))
                    found |= wins[t]
        ids = sorted(str(x) for x in found if x is not None)
        out[doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)] += 1
    return out


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda MU."),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa; and then some other words follow"),
    (12, "Same item, twice"), (3, "same ITEM twice!"), (None, "no id here"), (4, None), (5, " ... "), (6, "solo"),
    (7, "two words"), (7, "the seventh again with two texts"), (8, "la la la la la la la la la la la la"),
]
DOCS = [
    (1, "x alpha Beta gamma, delta epsilon zeta eta theta iota kappa lambda mu y"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (3, "kappa " * 30 + "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (4, None), (4, ""), (5, "?!\n"), (6, "Solo"), (6, "Solo"), (7, "two  words, two words two"),
    (8, "same item twice or no-id-here"), (None, "The SEVENTH again with two texts"),
    (9, "la " * 50 + "end"), (10, "naïve ÉCOLE solo \U0001F600 same item twice"),
    (11, "solo " * 20_000), (12, "..same item twice.."), (13, "Zebra soloist same item"),
]


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.createDataFrame(
        [(*r, "x", "y", "z", 7) for r in DOCS], "doc_id long, text string, words string, k1 string, win string, n_hit int")
    items = spark.createDataFrame([(*r, "w") for r in ITEMS], "item_id long, text string, words string")
    return docs.repartition(3), items


def rows(df):
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_leaks_of_tricky_rows(small):
    assert rows(d.leaks(*small)) == plain(DOCS, ITEMS)


def test_blocks_give_the_same(small, monkeypatch):
    monkeypatch.setattr(d, "BLOCK", 5)
    assert rows(d.leaks(*small)) == plain(DOCS, ITEMS)


def test_leaks_of_empty_tables(small):
    docs, items = small
    assert rows(d.leaks(docs.limit(0), items)) == Counter()
    assert rows(d.leaks(docs, items.limit(0))) == plain(DOCS, [])


def test_no_python_on_the_executors(small):
    plan = d.leaks(*small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_leaks_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = rows(d.leaks(docs, items))
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found == want and any(r[5] for r in found)
