import random
from collections import Counter

import numpy as np

import corpus_pipeline
from starsync.llm import repeats


def plain(docs, length=400, words=51):
    """Texts without repeated passages of so many bytes or words, in whole characters."""
    data = [(t or "").encode() for _, t in docs]
    at = [[m.span() for m in repeats._WORD.finditer(d)] for d in data]
    said = [d.split() for d in data]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    heard = Counter(tuple(w[i:i + words]) for w in said for i in range(len(w) - words + 1))
    out = {}
    for (doc_id, text), d, a, w in zip(docs, data, at, said):
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        for i in range(len(w) - words + 1):
            if heard[tuple(w[i:i + words])] > 1:
                gone[a[i][0]:a[i + words - 1][1]] = True
        for i in range(len(d)):  # a character goes only as a whole
            if d[i] & 0xC0 != 0x80:
                end = i + 1
                while end < len(d) and d[end] & 0xC0 == 0x80:
                    end += 1
                gone[i:end] = gone[i:end].all()
        out[doc_id] = text if text is None else bytes(np.frombuffer(d, np.uint8)[~gone]).decode()
    return out


def test_passages_of_51_words_are_cut(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, fifty = text(51), text(50)
    assert len(passage) < 400
    docs = [f"{text(20)} {passage} {text(30)}", f"{text(7)}\n{passage.replace(' ', '  ', 3)} {text(3)}",
            f"{text(9)} {fifty} {text(9)}", f"{text(5)} {fifty} {text(8)}",
            "x" * 450 + " a", "b " + "x" * 450, text(300), None, "", "la " * 120]
    docs += [docs[6][40:900]]
    docs = list(enumerate(docs))
    want = plain(docs)
    assert passage not in want[0] and fifty in want[2]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, df, None).collect()} == want


def test_words_in_passages_that_stand_elsewhere_are_counted(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    one, two, fifty = text(51), text(80), text(50)
    docs = [f"{text(9)} {one} {text(4)} {two}", f"{one}\t{text(5)}", f"{two[:-8]} {text(70)}",
            f"{fifty} {text(3)}", f"{text(4)} {fifty}", "la " * 60, None, "", text(60), one]
    words = [(t or "").split() for t in docs]
    heard = Counter(tuple(w[i:i + 51]) for w in words for i in range(len(w) - 50))
    want = {}
    for n, w in enumerate(words):
        hit = np.zeros(len(w) + 1, dtype=int)
        for i in range(len(w) - 50):
            if heard[tuple(w[i:i + 51])] > 1:
                hit[i:i + 51] = 1
        want[n] = (int(hit.sum()), int((np.diff(hit, prepend=0) == 1).sum()))
    assert want[0] == (130, 2) and want[3] == (0, 0) and want[5] == (60, 1)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    with_words = repeats.spans(df, words=51)
    assert {r.doc_id: (r.n_phrase_words, r.n_phrases) for r in with_words.collect()} == want
    bytes_only = {tuple(r) for r in repeats.spans(df).drop("spans").collect()}
    assert {tuple(r) for r in with_words.drop(
        "spans", "n_phrase_words", "n_phrases").collect()} == bytes_only
