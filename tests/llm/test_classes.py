import random

import numpy as np

from starsync.llm import fingerprints, similar
from tests.llm.test_fingerprints import jaccard


def chains(rng):
    """Texts that are each like the one before, and hardly like those further off."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    out = []
    for _ in range(4):
        words = [word() for _ in range(120)]
        for _ in range(9):
            words = words[7:] + [word() for _ in range(7)]
            out.append(" ".join(words))
    rng.shuffle(out)
    return list(enumerate(out))


def brute_classes(docs):
    """The least id that links of 0.8 between texts that share a band lead to."""
    signer = similar.Signer(similar.LANES)
    bands = [np.frombuffer(signer.sign(t).tobytes(), dtype=np.int64) for _, t in docs]
    least = {i: i for i, _ in docs}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, a in docs:
        for j, b in docs[:i]:
            if (bands[i] == bands[j]).any() and jaccard(a, b) >= 0.8:
                x, y = sorted((root(i), root(j)))
                least[y] = x
    return {i: root(i) for i, _ in docs}


def test_links_that_share_a_band_are_never_lost(spark, monkeypatch):
    monkeypatch.setattr(similar, "FIRST_WIDTH", 1)
    docs = chains(random.Random(2))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.class_id for r in fingerprints.near_classes(df).collect()} == brute_classes(docs)
