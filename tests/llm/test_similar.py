import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starsync.llm import similar, simhash


def shingle_set(text):
    words = (text or "").encode().lower().split()
    k = min(5, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute_kept(docs):
    """Ids left of documents [(doc_id, text)] with distinct ids: the least of each component."""
    docs = sorted(docs)
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [d for i, (d, _) in enumerate(docs) if root(i) == i]


def families(rng):
    """Edited copies, chains whose ends are unlike, a common passage, and lone texts."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    common, out = [word() for _ in range(60)], []
    for _ in range(6):
        words = [word() for _ in range(rng.randrange(20, 200))]
        for _ in range(rng.randrange(1, 12)):
            own = list(words)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = word()
            out.append(own)
        for _ in range(15):  # each like the one before
            words = words[max(len(words) // 12, 1):] + [word() for _ in range(len(words) // 12)]
            out.append(words)
    out += [common + [word() for _ in range(rng.randrange(5, 90))] for _ in range(20)]
    out += [[word() for _ in range(n)] for n in (1, 2, 4, 5, 6, 9)] + [["a"], ["A"], []]
    rng.shuffle(out)
    return [(i, " ".join(w)) for i, w in enumerate(out)] + [(len(out), None), (len(out) + 1, " ".join(out[0]).upper())]


@pytest.mark.parametrize("width, hubs, block", [(2, 256, 4000), (1, 3, 5), (8, 2, 3)])
def test_stage_equals_brute_force(spark, monkeypatch, width, hubs, block):
    monkeypatch.setattr(similar, "FIRST_WIDTH", width)
    monkeypatch.setattr(similar, "HUBS", hubs)
    monkeypatch.setattr(similar, "BLOCK", block)
    docs = families(random.Random(width))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, df, None)
    assert sorted(r.doc_id for r in got.collect()) == brute_kept(docs)


def test_unlike_texts_with_a_common_passage(spark, monkeypatch):
    """Prefixes tell apart what a shared passage brings into one bucket."""
    monkeypatch.setattr(similar, "FIRST_WIDTH", 1)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    common = [word() for _ in range(120)]
    docs = [common + [word() for _ in range(60)] for _ in range(25)]
    docs += [own[:-2] + [word()] for own in docs[:10]]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, df, None)
    assert sorted(r.doc_id for r in got.collect()) == brute_kept(docs) == list(range(25))


def test_recall_of_the_bands():
    """The share of pairs of a similarity just over 0.8 that share a band."""
    rng = random.Random(9)
    signer = similar.Signer(similar.LANES)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    met = 0
    for i in range(200):
        text = words[i * 12:i * 12 + 204]  # 200 shingles, 178 of them shared: 178 / 222 = 0.802
        other = text[22:] + words[-22:]
        a, b = (np.frombuffer(signer.sign(" ".join(x)).tobytes(), dtype=np.int64) for x in (text, other))
        met += bool((a == b).any())
    assert met >= 199


def test_stage_equals_brute_force_on_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = corpus_pipeline.drop_near_duplicates(spark, df, sf_dir)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == brute_kept([(r.doc_id, r.text) for r in df.collect()])


def test_simhash_links_near_duplicates_without_bands(spark, monkeypatch):
    """Fingerprints within two bits are linked and verified, whatever the bands say."""
    real = similar.signed
    monkeypatch.setattr(similar, "signed", lambda docs, columns: real(docs, columns).withColumn(
        "bands", F.array().cast("array<long>")))
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    docs = []
    for _ in range(12):
        words = [word() for _ in range(900)]
        docs += [words, words[:-1] + [word()], [w.upper() for w in words] + words[:3]]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)] + [(100, "a b c"), (101, "A b  c"), (102, None), (103, "")]
    fps = {i: simhash.fingerprint(t, 5) for i, t in docs}
    want, seen = [], {}
    for i, _ in docs:
        near = [root for j, root in seen.items() if (fps[i] ^ fps[j]).bit_count() <= 2]
        seen[i] = min(near, default=i)
        want += [i] if seen[i] == i else []
    assert len(want) < len(docs) - 12
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, df, None)
    assert sorted(r.doc_id for r in got.collect()) == want


def test_sketches_drop_unlike_pairs_of_a_bucket_and_no_similar_ones(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    # Copies of one set with up to 120 shingles replaced; a third of them at most are similar.
    sets = [np.unique(np.concatenate([base[k:], rng.integers(0, 2**63, k).astype(np.uint64)]))
            for k in range(0, 126, 6) for _ in range(3)]
    rows = [(1, i, len(s), 0, i, similar.sketch(s).tolist()) for i, s in enumerate(sets)]
    live = spark.createDataFrame(rows, "key long, kind long, n int, at int, c long, bits array<long>")
    asked = []

    def texts_of(wanted):
        asked.extend(tuple(r) for r in wanted.where("hubs IS NOT NULL").selectExpr(
            "explode(hubs) a", "kind b").collect())
        return wanted.withColumn("text", F.lit(""))

    similar._star(live, texts_of, 0.8, 1024)
    pairs = {frozenset(p) for p in asked}
    hubs = {a for a, _ in asked}
    like = {frozenset((a, b)) for a in hubs for b in range(len(sets))
            if a != b and similar.alike(sets[a], sets[b], 0.8)}
    assert like <= pairs
    assert len(pairs) < 400  # of 1900 or so that are of like sizes
