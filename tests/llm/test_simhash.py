import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from starsync.llm import simhash
from starsync.llm.components import components
from starsync.llm.queries import QUERIES
from tests.llm.conftest import TRICKY


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), seed=42)
              for i in range(len(words) - k + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Least index reachable over links of two bits, for each value."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    v = np.array(values, dtype=np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i] ^ v[:i]) <= 2):
            a, b = sorted((root(i), root(int(j))))
            parent[b] = a
    return [root(i) for i in range(len(v))]


def test_code_is_perfect():
    code = simhash.Golay()
    assert len(set(code.error.tolist())) == 2048
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000, dtype=np.int32)
    syndrome = code.low[words & 4095] ^ code.high[words >> 12]
    nearest = words ^ code.error[syndrome]
    assert ((code.low[nearest & 4095] ^ code.high[nearest >> 12]) == 0).all()
    assert (np.bitwise_count((nearest ^ words).view(np.uint32)) <= 3).all()


def test_pairs_within_two_bits_share_an_anchor():
    rng = random.Random(4)
    code = simhash.Golay()
    for _ in range(300):
        a = rng.getrandbits(64)
        for flips in (1, 2):
            b = a
            for bit in rng.sample(range(64), flips):
                b ^= 1 << bit
            rows, keys = simhash.anchors([a, b], code)
            sets = [set(keys[rows == i].tolist()) for i in (0, 1)]
            assert sets[0] & sets[1] and max(map(len, sets)) <= 20


def chain(rng, n):
    """A chain of links, a crowd around one word, and lone values."""
    values, at = [], rng.getrandbits(64)
    for _ in range(n):
        at ^= 1 << rng.randrange(64)
        at ^= 1 << rng.randrange(64)
        values.append(at)
    centre = rng.getrandbits(64)
    values += [centre ^ 1 << i ^ 1 << j for i in range(12) for j in range(i)]
    values += [0, 1 << 63, 3 << 62, (1 << 64) - 1]
    return list(dict.fromkeys(values + [rng.getrandbits(64) for _ in range(n)]))


@pytest.mark.parametrize("crowd", [4096, 10, 2])
def test_links_keep_all_components(spark, monkeypatch, crowd):
    values = chain(random.Random(crowd), 60)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(5)
    if crowd == 4096:
        found = simhash.links(fps)
    else:  # the task function takes the limit from the module it is sent with
        import pyarrow as pa
        rows, keys = simhash.anchors(np.array(values, dtype=np.uint64))
        order = np.argsort(keys, kind="stable")
        monkeypatch.setattr(simhash, "CROWD", crowd)
        fp = np.array(signed, dtype=np.int64)[rows[order]]
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[order][i:i + 37]), pa.array(fp[i:i + 37])],
                                              ["anchor", "fp"]) for i in range(0, len(order), 37)]
        out = [(r["a"], r["b"]) for b in simhash._compare(batches) for r in b.to_pylist()]
        crowded = {a for a, b in out if b is None}
        assert crowded
        star = simhash.crowd_links(spark.createDataFrame([(v,) for v in crowded], "fp long"))
        found = spark.createDataFrame([e for e in out if e[1] is not None] or [(0, 0)], "a long, b long").union(star)
    got = {r.node: r.component for r in components(found).collect()}
    want = plain_components(values)
    groups, mine = defaultdict(set), defaultdict(set)
    for v, w in zip(signed, want):
        groups[w].add(v)
        mine[got.get(v, v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 300) if i % 100 != 99] + [(500, 400), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: i // 100 * 100 for i in range(300)}, 500: 400, 400: 400}


def expected(docs):
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    fps = [plain_fingerprint(t) for _, t in docs]
    roots = plain_components(fps)
    least = {}
    for (i, _), r in zip(docs, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(docs, fps, roots)), key=str)


def test_query_matches_a_plain_version(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op6_simhash"](spark, sf_dir)
    assert rows.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, rows.collect()), key=str) == expected(docs)


def test_takes_any_row(spark, tricky, no_docs):
    want = expected([(i, t) for i, t, _, _ in TRICKY])
    assert sorted(map(tuple, simhash.components_of(tricky).collect()), key=str) == want
    assert simhash.components_of(no_docs).count() == 0
    kept = simhash.deduplicate(tricky)
    assert kept.columns == tricky.columns
    # Texts without words are one group; of repeated rows one stays.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 5, None, 7, 8], key=str)
    assert simhash.deduplicate(no_docs).count() == 0
