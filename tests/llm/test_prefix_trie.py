"""The prefix trie against a plain version that lists all prefixes of all conversations."""

import hashlib
import zlib
from collections import Counter

import pytest

from starsync.llm import prefix_trie as pt


def plain_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(
            f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = [r[1:] for r in own.get(conv - conv % 5, [])[:h] + turns[h:]]
    return out


def plain(rows):
    members, texts = {}, plain_rebuilt(rows)
    for conv, turns in texts.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    kids = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1].encode()) if path else 0
    return Counter(
        (min(who), len(path), min(members[path[:-1]]) if path else None, len(who), kids[path], leaves[path], saved[path],
         hashlib.sha256(",".join(map(str, sorted(c for c in who if len(texts[c]) == len(path)))).encode()).hexdigest())
        for path, who in members.items())


def rows(df):
    return Counter((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                   for r in df.collect())


TRICKY = [(i, t, ("user", "assistant")[t % 2], f"{t} of {i // 20}") for i in range(60) for t in range(i % 7 + 1)] + [
    (71, 0, "user", "no base"), (100, None, None, None), (100, 1, "user", "naïve \U0001F600"), (100, 1, "user", "a tie"),
    (101, 0, "user", "own"), (None, 0, "user", "no id"), (102, 3, "user", "twice"), (102, 3, "user", "twice"),
    (103, 0, "", ""), (104, None, "user", "long " * 30_000), (105, 0, "user", "alone"), (109, 0, "user", "alone"),
] + [(200, t, "user", str(t // 2)) for t in range(300)]


@pytest.fixture(scope="module")
def tricky(spark):
    return spark.createDataFrame(
        [(*r, "x", 1, "y") for r in TRICKY],
        "conv_id long, turn long, role string, text string, node string, depth int, size string").repartition(3)


def test_tricky_conversations(tricky):
    assert rows(pt.trie(tricky)) == plain(TRICKY)


@pytest.mark.parametrize("size", [1, 7, 40])
def test_shards_are_added_up(spark, size, monkeypatch):
    """Shards of any size give the same nodes (walked here, added up as the job does)."""
    monkeypatch.setattr(pt, "SHARD", size)
    turns = [(c, p, hashlib.md5(repr(t).encode()).digest(), len(t[1].encode()))
             for c, own in sorted(plain_rebuilt(TRICKY).items()) for p, t in enumerate([("", ""), *own], -1)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*turns)], ["conv_id", "position", "turn", "size"])
    shards = list(pt._shards([batch]))
    assert len(shards) > 1 and [c for s in shards for c, _ in s] == sorted(plain_rebuilt(TRICKY))
    local = [r for s in shards for r in pt.walk(s)]
    monkeypatch.setattr(pt, "shard_nodes", lambda turns: spark.createDataFrame(
        [tuple(r) for r in local], pt._NODE).repartition(3))
    assert rows(pt.nodes(tricky_turns(spark))) == plain(TRICKY)


def tricky_turns(spark):
    return spark.createDataFrame([], "conv_id long, position long, turn binary, size long")


def test_no_conversations(tricky):
    assert rows(pt.trie(tricky.limit(0))) == Counter()


def test_trie_of_the_table(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert rows(pt.trie(found)) == plain([(r.conv_id, r.turn, r.role, r.text) for r in found.collect()])
