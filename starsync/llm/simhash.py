"""SimHash near-duplicates by covering anchors.

Fingerprints of 64 bits are cut into three blocks of 22, 21 and 21 bits.  The anchors are code words
of the binary Golay code, which covers all words of 23 bits with radius 3 and no overlap, so the
nearest anchor of a block is found by its syndrome (shortened blocks are filled up with zeros).
Words in a product of blocks are covered by the products of the anchors.

A pair that differs in two bits has a midpoint, one bit away from either.  A fingerprint is
therefore copied to each anchor that covers a word within one bit of it (all of them lie within
covering radius plus threshold), and both of a pair meet at the anchor of their midpoint.

Fingerprints are compared per anchor, distinct ones only, and each anchor passes on a tree of its
links, never all pairs.  Anchors with more than ``CROWD`` fingerprints are not compared: theirs are
copied to all words within one bit instead (65 of them), where at most 65 fingerprints can meet and
all that meet are links.  Links are joined to components in Spark.

Defined cases: a null text is an empty one; a text without words has fingerprint 0, linked like any
other; repeated rows share their component; a component whose ids are all null has a null id; an
empty table gives no rows; other columns are ignored by ``components_of`` and kept by ``deduplicate``.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync.llm.common import aside, map_texts, one_of_each, ship, utf8
from starsync.llm.components import components
from starsync.session import scratch, stage

#: Most bits in which linked fingerprints differ (the midpoint argument is made for 2).
THRESHOLD = 2
WORDS = 3
SEED = 42
#: Shift and width of the three blocks.
BLOCKS = ((0, 22), (22, 21), (43, 21))
#: Most fingerprints of an anchor that are compared with each other.
CROWD = 4096
#: Generator polynomial of the Golay code of 23 bits: x^11+x^9+x^7+x^6+x^5+x+1.
GOLAY = 0b101011100011
#: Shingles whose bits are counted at a time.
ROWS = 50_000


def fingerprint(text, words=WORDS) -> int:
    """The fingerprint as an unsigned number; its first hex digit holds the highest bits."""
    import xxhash

    found = utf8(text).lower().split()  # bytes.lower() changes A-Z only
    if not found:
        return 0
    k = min(words, len(found))
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(found) - k + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, ROWS):
        upto = min(at + ROWS, n)
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(
            starts[at:upto].tolist(), ends[at + k - 1:upto + k - 1].tolist())], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


class Golay:
    """Nearest code words of 23-bit words, as their 12 message bits."""

    def __init__(self):
        def remainder(word):
            for bit in range(22, 10, -1):
                if word >> bit & 1:
                    word ^= GOLAY << (bit - 11)
            return word

        column = [remainder(1 << i) for i in range(23)]
        self.low = np.zeros(1 << 12, dtype=np.int32)
        self.high = np.zeros(1 << 11, dtype=np.int32)
        for table, first in ((self.low, 0), (self.high, 12)):
            for i in range(len(table).bit_length() - 1):
                table[1 << i:2 << i] = table[:1 << i] ^ column[first + i]
        # The error of each syndrome: every pattern of up to three bits has one of its own.
        self.error = np.zeros(1 << 11, dtype=np.int32)
        for weight in range(1, 4):
            for bits in itertools.combinations(range(23), weight):
                self.error[np.bitwise_xor.reduce([column[b] for b in bits])] = sum(1 << b for b in bits)

    def message(self, words):
        syndrome = self.low[words & 4095] ^ self.high[words >> 12]
        return (words ^ self.error[syndrome]) >> 11


def _reachable(code, values, width):
    """(row, anchor, flips) for the words within one bit of each block value, least flips first."""
    rows = np.repeat(np.arange(len(values)), width + 1)
    masks = np.array([0] + [1 << b for b in range(width)], dtype=np.int32)
    found = code.message(values[:, None] ^ masks).ravel()
    key = np.unique(rows << 13 | found << 1 | (np.tile(masks, len(values)) > 0))
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] >> 1 != key[:-1] >> 1
    key = key[first]
    return key >> 13, key >> 1 & 4095, key & 1


def anchors(fps, code=None):
    """(row, anchor) of every anchor that the fingerprints go to: about sixteen for each."""
    code = code or Golay()
    fps = np.asarray(fps, dtype=np.uint64)
    reached = [
        _reachable(code, (fps >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int32), width)
        for shift, width in BLOCKS]
    own = np.zeros(len(fps), dtype=np.int64)  # the product of the anchors of the fingerprint itself
    place = [24, 12, 0]
    for (rows, keys, flips), up in zip(reached, place):
        own[rows[flips == 0]] |= keys[flips == 0] << up
    out = [(np.arange(len(fps)), own)]
    for (rows, keys, flips), up in zip(reached, place):
        rows, keys = rows[flips == 1], keys[flips == 1]
        out.append((rows, own[rows] & ~(np.int64(4095) << up) | keys << up))
    return tuple(np.concatenate(x) for x in zip(*out))


def trees(fps):
    """For each fingerprint, the least one (by place) that a chain of links here leads to."""
    label = np.arange(len(fps))
    while True:
        new = label.copy()
        for at in range(0, len(fps), 256):
            near = np.bitwise_count(fps[at:at + 256, None] ^ fps[None, :]) <= THRESHOLD
            new[at:at + 256] = np.where(near, label[None, :], len(fps)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _batch(a, b=None):
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())],
        schema=_LINK)


def _run_links(fp, starts, ends):
    """Links inside the runs of an anchor each; the members of a crowded run alone."""
    size = ends - starts
    a, b = [], []
    # Short runs: neighbours at each distance in the run are compared for all runs at once.
    group = np.repeat(np.arange(len(starts)), size)
    short = np.repeat(size <= 8, size)
    bits = fp.view(np.uint64)
    for shift in range(1, min(8, len(group))):
        near = (group[shift:] == group[:-shift]) & short[shift:] & (
            np.bitwise_count(bits[shift:] ^ bits[:-shift]) <= THRESHOLD)
        a.append(fp[shift:][near])
        b.append(fp[:-shift][near])
    for s, e in zip(starts[size > 8].tolist(), ends[size > 8].tolist()):
        if e - s > CROWD:
            yield _batch(fp[s:e])
            continue
        label = trees(bits[s:e])
        own = label != np.arange(e - s)
        a.append(fp[s:e][own])
        b.append(fp[s:e][label[own]])
    if a:
        yield _batch(np.concatenate(a), np.concatenate(b))


def _compare(batches):
    """Rows (anchor, fp) in the order of the anchors to links (a, b) and (a, null) for the crowded.

    No more than a batch and CROWD rows are held: a longer run is passed on as it comes.
    """
    anchor, held, crowded = None, np.empty(0, dtype=np.int64), False
    for batch in batches:
        keys = batch.column("anchor").to_numpy()
        fp = batch.column("fp").to_numpy()
        if not len(fp):
            continue
        if crowded:  # members of an anchor whose first ones were passed on
            n = int(np.searchsorted(keys != anchor, True))
            if n:
                yield _batch(fp[:n])
            keys, fp = keys[n:], fp[n:]
            if not len(fp):
                continue
            crowded = False
        keys = np.concatenate([np.full(len(held), anchor if len(held) else 0), keys])
        fp = np.concatenate([held, fp])
        edges = np.flatnonzero(np.diff(keys)) + 1
        starts = np.concatenate([[0], edges])
        last = int(starts[-1])
        if len(starts) > 1:
            yield from _run_links(fp[:last], starts[:-1], edges)
        anchor, held = keys[-1], fp[last:]
        if len(held) > CROWD:
            yield _batch(held)
            held, crowded = held[:0], True
    if len(held) > 1:
        yield from _run_links(held, np.array([0]), np.array([len(held)]))


def links(fps: DataFrame) -> DataFrame:
    """(a, b) links between distinct fingerprints ``fps`` (fp): their components are those of all
    pairs that differ in two bits at most."""
    ship(fps.sparkSession)

    def copy(batches):
        code = Golay()
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for at in range(0, len(fp), 5000):
                part = fp[at:at + 5000]
                rows, keys = anchors(part.view(np.uint64), code)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["anchor", "fp"])

    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    compared = stage(
        fps.mapInArrow(copy, "anchor long, fp long").repartition(parts, "anchor")
        .sortWithinPartitions("anchor").mapInArrow(_compare, "a long, b long"), "simhash-links")
    crowd = compared.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    return compared.where("b IS NOT NULL").unionByName(crowd_links(crowd))


def crowd_links(fps: DataFrame) -> DataFrame:
    """Links among fingerprints of crowded anchors.

    Each is copied to the words within one bit.  Those that meet at a word are links of each other,
    so a star around the least of them (65 at most) keeps their components.
    """
    flips = [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)]
    copies = fps.select("fp", F.explode(F.array(F.col("fp"), *flips)).alias("word"))
    stars = copies.groupBy("word").agg(F.min("fp").alias("b"))
    return copies.join(stars, "word").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def fingerprints(docs: DataFrame, columns=("doc_id",), words=WORDS) -> DataFrame:
    """The given columns of every row of ``docs`` and ``fp``, its fingerprint as a signed long."""
    def make():
        def fn(batch):
            found = np.array([fingerprint(t, words) for t in batch["text"]], dtype=np.uint64)
            return {c: batch[c] for c in columns} | {"fp": found.view(np.int64)}

        return fn

    slim = docs.select(*dict.fromkeys([*columns, "text"]))
    kinds = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in columns)
    return map_texts(slim, make, f"{kinds}, fp long")


def classes(marked: DataFrame) -> DataFrame:
    """(fp, root, component_id): each fingerprint's component, and the least doc_id in it."""
    own = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(own.select("fp")))
    rooted = own.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(roots, "root").select("fp", "root", "component_id")


def components_of(docs: DataFrame, words=WORDS) -> DataFrame:
    """doc_id, fingerprint, component_id: one row for each row of ``docs``."""
    marked = stage(fingerprints(docs, words=words), "simhash")
    return marked.join(classes(marked), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, words=WORDS) -> DataFrame:
    """One row of ``docs``, with all its columns, for each component: that with the least doc_id
    (null ids last), of repeated rows one."""
    inner, outer = aside(docs)
    with scratch(docs.sparkSession):
        keyed = inner.withColumn("_uid", F.xxhash64(*inner.columns))
        marked = stage(fingerprints(keyed, ("doc_id", "_uid"), words), "simhash")
        return outer(one_of_each(keyed, marked.join(classes(marked), "fp")))
