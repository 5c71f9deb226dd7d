"""Document fingerprints by MinHash.

A text's shingles are its five-word windows (the whole sequence if it has fewer words; words are
what ASCII white space separates).  Each of ``LANES`` universal hash functions maps the shingles to
64 bits; the least value of each, folded to 16 bits, is a lane of the fingerprint.  Two fingerprints
are as alike as the share of equal lanes, which estimates the Jaccard similarity of the shingles.

Fingerprints are computed in numpy over whole texts inside the tasks.  ``near_classes`` finds near
duplicates: bands of lanes are joined in Spark and the Jaccard similarity of the shingle sets, with
a stated threshold, is verified there.

Defined cases: a null text is an empty one; an empty text has no shingles and a fingerprint of its
own, equal to that of every other empty text; repeated rows are fingerprinted each; an empty table
gives no rows; other columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starsync.llm.chunks import Memo, kept
from starsync.llm.common import map_texts, ship, utf8
from starsync.session import stage

LANES = 64
WORDS = 5
SEED = 20_24
#: Shingles that are hashed at a time (a block of ROWS x LANES numbers of 64 bits).
ROWS = 2048

THRESHOLD = 0.8


class Signer:
    """Computes signatures; built once per worker."""

    def __init__(self, lanes=LANES, words=WORDS, seed=SEED, memory=250_000):
        draw = np.random.default_rng(seed)
        odd = lambda n: draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.place, self.a, self.b = odd(words), odd(lanes), odd(lanes)
        self.fold = odd(1)[0]
        self.words = words
        self.hashes = Memo(lambda found: map(xxhash.xxh64_intdigest, found), memory)

    def shingles(self, text) -> np.ndarray:
        """Hashes of the shingles of a text, repeats included."""
        found = utf8(text).split()
        if not found:
            return np.empty(0, dtype=np.uint64)
        self.hashes.learn(set(found))
        h = np.fromiter(map(self.hashes.young.__getitem__, found), dtype=np.uint64, count=len(found))
        k = min(self.words, len(h))
        mixed = np.zeros(len(h) - k + 1, dtype=np.uint64)
        for i in range(k):
            mixed += h[i:len(h) - k + 1 + i] * self.place[i]
        return mixed ^ (mixed >> np.uint64(31))

    def sign(self, text) -> np.ndarray:
        """The lanes of a text (16 bits each)."""
        x = np.unique(self.shingles(text))
        least = np.full(len(self.a), np.iinfo(np.uint64).max, dtype=np.uint64)
        for i in range(0, len(x), ROWS):
            block = x[i:i + ROWS, None] * self.a + self.b
            block ^= block >> np.uint64(32)
            np.minimum(least, block.min(axis=0), out=least)
        return ((least * self.fold) >> np.uint64(48)).astype(">u2")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the next text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n] if n else text


def alike(a, b) -> float:
    return float((a == b).mean())


_OUT = ("n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double")


def _compare(signer, text, lanes, following, next_lanes):
    other = edited(text, following)
    other_lanes = signer.sign(other)
    return (len(text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).digest(),
            lanes.tobytes(), other_lanes.tobytes(), alike(lanes, other_lanes), alike(lanes, next_lanes))


def with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next higher doc_id (nulls first; equal ids by a hash of
    the text), after the last one the first.  Texts are range-sorted once; within a task the next
    document follows, and at the task's end it is the first document of the next range.  Only those
    two texts of each range meet in a second, small join.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [c.split()[0] for c in _OUT.split(", ")]
    schema = f"doc_id {kind}, {_OUT}, part int, edge string, text string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["doc_id", "_tie"]
    ranged = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_tie")
    )

    def run(batches):
        """All rows but the last with their results, and the first and last text of the range."""
        signer, part = kept("signer", Signer), TaskContext.get().partitionId()
        before = None  # doc_id, text and lanes of the row before
        out = []

        def flush():
            return pa.RecordBatch.from_pylist(out, schema=arrow)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                lanes = signer.sign(text)
                if before is None:
                    out.append({"part": part, "edge": "first", "text": text})
                else:
                    values = _compare(signer, before[1], before[2], text, lanes)
                    out.append({"doc_id": before[0], **dict(zip(names, values))})
                before = (doc_id, text, lanes)
                if len(out) >= 2000:
                    yield flush()
                    out.clear()
        if before is not None:
            out.append({"doc_id": before[0], "part": part, "edge": "last", "text": before[1]})
        yield flush()

    done = stage(ranged.mapInArrow(run, schema), "fingerprints")
    edges = done.where("edge IS NOT NULL").select("doc_id", "part", "edge", "text")
    # One short row for each range, so the window holds as many rows as there are tasks.
    follow = Window.orderBy("part")
    ranges = edges.where("edge = 'first'").select("part")
    chain = ranges.select(
        "part", F.coalesce(F.lead("part").over(follow), ranges.agg(F.min("part")).scalar()).alias("_next"))
    firsts = edges.where("edge = 'first'").select(F.col("part").alias("_next"), F.col("text").alias("following"))
    pairs = edges.where("edge = 'last'").select("doc_id", "part", "text").join(chain, "part").join(
        firsts, "_next").select("doc_id", "text", "following")

    def make():
        signer = kept("signer", Signer)

        def fn(rows):
            values = [_compare(signer, t, signer.sign(t), f, signer.sign(f))
                      for t, f in zip(rows["text"], rows["following"])]
            return {"doc_id": rows["doc_id"]} | {n: [v[i] for v in values] for i, n in enumerate(names)}

        return fn

    rest = map_texts(pairs, make, f"doc_id {kind}, {_OUT}")
    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    return done.where("edge IS NULL").select("doc_id", *names).unionByName(rest).select(
        "doc_id", "n_chars", hexed("edited_sha256"), hexed("fingerprint"), hexed("edited_fingerprint"),
        "near_edited", "near_next")


def near_classes(docs: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """doc_id, class_id: near duplicates get the least doc_id of their class.

    Signature bands are joined in Spark and the Jaccard similarity of whole shingle sets is verified
    (``similar.classes``); the pipeline's near-duplicate stage runs the same steps.
    """
    from starsync.llm import similar  # it is built on the signatures of this module

    return similar.classes(docs, threshold)
