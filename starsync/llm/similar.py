"""Near duplicates by the Jaccard similarity of shingle sets, found by SimHash and MinHash and verified.

Documents with the same set of five-word shingles (A-Z in lower case) are one kind.  ``deduplicate`` begins
with SimHash: fingerprints of these shingles that differ in two bits at most are linked through their covering
anchors (``simhash.links``), and the links are verified.  Pairs of similarity 0.8 differ in more bits than that,
so for what SimHash leaves apart a kind is also signed with ``LANES`` universal hashes; ``BAND`` lanes are a
band, and kinds that agree in a band meet in a bucket.  With 24 bands of 4 lanes a pair of similarity 0.8 meets
with probability 1 - (1 - 0.8^4)^24, so 3 in a million of such pairs are missed, and fewer of those that are
more alike; what meets is never lost:

1. *Stars.*  The members of a bucket are compared with one of them, the hub.  A bucket whose members
   are in one component then is done (that is what copies and edited copies do, however many).
2. *Prefixes.*  Kinds that are left (many unlike kinds that share a passage) are filed again, under the
   first n - ceil(t n) + 1 of their shingles, those first that the fewest of them have.  Kinds that are
   similar enough share one of these, and a shared passage comes last.  Rounds of stars follow, with many
   hubs from the smallest components, for the pairs across components that sizes, places and sketches allow,
   until each bucket is in one component or all its members have been hubs.  Sketches never keep similar
   sets apart.

A pair is verified on its texts: ``HUBS`` hubs and blocks of about ``BLOCK`` of their pairs are dealt out
together, each member's text once, and streamed.  No array of shingles is shuffled with a pair, no bucket
is held in one task, and tables that are no longer read are deleted step by step.

Defined cases: a null text is an empty one; texts without words are one kind; repeated rows are one;
an empty table gives no rows; all columns are kept, whatever their names.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsync.llm import simhash
from starsync.llm.chunks import kept
from starsync.llm.common import aside, map_texts, one_of_each, ship, slices, utf8
from starsync.llm.components import components
from starsync.llm.fingerprints import THRESHOLD, WORDS, Signer
from starsync.session import scratch, stage

LANES, BAND = 96, 4
#: Hubs of a bucket in the first round after kinds are filed under their shingles, and in the later ones.
#: Rounds go on until no bucket has two components.
FIRST_WIDTH, MOST_WIDTH = 8, 1024
#: Words of 64 bits in the sketch of a set.
SKETCH = 16
#: Hubs whose sets a task holds, and pairs of them that are compared in one go.
HUBS, BLOCK = 256, 4000


def kind_of(shingles: np.ndarray) -> int:
    """The name of a set of shingles (sorted)."""
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def _signer():
    return kept("signer-96", lambda: Signer(LANES, memory=50_000))


def _lower(text) -> str:
    return utf8(text).lower().decode("utf-8", "surrogatepass")  # bytes.lower() changes A-Z only


def _shingles(text) -> np.ndarray:
    return np.unique(_signer().shingles(_lower(text)))


def alike(a: np.ndarray, b: np.ndarray, threshold) -> bool:
    """Whether the Jaccard similarity of two sets (sorted) reaches the threshold."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * (1 + threshold) >= (len(a) + len(b)) * threshold - 1e-6


def sketch(shingles: np.ndarray) -> np.ndarray:
    """``64 * SKETCH`` bits, of which each shingle flips one: the bits in which two sketches differ are at
    most as many as the shingles that only one of the sets has."""
    at = np.bincount((shingles.view(np.uint64) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH)
    return np.packbits((at & 1).astype(np.uint8)).view(np.int64)


def _may_reach(threshold, h):
    """Whether the sketches of a row and of ``h`` allow the similarity: sets of m and n shingles, d of which
    are in one set alone, have (m + n - d) / (m + n + d)."""
    differ = F.aggregate(
        F.zip_with("bits", h["bits"], lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda d, k: d + k)
    return differ * (1 + threshold) <= (F.col("n") + h["n"]) * (1 - threshold) + 1e-6


def _text_id(columns) -> list:
    """The name of a text in 128 bits, and one of the row that has it."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), F.xxhash64(*columns).alias("t3")]


def signed(docs: DataFrame, columns) -> DataFrame:
    """The given columns of every row and its kind, number of shingles, SimHash fingerprint and bands."""
    def make():
        signer = _signer()

        def fn(batch):
            found = [_lower(t) for t in batch["text"]]
            sets = [np.unique(signer.shingles(t)) for t in found]
            return {c: batch[c] for c in columns} | {
                "kind": [kind_of(s) for s in sets], "n": [len(s) for s in sets],
                "fp": np.array([simhash.fingerprint(t, WORDS) for t in found], dtype=np.uint64).view(np.int64),
                "bands": [np.frombuffer(signer.sign(t).tobytes(), dtype=np.int64) for t in found]}

        return fn

    slim = docs.select(*columns, "text")
    kinds = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in columns)
    return map_texts(slim, make, f"{kinds}, kind long, n int, fp long, bands array<long>")


def _compare(threshold):
    """Task function: the hubs of a block (text, no ``hubs``) and then its members to links (a, b)."""
    def run(batches):
        block, own, last = None, {}, None
        for batch in batches:
            for part in slices(batch, "text"):
                a, b = [], []
                for row in part.to_pylist():
                    place = row["group"], row["block"], row["hubs"] is None, row["kind"]
                    if place == last:  # a row that the table has several times
                        continue
                    last = place
                    if block != (row["group"], row["block"]):
                        block, own = (row["group"], row["block"]), {}
                    shingles = _shingles(row["text"])
                    if row["hubs"] is None:
                        own[row["kind"]] = shingles
                    else:
                        found = [h for h in row["hubs"] if alike(own[h], shingles, threshold)]
                        a += found
                        b += [row["kind"]] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _verified(pairs: DataFrame, texts_of, threshold) -> DataFrame:
    """The similar ones of the pairs (a, b), where ``a`` is a hub."""
    spark = pairs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with scratch(spark):
        pairs = stage(pairs.distinct(), "similar-pairs", keep=True)
        if pairs.isEmpty():
            return pairs
        hubs = pairs.select("a").distinct()
        groups = max(-(-hubs.count() // HUBS), 1)
        group = F.pmod(F.xxhash64("a"), F.lit(groups)).alias("group")
        asked = stage(pairs.groupBy(group, F.col("b").alias("kind")).agg(
            F.collect_list("a").alias("hubs")), "similar-members")  # of one group: about HUBS at most
        blocks = stage(asked.groupBy("group").agg(
            F.ceil(F.sum(F.size("hubs")) / BLOCK).alias("blocks")), "similar-blocks")
        members = asked.join(blocks, "group").select(
            "group", F.pmod(F.xxhash64("kind"), "blocks").alias("block"), "kind", "hubs")
        each = hubs.select(group, F.col("a").alias("kind")).join(blocks, "group").select(
            "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "kind",
            F.lit(None).cast("array<long>").alias("hubs"))
        wanted = stage(members.unionByName(each), "similar-wanted")
        rows = texts_of(wanted).select("group", "block", "kind", "hubs", "text")
        # With few blocks, as many tasks as they have work for.
        few = blocks.agg(F.sum("blocks")).first()[0] < parts
        dealt = rows.repartition("group", "block") if few else rows.repartition(parts, "group", "block")
        # Nulls first: a block's hubs before its members.
        dealt = dealt.sortWithinPartitions("group", "block", "hubs", "kind")
        return stage(dealt.mapInArrow(_compare(threshold), "a long, b long"), "similar-links", keep=True)


def _nodes(found: DataFrame) -> DataFrame:
    """(kind, component) of linked kinds."""
    with scratch(found.sparkSession):
        return stage(components(found).withColumnRenamed("node", "kind"), "similar-nodes", keep=True)


def _live(buckets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of buckets whose kinds are in several components, with their component ``c``."""
    with scratch(buckets.sparkSession):
        placed = stage(buckets.drop("c").join(nodes, "kind", "left").withColumn(
            "c", F.coalesce("component", "kind")).drop("component"), "similar-placed")
        open_keys = placed.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1")
        return stage(placed.join(stage(open_keys.select("key"), "similar-open"), "key"), "similar-live", keep=True)


def _star(live: DataFrame, texts_of, threshold, width=1):
    """The links to ``width`` hubs of each bucket, and the rows without the hubs.

    The components of a bucket are dealt to ``width`` slots; the smallest of a slot gives the hub.  Where
    there are many, which one of equals that is differs by bucket, so that buckets of the same kinds do not
    repeat each other's pairs; a single hub is the same in as many buckets as can be.  Rows with ``bits``
    give only the pairs that their sketches allow.
    """
    sketched = ["bits"] if "bits" in live.columns else []
    tie = F.col("kind") if width == 1 else F.xxhash64("key", "kind")
    smallest = F.col("tie") if width == 1 else F.struct("k", "tie")
    parts = live.groupBy("key", "c").agg(
        F.count(F.lit(1)).alias("k"), F.min_by(F.struct("kind", "n", "at", "c", *sketched), tie).alias("hub"),
        F.min(tie).alias("tie"))
    with scratch(live.sparkSession):
        chosen = stage(parts.groupBy("key", F.pmod(F.xxhash64("c", "key"), F.lit(width)).alias("slot")).agg(
            F.min_by("hub", smallest).alias("hub")).select("key", "hub"), "similar-hubs")
        hubs = chosen.groupBy("key").agg(F.collect_list("hub").alias("hubs"))  # at most ``width`` of a bucket

        def able(h):
            least = F.least(F.col("n") - F.col("at"), h["n"] - h["at"])
            sized = ((h["c"] != F.col("c")) & (~F.col("own") | (F.col("kind") > h["kind"])) & (
                least * (1 + threshold) >= (F.col("n") + h["n"]) * threshold - 1e-6))
            return sized & _may_reach(threshold, h) if sketched else sized

        own = F.exists("hubs", lambda h: h["kind"] == F.col("kind"))
        pairs = live.join(hubs, "key").withColumn("own", own).select(
            F.explode(F.transform(F.filter("hubs", able), lambda h: h["kind"])).alias("a"), F.col("kind").alias("b"))
        found = stage(_verified(pairs, texts_of, threshold), "similar-found", keep=True)
        rest = live.join(chosen.select("key", F.col("hub.kind").alias("kind")), ["key", "kind"], "left_anti")
        return found, stage(rest, "similar-rest", keep=True)


def prefix_buckets(kinds: DataFrame, texts_of, threshold) -> DataFrame:
    """(key, kind, n, at, bits): the kinds under the first of their shingles, from rare to frequent among them,
    and their sketches."""
    def make():
        def fn(batch):
            sets = [_shingles(t) for t in batch["text"]]
            return {"kind": batch["kind"], "shingles": [s.view(np.int64) for s in sets],
                    "bits": [sketch(s) for s in sets]}

        return fn

    once = texts_of(kinds).groupBy("kind").agg(F.first("text").alias("text"))
    sets = stage(map_texts(once, make, "kind long, shingles array<long>, bits array<long>"), "similar-sets")
    rows = sets.select("kind", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    often = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "similar-often")
    ranked = rows.join(often, "key", "left").withColumn("at", F.row_number().over(
        Window.partitionBy("kind").orderBy(F.coalesce("often", F.lit(1)), "key")) - 1)
    # Shingles that one kind alone has take their places, but make no bucket.
    first = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    return ranked.where((F.col("at") < first) & F.col("often").isNotNull()).join(
        sets.select("kind", "bits"), "kind").select("key", "kind", "n", "at", "bits")


def simhash_links(marked: DataFrame, texts_of, threshold=THRESHOLD) -> DataFrame:
    """(a, b) similar kinds of ``marked`` (kind, fp), by the links of SimHash: fingerprints that differ in two
    bits at most meet at a covering anchor, and a fingerprint's kinds are compared with the least of them."""
    with scratch(marked.sparkSession):
        held = stage(marked.select("fp", "kind").distinct(), "similar-fingerprints")
        hubs = stage(held.groupBy("fp").agg(F.min("kind").alias("hub")), "similar-owners")
        same = held.join(hubs, "fp").select(F.col("hub").alias("a"), F.col("kind").alias("b"))
        near = (
            simhash.links(hubs.select("fp"))
            .join(hubs.select(F.col("fp").alias("a"), F.col("hub").alias("member")), "a")
            .join(hubs.select(F.col("fp").alias("b"), "hub"), "b")
            .select(F.col("hub").alias("a"), F.col("member").alias("b")))
        return stage(_verified(same.union(near).where("a <> b"), texts_of, threshold), "similar-simhash", keep=True)


def links(kinds: DataFrame, texts_of, threshold=THRESHOLD, known: DataFrame = None) -> DataFrame:
    """(a, b) links of ``kinds`` (kind, n, bands); their components are those of the ``known`` links and
    all similar pairs that share a band.  ``texts_of(wanted)`` gives the rows of ``wanted`` a text of their
    ``kind``."""
    rows = kinds.select("kind", "n", F.posexplode("bands").alias("p", "b")).select(
        "kind", "n", F.xxhash64("p", "b").alias("key"), F.lit(0).alias("at"))
    met = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key"), "similar-keys")
    live = stage(rows.join(met, "key").withColumn("c", F.col("kind")), "similar-buckets")
    if known is not None:
        live = _live(live, _nodes(known))
    found, rest = _star(live, texts_of, threshold)
    found = found if known is None else found.union(known)
    nodes = _nodes(found)
    left = _live(rest, nodes).select("kind").distinct()
    if left.isEmpty():
        return found
    rest = stage(prefix_buckets(stage(left, "similar-left"), texts_of, threshold), "similar-prefixes")
    live, width = _live(rest, nodes), FIRST_WIDTH
    while not live.isEmpty():
        more, rest = _star(live, texts_of, threshold, width)
        if not more.isEmpty():
            found = found.union(more)
            nodes = _nodes(found)
        live, width = _live(rest, nodes), MOST_WIDTH
    return found


def rooted(docs: DataFrame, columns, threshold=THRESHOLD, by_simhash=False) -> DataFrame:
    """The given columns of every row of ``docs`` and ``root``, the least kind of its component."""
    named = docs.select(*columns, *_text_id(columns), "text")
    marked = stage(signed(named, [*columns, "t1", "t2", "t3"]), "kinds")
    kinds = stage(marked.groupBy("kind").agg(
        F.first("n").alias("n"), F.first("bands").alias("bands"), F.min(F.struct("t1", "t2", "t3")).alias("t")), "kinds-once")

    def texts_of(wanted):
        # One row of a kind gives its text; if the table has that row several times, it comes as often.
        ids = stage(wanted.join(kinds.select("kind", "t"), "kind").select(*wanted.columns, "t.*"), "kinds-wanted")
        return named.select("t1", "t2", "t3", "text").join(ids, ["t1", "t2", "t3"]).select(*wanted.columns, "text")

    known = simhash_links(marked.where("n > 0"), texts_of, threshold) if by_simhash else None
    found = links(kinds.where("n > 0").select("kind", "n", "bands"), texts_of, threshold, known)
    joined = components(found).withColumnRenamed("node", "kind")
    roots = stage(kinds.select("kind").join(joined, "kind", "left").select(
        "kind", F.coalesce("component", "kind").alias("root")), "kinds-rooted")
    return marked.select(*columns, "kind").join(roots, "kind").select(*columns, "root")


def deduplicate(docs: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """One row of ``docs``, with all its columns, for each component of similar documents, by SimHash and
    then by MinHash bands: that with the least doc_id (null ids last), of repeated rows one."""
    inner, outer = aside(docs)
    with scratch(docs.sparkSession):
        keyed = inner.withColumn("_uid", F.xxhash64(*inner.columns))
        return outer(one_of_each(keyed, rooted(keyed, ["doc_id", "_uid"], threshold, by_simhash=True)))


def classes(docs: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """doc_id, class_id: near duplicates get the least doc_id of their class."""
    with scratch(docs.sparkSession):
        marked = stage(rooted(docs.select("doc_id", "text"), ["doc_id"], threshold), "near-classes", keep=True)
    least = marked.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return marked.join(least, "root").select("doc_id", "class_id")
