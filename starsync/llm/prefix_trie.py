"""Prefix trie of conversations over vertical bitmaps.

Conversations are rebuilt first (``rebuilt``): several begin with the turns of one.  A turn is the
digest of its role and text and the text's length in bytes; texts do not move.

Conversations are range-sorted by id and cut into shards of about ``SHARD`` turns.  In a shard,
(position, turn) is indexed to the bitset of the conversations that have that turn there.  The trie is
walked depth first: the intersection of a node's bitset with a posting of the next position is a child
(the posting is that of the lowest conversation not yet taken, so there are as many intersections as
children), its popcount the number of members, and the members that have no next turn are its list of
ends.  A node is named by the digest of its path, so that the shards' nodes meet in Spark:

* a node belongs to the shard of its smallest member; where all its nodes have no child it is a leaf;
* sums over subtrees are taken in the shards, where a subtree is a range of the walk's order: turns
  of members in each shard, but the text, the leaf and the child itself only where they belong, so
  that adding the shards counts each node once;
* ends come in the order of ids, shard by shard, and are streamed into their digest.

A hot first turn is one row for each shard.  A conversation is never cut: a longer one than ``SHARD`` is a
shard of its own, about 100 bytes a turn whatever the texts.

Defined cases: null turns come first, equal turns are ordered by role and by a digest of the text; a null role
or text is empty; rows without a conv_id are no conversation; repeated rows are turns each; an empty table has
no nodes, not even a root; other columns are ignored.
"""

import hashlib
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starsync.llm.common import joined_sha256, ship
from starsync.session import stage

#: Conversations that begin alike, and the bound of the turns they share.
FAMILY, HEAD = 5, 9
#: Turns (and marks of conversations) of a shard.
SHARD = 20_000

ROOT = bytes(16)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, turn, size): the rebuilt turns, and a mark at position -1 for every conversation."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    head = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % HEAD
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), F.col("turn").alias("place"),
        role.alias("role"), F.unhex(digest).alias("turn"), F.octet_length(text).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.col("place").asc_nulls_first(), "role", "turn")
    own = stage(rows.withColumn("position", F.row_number().over(order) - 1).select(
        "conv_id", "base", "position", "turn", "size"), "trie-turns")
    names = own.select("conv_id", "base").distinct()
    # At most HEAD turns of a conversation are copied, to FAMILY conversations at most.
    shared = own.where((F.col("conv_id") == F.col("base")) & (F.col("position") < HEAD)).select(
        "base", "position", "turn", "size")
    begin = names.join(shared, "base").where(F.col("position") < head("conv_id"))
    rest = own.where(F.col("position") >= head("conv_id"))
    # Positions behind a short beginning close up to it.
    sizes = begin.groupBy("conv_id").agg(F.count(F.lit(1)).alias("begun"))
    shift = F.col("position") - head("conv_id") + F.coalesce("begun", F.lit(0))
    rest = rest.join(sizes, "conv_id", "left").withColumn("position", shift)
    mark = names.select("conv_id", F.lit(-1).alias("position"), F.lit(None).cast("binary").alias("turn"), F.lit(0).alias("size"))
    columns = ["conv_id", F.col("position").cast("long").alias("position"), "turn", F.col("size").cast("long").alias("size")]
    return begin.select(*columns).unionByName(rest.select(*columns)).unionByName(mark.select(*columns))


_NODE = ("shard long, idx long, parent long, depth long, node binary, least long, members long, children long, "
         "size long, below long, ends string")


def walk(shard) -> list:
    """The nodes of a shard [(conv_id, [(turn, size), ...]), ...] in depth-first order, as rows of ``_NODE``."""
    postings: dict = {}
    for i, (_, turns) in enumerate(shard):
        for at, (turn, _) in enumerate(turns):
            postings[at, turn] = postings.get((at, turn), 0) | 1 << i
    out, todo = [], [((1 << len(shard)) - 1, 0, ROOT, None, 0)]
    while todo:
        bits, depth, name, parent, size = todo.pop()
        least = (bits & -bits).bit_length() - 1
        row = [shard[0][0], len(out), parent, depth, name, shard[least][0], bits.bit_count(), 0, size, 0, None]
        ends, children, left = [], [], bits
        while left:
            i = (left & -left).bit_length() - 1
            turns = shard[i][1]
            if len(turns) == depth:
                ends.append(i)
                left ^= 1 << i
                continue
            turn, n = turns[depth]
            child = bits & postings[depth, turn]
            children.append((child, depth + 1, hashlib.blake2b(name + turn, digest_size=16).digest(), row[1], n))
            left &= ~child
        row[7] = len(children)
        if ends:
            row[10] = ",".join(str(shard[i][0]) for i in ends)
        out.append(row)
        todo += reversed(children)
    for row in reversed(out):  # nodes below, without the node itself
        if row[2] is not None:
            out[row[2]][9] += row[9] + 1
    return out


def _shards(batches):
    """Shards of rows (conv_id, position, turn, size) in order: whole conversations, SHARD rows or one more."""
    shard, rows = [], 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "position", "turn", "size")]
        for conv, position, turn, size in zip(*columns):
            if position < 0:  # the mark comes first
                if rows >= SHARD:
                    yield shard
                    shard, rows = [], 0
                shard.append((conv, []))
            else:
                shard[-1][1].append((turn, size))
            rows += 1
    if shard:
        yield shard


def shard_nodes(turns: DataFrame) -> DataFrame:
    """The nodes of every shard (``_NODE``)."""
    spark = turns.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    arrow = to_arrow_schema(StructType.fromDDL(_NODE))

    def run(batches):
        for shard in _shards(batches):
            found = walk(shard)
            for at in range(0, len(found), SHARD):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*found[at:at + SHARD]), arrow)], schema=arrow)

    return stage(turns.repartitionByRange(parts, "conv_id").sortWithinPartitions("conv_id", "position")
                 .mapInArrow(run, _NODE), "trie-shards")


_SUM = "node binary, parent long, children long, leaves long, saved long"


def _sums(batches):
    """Per node of a shard its share of children, leaves and saved bytes; rows come shard by shard, in order."""
    def of(rows):
        get = lambda i: np.array([r[i] for r in rows], dtype=np.int64)
        below, members, size, here, leaf = (get(i) for i in (3, 4, 5, 6, 7))
        up = np.array([-1 if r[2] is None else r[2] for r in rows])
        until = np.arange(len(rows)) + below + 1
        total = lambda x: (t := np.concatenate([[0], np.cumsum(x)]))[until] - t[:-1]
        children = np.bincount(up[(here == 1) & (up >= 0)], minlength=len(rows))
        # The smallest member of the parent, told by the shard that the node belongs to.
        parent = [rows[u][8] if h and u >= 0 else None for u, h in zip(up.tolist(), here.tolist())]
        return pa.RecordBatch.from_arrays([
            pa.array([r[1] for r in rows], pa.binary()), pa.array(parent, pa.int64()), pa.array(children, pa.int64()),
            pa.array(total(leaf * here), pa.int64()), pa.array(total((members - here) * size), pa.int64()),
        ], ["node", "parent", "children", "leaves", "saved"])

    names = ("shard", "node", "parent", "below", "members", "size", "here", "leaf", "owner")
    rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in names]))
    for _, own in groupby(rows, itemgetter(0)):
        yield of(list(own))


def nodes(turns: DataFrame) -> DataFrame:
    """The trie of (conv_id, position, turn, size): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 of every node."""
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local = shard_nodes(turns)
    # A node has one row in a shard, so the largest group is the number of shards.
    whole = local.groupBy("node").agg(
        F.min("least").alias("owner"), F.first("depth").alias("depth"), F.sum("members").alias("n_convs"),
        (F.max("children") == 0).cast("long").alias("leaf"))
    whole = stage(whole, "trie-nodes")
    known = local.select("shard", "idx", "node", "parent", "below", "members", "size", "least").join(
        whole.select("node", "owner", "leaf"), "node").withColumn("here", (F.col("least") == F.col("owner")).cast("long"))
    shares = known.repartition(parts, "shard").sortWithinPartitions("shard", "idx").mapInArrow(_sums, _SUM)
    summed = shares.groupBy("node").agg(
        F.max("parent").alias("parent_conv_id"), F.sum("children").alias("n_children"),
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = joined_sha256(local.where("ends IS NOT NULL"), "node", ["shard"], "ends", ",")
    return whole.join(summed, "node").join(ends, "node", "left").select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return nodes(rebuilt(conversations))


#: crc32 bit by bit, as DuckDB has no such function.
_CRC = """xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(len(s) * 8), lambda k: k)),
        lambda crc, k: CASE WHEN (xor(crc, CASE WHEN k % 8 = 0 THEN ascii(s[(k // 8 + 1)::INT]) ELSE 0 END)) & 1 = 1
            THEN xor(xor(crc, CASE WHEN k % 8 = 0 THEN ascii(s[(k // 8 + 1)::INT]) ELSE 0 END) >> 1, 3988292384)
            ELSE xor(crc, CASE WHEN k % 8 = 0 THEN ascii(s[(k // 8 + 1)::INT]) ELSE 0 END) >> 1 END))"""

SQL = f"""
WITH RECURSIVE own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) - 1 AS p
    FROM conversations WHERE conv_id IS NOT NULL
), names AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h
    FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM own)
), turns AS (
    SELECT n.conv_id, 0 AS part, p, role, text FROM names n JOIN own o ON o.conv_id = n.base AND p < h
    UNION ALL
    SELECT n.conv_id, 1 AS part, p, role, text FROM names n JOIN own o ON o.conv_id = n.conv_id AND p >= h
), placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d,
           md5(len(role) || ':' || role || text) AS t, strlen(text) AS bytes FROM turns
), paths AS (
    SELECT conv_id, 0::BIGINT AS d, '' AS node, NULL::VARCHAR AS above, 0::BIGINT AS bytes FROM names
    UNION ALL
    SELECT conv_id, p.d, md5(node || t), node, p.bytes FROM paths q JOIN placed p USING (conv_id) WHERE p.d = q.d + 1
), nodes AS (
    SELECT node, d, min(conv_id) AS least, count(*) AS n, any_value(above) AS above, any_value(bytes) AS bytes
    FROM paths GROUP BY node, d
), kids AS (
    SELECT above AS node, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above
), last AS (
    SELECT conv_id, max(d) AS d FROM paths GROUP BY conv_id
), ends AS (
    SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
    FROM paths JOIN last USING (conv_id, d) GROUP BY node
), below AS (
    SELECT o.node, sum((u.n - 1) * u.bytes) AS saved, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves
    FROM paths o JOIN nodes m ON m.node = o.node JOIN paths v ON v.conv_id = o.conv_id AND v.d >= o.d
    JOIN nodes u ON u.node = v.node AND u.least = v.conv_id LEFT JOIN kids k ON k.node = u.node
    GROUP BY o.node
)
SELECT m.least AS conv_id, m.d AS depth, a.least AS parent_conv_id, m.n AS n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes m JOIN below b ON b.node = m.node LEFT JOIN nodes a ON a.node = m.above LEFT JOIN kids k ON k.node = m.node
LEFT JOIN ends e ON e.node = m.node
"""
