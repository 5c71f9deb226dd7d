"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A benchmark item is cut into windows of ``WINDOW`` consecutive words; a text contains a window if all
its shingles (``SHINGLE`` words) stand there in place.  As containment has to be whole, one shingle of
a window is a sufficient prefix, and the best one is the rarest:

1. the shingles of all windows are counted over all documents; a window with a shingle that occurs
   nowhere cannot occur and is dropped;
2. each window that is left is filed under its rarest shingle (ties by hash, one order for all);
3. the documents' shingles are joined with these prefixes.  The window's place in the document follows
   from the shingle's, and has to lie inside the document (positional and length bound);
4. what is left is verified word by word.

Texts never move: the join's other side is a block of at most ``BLOCK`` windows that is broadcast, and a
benchmark of more windows is joined in several blocks, all rows against each.  Occurrences are
gathered by a 128-bit key of the text, so that copies of a text count once, and the items of a set of
windows are looked up once for all documents with that set.

Defined cases: a null text has no words; an item without words has no windows; an item of fewer than
``WINDOW`` words is one window; an item without an id makes words hit but is in no list; items that share an
id are one; rows are returned as often as they stand in ``docs``, null ids as well; an empty table
gives no rows; other columns are ignored.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsync.session import stage

WINDOW = 10
SHINGLE = 3
#: Most rows (some 200 bytes each) of the table that is broadcast to a join.
BLOCK = 100_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _split(df: DataFrame) -> DataFrame:
    """Replace ``text`` by ``words``: its words in lower case (A-Z only)."""
    parts = df.withColumn("_parts", F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower()), BETWEEN))
    # A separator at either end leaves an empty part there.
    before = (F.get("_parts", F.lit(0)) == "").cast("int")
    after = (F.element_at("_parts", -1) == "").cast("int")
    n = F.greatest(F.size("_parts") - before - after, F.lit(0))
    return parts.withColumn("words", F.slice("_parts", before + 1, n)).drop("_parts", "text")


def _name(at: Column, width) -> Column:
    """The hash of the ``width`` words from place ``at`` on (null words do not count in it)."""
    parts = [F.get("words", at + i) if isinstance(width, int) else
             F.when(F.lit(i) < width, F.get("words", at + i))
             for i in range(width if isinstance(width, int) else SHINGLE)]
    return F.xxhash64(*parts)


def windows(items: DataFrame, window=WINDOW) -> DataFrame:
    """(item_id, win, words): the distinct windows of every item; ``win`` names the word sequence."""
    found = _split(items.select("item_id", "text")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    each = found.select(
        "item_id", "words", size.alias("k"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("i"))
    cut = each.select("item_id", F.slice("words", F.col("i") + 1, F.col("k")).alias("words"))
    return cut.withColumn("win", F.md5(F.array_join("words", " "))).distinct()


def _key() -> list:
    """A text's name in 128 bits."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _shingles(docs: DataFrame, widths) -> DataFrame:
    """(k1, k2, words, p, h): every shingle of every document, by its place and hash."""
    n = F.size("words")
    # No filter behind the explosion: it would be pulled in front of it, and texts split again for it.
    places = F.when(n >= min(widths), F.sequence(F.lit(0), n - min(widths)))
    spots = _split(docs.select(*_key(), "text")).select("k1", "k2", "words", F.explode(places).alias("p"))
    if len(widths) == 1:
        return spots.withColumn("h", _name(F.col("p"), widths[0]))
    named = F.array(*[F.when(F.col("p") + k <= n, _name(F.col("p"), k)) for k in widths])
    # Built-in steps with generated code throughout: rows with whole word lists are never copied.
    return spots.withColumn("h", F.explode(named))


def _blocks(df: DataFrame, name) -> list:
    """``df`` (distinct by ``name``) in parts of at most BLOCK rows: hashed parts filled to a half of it."""
    n = max(1, math.ceil(2 * df.count() / BLOCK)) if df.count() > BLOCK else 1
    return [df.where(F.pmod(F.xxhash64(F.lit(7), name), F.lit(n)) == i) if n > 1 else df for i in range(n)]


def prefixes(docs: DataFrame, wins: DataFrame, widths) -> DataFrame:
    """(win, words, h, o): the distinct windows that can occur, with their rarest shingle and its place."""
    k = F.least(F.size("words"), F.lit(SHINGLE))
    each = wins.select("win", "words").distinct().select(
        "win", "words", k.alias("k"), F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("o"))
    each = stage(each.select("win", "words", "o", _name(F.col("o"), F.col("k")).alias("h")), "leak-shingles")
    names = stage(each.select("h").distinct(), "leak-names")
    counts = None
    for block in _blocks(names, "h"):
        found = _shingles(docs, widths).select("h").join(F.broadcast(block), "h", "left_semi")
        counts = found if counts is None else counts.union(found)
    counts = counts.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    ranked = each.join(counts, "h", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "o")).alias("least"), F.first("words").alias("words"))
    return ranked.where("least.n > 0").select("win", "words", "least.h", "least.o")


def occurrences(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(k1, k2, start, size, win): every place of every window in the distinct texts of ``docs``."""
    short = wins.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("k")).distinct()
    widths = sorted(r.k for r in short.collect()) or [SHINGLE]  # 1, 2 or 3
    filed = stage(prefixes(docs, wins, widths), "leak-prefixes")
    found = None
    for block in _blocks(filed, "win"):
        side = block.select("win", "h", "o", F.col("words").alias("window"), F.size("words").alias("size"))
        met = _shingles(docs, widths).join(F.broadcast(side), "h").withColumn("start", F.col("p") - F.col("o"))
        inside = (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.size("words"))
        # The bounds first: a slice has to start inside the text.
        whole = F.when(inside, F.slice("words", F.greatest("start", F.lit(0)) + 1, F.col("size")) == F.col("window"))
        part = met.where(whole).select("k1", "k2", "start", "size", "win")
        found = part if found is None else found.union(part)
    return found.distinct()


def _covered(found: DataFrame) -> DataFrame:
    """(k1, k2, n_hit, wins): words inside occurrences, and the sorted windows of each text.

    A group is the occurrences in one text: no more than its words times the window sizes.
    """
    before = Window.partitionBy("k1", "k2").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    new = end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0)))
    return found.withColumn("new", F.greatest(new, F.lit(0))).groupBy("k1", "k2").agg(
        F.sum("new").alias("n_hit"), F.array_sort(F.collect_set("win")).alias("wins"))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row for each row of ``docs``."""
    wins = stage(windows(items), "leak-windows")
    texts = _covered(occurrences(docs, wins)).withColumn("set", F.md5(F.array_join("wins", "")))
    texts = stage(texts, "leak-texts")
    # Documents with the same passages have the same set of windows: its items are looked up once.
    sets = texts.groupBy("set").agg(F.first("wins").alias("wins")).select("set", F.explode("wins").alias("win"))
    listed = (
        sets.join(wins.where("item_id IS NOT NULL").select("win", "item_id"), "win").select("set", "item_id").distinct()
        .groupBy("set").agg(
            F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("ids"))
        .select("set", "n_items", F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    )
    known = texts.join(listed, "set", "left").select("k1", "k2", "n_hit", "n_items", "items_sha256")
    counted = _split(docs.select("doc_id", *_key(), "text")).select(
        "doc_id", "k1", "k2", F.size("words").cast("long").alias("n_words"))
    return counted.join(known, ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


SQL = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, [x FOR x IN string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
    FROM documents
), item AS (
    SELECT item_id, [x FOR x IN string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i + 1:i + least(len(w), 10)], ' ') AS t
    FROM (SELECT item_id, w, unnest(range(len(w) - least(len(w), 10) + 1)) AS i FROM item WHERE len(w) > 0)
), gram AS (
    SELECT r, i, k, array_to_string(w[i + 1:i + k], ' ') AS t
    FROM (SELECT r, w, k, unnest(range(greatest(len(w) - k + 1, 0))) AS i FROM doc, (SELECT DISTINCT k FROM win))
), met AS (
    SELECT r, i, g.k, item_id FROM gram g JOIN win USING (k, t)
), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM met) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
