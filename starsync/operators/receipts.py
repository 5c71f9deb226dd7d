"""Receipts as ranges of event ids.

A clone sees nearly all events of its tables, so its receipts are long runs of consecutive ids.
Stored as (server_id, lo, hi), such a run is one row, whatever its length.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsync.schemas import RECEIPT_RANGES

#: Event ids of a block: what a task sorts of a clone at a time, and the key ranges meet a log on.
BLOCK = 4096


def _block(event_id):
    return F.floor(F.col(event_id) / BLOCK)


def _islands(ranges, keys):
    """Overlapping or adjacent ranges of the same ``keys`` as one."""
    order = Window.partitionBy(*keys).orderBy("lo", "hi")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.withColumn("_opens", F.coalesce(
            F.col("lo") > F.max("hi").over(before) + 1, F.lit(True)).cast("long"))
        .withColumn("_island", F.sum("_opens").over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*keys, "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("_island")
    )


def _by_block(ranges):
    """Ranges cut at the borders of the blocks they reach into."""
    return ranges.withColumn(
        "block", F.explode(F.sequence(_block("lo"), _block("hi")))
    ).select(
        "server_id", "block",
        F.greatest("lo", F.col("block") * BLOCK).alias("lo"),
        F.least("hi", F.col("block") * BLOCK + (BLOCK - 1)).alias("hi"),
    )


def to_ranges(receipts: DataFrame) -> DataFrame:
    """The fewest ranges that hold the ids of the receipts, each clone for itself.

    Receipts are rows with an ``event_id``, or ranges themselves (to merge what several rounds
    appended).  Runs are found inside blocks of ids first, in one shuffle by clone and block; only runs
    that touch the border of their block, at most two per block, are chained over blocks.  So no
    task sorts all receipts of a clone.  Repeated ids count once, rows without an id or a clone are
    no receipts.
    """
    if "event_id" in receipts.columns:
        ranges = receipts.select("server_id", F.col("event_id").alias("lo"),
                                 F.col("event_id").alias("hi"))
    else:
        ranges = receipts.select(*RECEIPT_RANGES.names)
    ranges = ranges.filter(F.col("server_id").isNotNull() & (F.col("lo") <= F.col("hi")))
    inside = _islands(_by_block(ranges), ["server_id", "block"])
    border = ((F.col("lo") == F.col("block") * BLOCK)
              | (F.col("hi") == F.col("block") * BLOCK + (BLOCK - 1)))
    chained = _islands(inside.filter(border).drop("block"), ["server_id"])
    return inside.filter(~border).drop("block").unionByName(chained).select(*RECEIPT_RANGES.names)


def to_events(ranges: DataFrame) -> DataFrame:
    """One receipt per event again."""
    return ranges.select("server_id", F.explode(F.sequence("lo", "hi")).alias("event_id"))


def unreceived(log: DataFrame, ranges: DataFrame, after=None) -> DataFrame:
    """Rows of ``log`` whose id is in none of the ranges (those of one clone).

    An anti join on the block of the id, with the bounds as its condition: a block has at most
    ``BLOCK`` ids, so no key is hot and few ranges meet an event.  What ends at or before ``after``, a
    bound of the log's ids, is not cut into blocks.
    """
    if after is not None:
        ranges = ranges.filter(F.col("hi") > after).withColumn(
            "lo", F.greatest("lo", after + 1))
    held = _by_block(ranges).select(
        F.col("block").alias("_block"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    return log.join(
        held, (_block("event_id") == F.col("_block"))
        & F.col("event_id").between(F.col("_lo"), F.col("_hi")), "left_anti")
