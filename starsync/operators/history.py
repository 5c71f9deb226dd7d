"""Sync rounds: current state, high-water marks and lag."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Status and type names of a sync round.
PENDING, DONE = "pending", "done"
FULL, PARTIAL = "full", "partial"

_OPENING = ("sync_time", "server_from", "min_event_id", "max_event_id", "max_tstamp_tx",
            "sync_type")


def fold_history(records: DataFrame) -> DataFrame:
    """Current state of every round from append-only open / status / add-server records.

    The latest status wins, servers are appended in record order and a round without servers
    keeps a NULL list.  One aggregation on ``sync_id`` with map-side partial results; the list of
    a round holds at most one entry per clone.
    """
    seq = F.col("seq")
    servers = F.array_sort(
        F.collect_list(
            F.when(F.col("server_to").isNotNull(), F.struct("seq", "server_to"))
        )
    )
    opening = F.min_by(F.struct(*_OPENING), F.when(F.col("sync_time").isNotNull(), seq))
    folded = records.groupBy("sync_id").agg(
        opening.alias("_open"),
        F.when(F.size(servers) > 0, F.transform(servers, lambda s: s["server_to"]))
        .alias("server_to"),
        F.max_by("sync_status", F.when(F.col("sync_status").isNotNull(), seq))
        .alias("sync_status"),
    )
    return folded.select(
        "sync_id", *[F.col("_open")[c].alias(c) for c in _OPENING], "server_to", "sync_status"
    )


def last_sync(history: DataFrame, central: str) -> DataFrame:
    """Per clone, the mark left by its newest finished round from the centre.

    All clones in one aggregation.  Equal times are decided by the larger event id, then sync id.
    """
    newest = F.struct("sync_time", "max_event_id", "sync_id", "max_tstamp_tx")
    return (
        history.filter((F.col("server_from") == central) & (F.col("sync_status") == DONE))
        .select(F.explode("server_to").alias("clone_id"), newest.alias("round"))
        .groupBy("clone_id")
        .agg(F.max("round").alias("round"))
        .select(
            "clone_id",
            F.col("round.sync_id").alias("sync_id"),
            F.col("round.sync_time").alias("sync_time"),
            F.col("round.max_event_id").alias("max_event_id"),
            F.col("round.max_tstamp_tx").alias("max_tstamp_tx"),
        )
    )


def _below(bounds, value):
    """How many of the sorted, distinct ``bounds`` are less than ``value`` (none if it is NULL).

    A search by halves: as many steps as the length of the array has bits.
    """
    steps = F.reverse(F.transform(_levels(F.size(bounds)), lambda b: _power(b)))
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (n + step <= F.size(bounds)) & (F.get(bounds, n + step - 1) < value), n + step,
    ).otherwise(n))


def _levels(n):
    """0, 1, ... for each bit of the numbers 0 to ``n``."""
    return F.sequence(F.lit(0), F.length(F.bin(n)) - 1)


def _power(bit):
    return F.call_function("shiftleft", F.lit(1), bit.cast("int"))


def _at_level(number, bit):
    return F.call_function("shiftright", number, bit.cast("int"))


def sync_lag(history: DataFrame, log: DataFrame, central: str) -> DataFrame:
    """How many log events lie past each clone's mark (both larger id and later time).

    Counted as dominance in the plane of (id, time).  Each event is reduced to two ranks, the
    number of distinct marks below its id and below its time, found by halves in two sorted arrays
    of marks (the one thing that travels to the log scan: two values per clone).  Events of equal
    ranks are counted together before the shuffle.  The ranks by id are covered by dyadic ranges: an
    event stands in at most one range per bit, and the ids past a mark are the disjoint union of at most
    one range per bit.  Inside a range one window in the order of time gives the running counts.
    So the work after the scan is about (classes + clones) times the bits of the number of clones.

    Marks or events without an id or a time have nothing past them and are past nothing.
    """
    marks = last_sync(history, central).select("clone_id", "max_event_id", "max_tstamp_tx")

    def bounds(column):
        return marks.agg(F.array_sort(F.collect_set(column)).alias("b")).scalar()

    def ranked(df, event_id, tstamp, *others):
        with_bounds = df.select(
            *others, F.col(event_id).alias("_id"), F.col(tstamp).alias("_time"),
            bounds("max_event_id").alias("_ids"), bounds("max_tstamp_tx").alias("_times"))
        return with_bounds.select(
            *others, "_id", "_time",
            _below(F.col("_ids"), F.col("_id")).alias("id_rank"),
            _below(F.col("_times"), F.col("_time")).alias("time_rank"))

    classes = (
        ranked(log, "event_id", "tstamp_tx")
        .groupBy("id_rank", "time_rank").agg(F.count(F.lit(1)).alias("n"))
    )
    levels = _levels(F.size(bounds("max_event_id")))
    # An event whose rank is a lies past the mark of rank r if a > r: a is in the right half of the
    # dyadic range that holds both, and r in its left half.
    points = classes.select(
        "time_rank", "n", "id_rank", F.explode(levels).alias("level")
    ).select(
        "level", _at_level(F.col("id_rank"), F.col("level")).alias("range"), "time_rank", "n"
    ).filter(F.col("range") % 2 == 1).groupBy("level", "range", "time_rank").agg(
        F.sum("n").alias("n"))
    asked = (
        ranked(marks, "max_event_id", "max_tstamp_tx", "clone_id")
        .filter(F.col("_id").isNotNull() & F.col("_time").isNotNull())
        .select("clone_id", "time_rank", "id_rank", F.explode(levels).alias("level"))
        .withColumn("left", _at_level(F.col("id_rank"), F.col("level")))
        .filter(F.col("left") % 2 == 0)
        .select("level", (F.col("left") + 1).alias("range"), "time_rank", "clone_id")
    )
    # Later times first, and at equal ranks the mark before the events: those are not past it.
    sweep = Window.partitionBy("level", "range").orderBy(
        F.desc("time_rank"), F.col("clone_id").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    counted = (
        points.withColumn("clone_id", F.lit(None).cast("string"))
        .unionByName(asked.withColumn("n", F.lit(0).cast("long")))
        .withColumn("past", F.sum("n").over(sweep))
        .filter(F.col("clone_id").isNotNull())
        .groupBy("clone_id").agg(F.sum("past").alias("n_events"))
    )
    return marks.join(counted, "clone_id", "left").select(
        "clone_id", "max_event_id", F.coalesce("n_events", F.lit(0)).alias("n_events")
    )
