"""Incremental sync as Structured Streaming jobs.

Each job takes a streaming change log and a checkpoint folder in shared storage.  Output folders
carry the batch id, and a batch that is run again after a failure overwrites its own folder, so
every result is written exactly once.
"""

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsync import schemas
from starsync.functions import exprs
from starsync.functions.exprs import UPDATE
from starsync.operators import pending, replay
from starsync.operators.receipts import to_ranges, unreceived
from starsync.session import scratch, stage
from starsync.sources.store import Store, rewrite_touched, touched_buckets

CELL = ["ident", "uid", "field"]

# Gap-wide slots of a row's sessions that one task may sort.
SLOT_BLOCK = 4096


def _run(stream, checkpoint, each_batch, mode="append", trigger=None):
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(each_batch)
        .start()
    )


def _earlier(spark, path, batch_id, schema):
    """Rows of the batches before this one (their folders are complete by then)."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).filter(F.col("batch") < batch_id)


def stream_pending(log: DataFrame, relations: DataFrame, sync_tables: DataFrame, clone: str,
                   out: str, receipts: str, checkpoint: str, uid="uid", trigger=None):
    """What a clone has to receive, as the log grows: one sync round per micro-batch.

    The stream's own progress replaces the high-water mark, so events that commit late are not
    lost; receipts of earlier batches, kept as ranges of ids, drop repeated deliveries.
    """
    receipt_schema = T.StructType(
        [*schemas.RECEIPT_RANGES.fields, T.StructField("batch", T.LongType())]
    )

    def each_batch(batch, batch_id):
        spark = batch.sparkSession
        with scratch(spark):
            rows = stage(batch, "stream_batch")
            # Older receipts cannot match: the scan skips them by the statistics of their files.
            low = rows.agg(F.min("event_id")).first()[0]
            seen = _earlier(spark, receipts, batch_id, receipt_schema).filter(
                (F.col("server_id") == clone) & (F.col("hi") >= F.lit(low).cast("long")))
            mine = rows.dropDuplicates(["event_id"]).filter(
                pending.not_from(clone) & pending.allowed(sync_tables, clone))
            news = unreceived(mine, seen, F.lit(low).cast("long") - 1)
            changes = stage(pending.to_field_grain(news, relations, uid), "stream_pending")
            changes.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            to_ranges(replay.mark_replayed(changes, clone, f"batch-{batch_id}")).write.mode(
                "overwrite").parquet(f"{receipts}/batch={batch_id}")

    return _run(log, checkpoint, each_batch, trigger=trigger)


def stream_dedup(log: DataFrame, out: str, checkpoint: str, lateness: str, trigger=None):
    """Each event once, however often it is delivered within the allowed lateness.

    State holds the ids of that time span only.  Repeats that come later still are caught by the
    receipts of ``stream_pending``; first deliveries that come later are in ``stream_late``.
    """
    return (
        log.withWatermark("tstamp_tx", lateness)
        .dropDuplicatesWithinWatermark(["event_id"])
        .writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_late(log: DataFrame, late: str, marks: str, checkpoint: str, lateness: str,
                trigger=None):
    """The side output of ``stream_dedup``: deliveries at or below the watermark.

    The watermark of a batch is the newest time of the batches before it, in whole milliseconds,
    less ``lateness``; each batch leaves its newest time in ``marks``.  On the same source with the
    same trigger this holds all that ``stream_dedup`` drops as late.  Spark applies a new watermark
    one batch later, so it may store some of these all the same: ``late_first`` tells them apart.
    Deliveries without a time are never late.
    """
    mark_schema = "newest timestamp, batch long"

    def each_batch(batch, batch_id):
        spark = batch.sparkSession
        with scratch(spark):
            rows = stage(batch, "stream_late")
            newest = _earlier(spark, marks, batch_id, mark_schema).agg(
                F.max("newest").alias("t")).scalar()
            watermark = F.timestamp_millis(F.unix_millis(newest)) - F.expr(f"interval {lateness}")
            rows.filter(F.col("tstamp_tx") <= watermark).write.mode("overwrite").parquet(
                f"{late}/batch={batch_id}")
            rows.agg(F.max("tstamp_tx").alias("newest")).write.mode("overwrite").parquet(
                f"{marks}/batch={batch_id}")

    return _run(log, checkpoint, each_batch, trigger=trigger)


def late_first(late: DataFrame, stored: DataFrame) -> DataFrame:
    """Events that came late and never in time: one row of ``late`` for each id not in ``stored``."""
    return late.dropDuplicates(["event_id"]).join(
        stored.select("event_id"), "event_id", "left_anti").select(*late.columns)


def watermark_metrics(query) -> list:
    """How far a query's watermark trails the newest event, and the rows dropped behind it, by batch.

    Read from the progress that Spark keeps of the latest batches; the lag is NULL for batches
    without rows.
    """
    def seconds(text):
        return datetime.fromisoformat(text).timestamp()

    out = []
    for progress in query.recentProgress:
        times = progress["eventTime"]
        lag = seconds(times["max"]) - seconds(times["watermark"]) if "max" in times else None
        dropped = sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
        out.append({"batch": progress["batchId"], "lag_seconds": lag, "dropped": dropped})
    return out


def stream_latest(changes: DataFrame, out: str, checkpoint: str, trigger=None):
    """Running last value of every cell; read the result with ``latest_cells``.

    A stateful aggregation with one entry per live cell and partial results before the shuffle.
    Every batch writes only the cells it changed.
    """
    latest = (
        changes.filter(F.col("action") == UPDATE).groupBy(*CELL)
        .agg(F.max_by(F.struct("event_id", "value"), F.col("event_id")).alias("cell"))
        .select(*CELL, "cell.event_id", "cell.value")
    )

    def each_batch(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _run(latest, checkpoint, each_batch, mode="update", trigger=trigger)


def latest_cells(updates: DataFrame) -> DataFrame:
    """The current cell values from the updates that ``stream_latest`` wrote."""
    return (
        updates.groupBy(*CELL)
        .agg(F.max_by(F.struct("event_id", "value"), F.col("event_id")).alias("cell"))
        .select(*CELL, "cell.event_id", "cell.value")
    )


def stream_retry(log: DataFrame, store: Store, table: str, dead_letters: str,
                 relations: DataFrame, keys, local_keys, checkpoint: str, uid="uid",
                 slice_size=replay.LOG_SLICE, trigger=None):
    """Replay a growing log onto a table; changes that fail are tried again with the next batch.

    Only the failed changes wait in the dead letters, so what applied once is never applied again
    over later edits.  Table, dead letters and the progress of this stream (named by its checkpoint)
    on this table are committed together, so a batch that is delivered again after its commit
    changes nothing, whatever else was committed in between.
    """
    progress = f"{table}/progress"

    def each_batch(batch, batch_id):
        tx = store.begin()
        done = store.read(progress, schemas.PROGRESS).collect()  # one row for each stream
        last = max((r.batch_id for r in done if r.stream == checkpoint), default=-1)
        if batch_id <= last:
            return
        with scratch(batch.sparkSession):
            waiting = store.read(dead_letters, schemas.CHANGE_LOG)
            events = stage(waiting.unionByName(batch.select(*waiting.columns)), "stream_retry")
            changes = pending.to_field_grain(events, relations, uid)
            result = replay.replay(store.read(table), changes, keys, local_keys,
                                   slice_size=slice_size, keep=stage)
            hit = touched_buckets(store, table, result.effects, uid)
            rewrite_touched(tx, table, result.snapshot if hit is None else replay.apply_effects(
                store.read_buckets(table, hit), result.effects, keys, local_keys), uid, hit)
            tx.overwrite(dead_letters, replay.failed_parts(events, result.statuses))
            others = [tuple(r) for r in done if r.stream != checkpoint]
            tx.overwrite(progress, batch.sparkSession.createDataFrame(
                [*others, (checkpoint, batch_id)], schemas.PROGRESS))
        tx.commit(f"batch-{batch_id}")

    return _run(log, checkpoint, each_batch, trigger=trigger)


def stream_sessions(log: DataFrame, gap_seconds: int, out: str, checkpoint: str, lateness: str,
                    uid="uid", trigger=None):
    """``activity_sessions`` as the log grows: a session is written once, when it is over.

    It is over when the watermark (the newest time less ``lateness``) has passed its last event by
    the gap.  Sessions that later events join are merged in the state, which holds the open ones only:
    one entry each, whatever the number of their events.  Events are merged in the tasks that read
    them before they move, so a row with a third of all events sends few rows.
    """
    # The end of a window is not part of it, and two events exactly a gap apart belong together.
    gap = f"{gap_seconds} seconds 1 microsecond"
    micros = F.unix_micros("tstamp_tx")
    sessions = (
        log.select(exprs.ident().alias("ident"), F.element_at("row_data", uid).alias("uid"),
                   "tstamp_tx")
        .withWatermark("tstamp_tx", lateness)
        .groupBy("ident", "uid", F.session_window("tstamp_tx", gap))
        .agg(F.min(micros).alias("first_micros"), F.max(micros).alias("last_micros"),
             F.count(F.lit(1)).alias("n_events"))
        .drop("session_window")
    )
    spark = log.sparkSession
    setting = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")  # a query takes its settings over when it starts
    try:
        return (
            sessions.writeStream.format("parquet").outputMode("append")
            .option("path", out).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start()
        )
    finally:
        spark.conf.set(setting, before)


def activity_windows(log: DataFrame, width: str, slide: str = None) -> DataFrame:
    """Events per table and tumbling (or, with ``slide``, sliding) window; batch or streaming."""
    span = F.window("tstamp_tx", width, slide) if slide else F.window("tstamp_tx", width)
    return (
        log.groupBy(exprs.ident().alias("ident"), span.alias("w"))
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(
            "ident", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "n_events",
        )
    )


def activity_sessions(log: DataFrame, gap_seconds: int, uid="uid") -> DataFrame:
    """Bursts of edits per row: events at most ``gap_seconds`` apart belong together.

    Events are first counted per row and gap-wide slot: neighbours inside a slot are closer than
    the gap, so a slot never has to be split.  Slots are then chained within blocks of
    ``SLOT_BLOCK`` of them, and what a block inherits from earlier ones (the last event, the start
    of the open session) comes from one summary per row and block.  So no task sorts more than a
    block of any row, however long the row has been edited.
    """
    micros = F.unix_micros("tstamp_tx")
    gap = gap_seconds * 1_000_000
    row = ["ident", "uid"]
    slots = (
        log.select(
            exprs.ident().alias("ident"), F.element_at("row_data", uid).alias("uid"),
            micros.alias("t"),
        )
        .groupBy(*row, F.floor(F.col("t") / gap).alias("slot"))
        .agg(F.min("t").alias("first"), F.max("t").alias("last"),
             F.count(F.lit(1)).alias("n"))
    )
    slots = slots.withColumn("block", F.floor(F.col("slot") / SLOT_BLOCK))
    inside = Window.partitionBy(*row, "block").orderBy("slot")
    blocks = Window.partitionBy(*row).orderBy("block")
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    # Within a block: a slot opens a session when it is too far from the one before it.
    chained = slots.withColumn("apart", F.col("first") - F.lag("last").over(inside) > gap)
    edges = (
        chained.groupBy(*row, "block").agg(
            F.min("first").alias("head"), F.max("last").alias("tail"),
            F.max(F.when(F.col("apart"), F.col("first"))).alias("opened"))
        .withColumn("head_opens", F.coalesce(
            F.col("head") - F.lag("tail").over(blocks) > gap, F.lit(True)))
        .withColumn("start", F.coalesce(
            "opened", F.when(F.col("head_opens"), F.col("head"))))
        .withColumn("inherited", F.when(F.col("head_opens"), F.col("head")).otherwise(
            F.last("start", ignorenulls=True).over(before)))
        .select(*row, "block", "inherited")
    )
    # A session is named by the time of its first event.
    named = chained.join(
        edges.withColumnsRenamed({"ident": "_ident", "uid": "_uid", "block": "_block"}),
        (F.col("ident") == F.col("_ident")) & F.col("uid").eqNullSafe(F.col("_uid"))
        & (F.col("block") == F.col("_block")),
    ).withColumn("session", F.coalesce(
        F.last(F.when(F.col("apart"), F.col("first")), ignorenulls=True).over(inside), "inherited"))
    return (
        named.groupBy(*row, "session")
        .agg(F.min("first").alias("first_micros"), F.max("last").alias("last_micros"),
             F.sum("n").alias("n_events"))
        .drop("session")
    )
