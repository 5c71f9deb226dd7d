"""What a clone still has to receive, and what it has to send."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsync.functions import exprs, maps
from starsync.functions.exprs import DELETE, INSERT, TRUNCATE, UPDATE
from starsync.operators.history import last_sync
from starsync.operators.receipts import unreceived
from starsync.operators.registry import keys_of


def whitelist(sync_tables: DataFrame, clone: str) -> DataFrame:
    """Tables this clone may receive, one row each (repeats in the stored list collapse)."""
    return (
        sync_tables.filter(F.col("server_id") == clone)
        .select(F.explode("tables").alias("table_name"))
        .distinct()
    )


def allowed(sync_tables: DataFrame, clone: str) -> Column:
    """Condition on a log row: its table is on the clone's list.

    The list is a scalar sub-query (as long as the number of tables), so the log is filtered in
    its scan stage without a join on the few, possibly very frequent, table names.
    """
    names = whitelist(sync_tables, clone).agg(F.collect_list("table_name").alias("t")).scalar()
    return F.array_contains(names, exprs.quoted_ident())


def not_from(clone: str) -> Column:
    """Condition on a log row: it does not replay an edit of this clone."""
    origin = F.col("sync.origin")
    return origin.isNull() | (origin != clone)


def pending_central(log: DataFrame, receipts: DataFrame, history: DataFrame,
                    sync_tables: DataFrame, clone: str, central: str,
                    use_marks=True) -> DataFrame:
    """Events at the centre that ``clone`` has not seen.

    They do not come from the clone, have no receipt from it, lie past its mark in both id and
    time, and concern its tables.  Without a finished round there is no mark and nothing is
    pending.  The mark is a scalar sub-query, so both bounds reach the Parquet scans of the log
    and (for the id) of the receipts, and old row groups are skipped.

    Receipts are one row per event, or ranges of ids as ``receipts.to_ranges`` makes them.

    ``use_marks=False`` relies on receipts alone, which also finds events that committed late.
    """
    events = log.filter(not_from(clone) & allowed(sync_tables, clone))
    seen = receipts.filter(F.col("server_id") == clone)
    last_id = None
    if use_marks:
        mark = last_sync(history, central).filter(F.col("clone_id") == clone)
        last_id = mark.select("max_event_id").scalar()
        last_time = mark.select("max_tstamp_tx").scalar()
        events = events.filter(
            (F.col("tstamp_tx") > last_time) & (F.col("event_id") > last_id)
        )
    return _unseen(events, seen, last_id).select(*log.columns)


def _unseen(events, seen, last_id=None):
    if "event_id" not in seen.columns:
        return unreceived(events, seen, last_id)
    if last_id is not None:
        seen = seen.filter(F.col("event_id") > last_id)
    return events.join(seen.select("event_id"), "event_id", "left_anti")


def pending_clone(log: DataFrame) -> DataFrame:
    """Events of a clone: the whole log, which is emptied after each round."""
    return log


def late_events(log: DataFrame, receipts: DataFrame, history: DataFrame,
                sync_tables: DataFrame, clone: str, central: str) -> DataFrame:
    """Events a clone never received although its mark has passed them.

    A long transaction keeps its start time, so it can commit at or below a mark; the strict
    bounds of ``pending_central`` then skip it for good.  This reports such events (to be told
    apart from rows that a full package already contained, when its id bound is known).
    """
    mark = last_sync(history, central).filter(F.col("clone_id") == clone)
    last_id = mark.select("max_event_id").scalar()
    last_time = mark.select("max_tstamp_tx").scalar()
    passed = (F.col("event_id") <= last_id) | (F.col("tstamp_tx") <= last_time)
    events = log.filter(not_from(clone) & allowed(sync_tables, clone) & passed)
    return _unseen(events, receipts.filter(F.col("server_id") == clone)).select(*log.columns)


def to_field_grain(log: DataFrame, relations: DataFrame, uid="uid", excluded=()) -> DataFrame:
    """One row per changed column of an update; one row without a field for other events.

    ``noop`` marks changes whose statement would be empty (truncate, update of a local key or of
    an excluded column, table without registered keys, missing uid): they count, but do nothing.
    Only inserts keep ``row_data`` (without the excluded columns): an update is one cell and a
    delete one uid, so the old rows need not travel on.  Needs no shuffle: everything happens
    inside the row.
    """
    excluded = list(excluded)
    exploded = (
        log.select(
            "event_id",
            "tstamp_tx",
            exprs.ident().alias("ident"),
            "action",
            exprs.origin_label().alias("origin_label"),
            F.element_at("row_data", uid).alias("uid"),
            F.when(F.col("action") == INSERT, maps.drop_keys(F.col("row_data"), excluded))
            .alias("row_data"),
            exprs.effective_time().alias("orig_micros"),
            F.explode_outer(F.map_entries("changed_fields")).alias("_change"),
        )
        .withColumn("field", F.col("_change.key"))
        .withColumn("value", F.col("_change.value"))
        .drop("_change")
    )
    keys = keys_of(relations, F.col("ident"))
    field_is_hidden = F.array_contains(keys, F.col("field"))
    if excluded:
        field_is_hidden = field_is_hidden | F.col("field").isin(excluded)
    noop = (
        (F.col("action") == TRUNCATE)
        | (keys.isNull() & (F.col("action") != DELETE))
        | ((F.col("action") != INSERT) & F.col("uid").isNull())
        | ((F.col("action") == UPDATE) & F.coalesce(field_is_hidden, F.lit(True)))
    )
    return exploded.withColumn("noop", noop)
