"""Compaction, conflict detection and resolution at the grain of one cell.

Every step is an aggregation with map-side partial results or a join on keys made unique by that
aggregation, so a row edited by a third of the log costs one partial row per task, not one task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync.functions.exprs import CENTRAL, CLONE, LAST_MODIFIED, UPDATE
from starsync.functions.render import update_statement
from starsync.operators.registry import keys_of

CELL = ["ident", "uid", "field"]
_SIDE = ("event_id", "tstamp_tx", "orig_micros", "value")
CHANGE_KEY = ["ident", "action", "field", "uid"]


def sync_bounds(pending: DataFrame) -> DataFrame:
    """Number of events, smallest and largest id and latest time; NULLs when nothing is pending.

    Taken before compaction, on events (not on field changes).  The ids themselves stay a
    DataFrame: ``pending.select("event_id")``.
    """
    return pending.agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("event_id").alias("min_event_id"),
        F.max("event_id").alias("max_event_id"),
        F.max("tstamp_tx").alias("max_tstamp_tx"),
    )


def _last(columns):
    return F.max_by(F.struct(*columns), F.col("event_id"))


def compact(changes: DataFrame, mode="updates") -> DataFrame:
    """Keep the last change by event id for each (table, action, column, row).

    ``reference`` also collapses inserts and deletes, as the original semantics do; with delete,
    insert, delete of one row that leaves an insert that hits a live row.  ``updates`` leaves
    inserts and deletes alone and gives the same final rows without that trap.
    """
    if mode not in ("updates", "reference"):
        raise ValueError(f"unknown compaction mode {mode!r}")
    rest = [c for c in changes.columns if c not in CHANGE_KEY]
    foldable = changes.filter(F.col("action") == UPDATE) if mode == "updates" else changes
    folded = (
        foldable.groupBy(*CHANGE_KEY).agg(_last(rest).alias("_last"))
        .select(*[
            F.col(c) if c in CHANGE_KEY else F.col("_last")[c].alias(c) for c in changes.columns
        ])
    )
    if mode == "reference":
        return folded
    return folded.unionByName(changes.filter(F.col("action") != UPDATE))


def _rejected(central_time, clone_time):
    """Last edit wins; the centre wins ties."""
    return F.when(clone_time <= central_time, CLONE).otherwise(CENTRAL)


def detect_conflicts(central: DataFrame, clone: DataFrame) -> DataFrame:
    """Pairs of updates of the same cell, one from each side (both compacted before).

    Inserts and deletes never conflict.
    """
    def side(df, prefix):
        return df.filter(F.col("action") == UPDATE).select(
            *CELL, *[F.col(c).alias(f"{prefix}_{c}") for c in _SIDE]
        )

    return side(central, CENTRAL).join(side(clone, CLONE), CELL)


def resolve(conflicts: DataFrame, rule=LAST_MODIFIED) -> DataFrame:
    """Name the rejected side of each conflict."""
    if rule != LAST_MODIFIED:
        raise ValueError(f"unknown conflict rule {rule!r}")
    rejected = _rejected(F.col("central_orig_micros"), F.col("clone_orig_micros"))
    return conflicts.withColumn("rejected", rejected).withColumn("rule_applied", F.lit(rule))


def drop_rejected(changes: DataFrame, conflicts: DataFrame, side: str) -> DataFrame:
    """The changes of one side without its losers."""
    losers = conflicts.filter(F.col("rejected") == side).select(
        *CELL, F.lit(UPDATE).alias("action")
    )
    return changes.join(losers, [*CELL, "action"], "left_anti").select(*changes.columns)


def reconcile(central: DataFrame, clone: DataFrame, mode="updates") -> DataFrame:
    """Compaction of both sides, pairing and resolution in a single shuffle.

    One row per (table, action, column, row) with the last change of each side as a struct
    (``central``, ``clone``; NULL when that side has none) and ``rejected`` for conflicts.  Gives
    what ``compact``, ``detect_conflicts``, ``resolve`` and ``drop_rejected`` give one by one.
    In ``updates`` mode inserts and deletes keep one row per event.
    """
    columns = [c for c in central.columns if c not in CHANGE_KEY]
    key = list(CHANGE_KEY)
    both = central.withColumn("_side", F.lit(CENTRAL)).unionByName(
        clone.withColumn("_side", F.lit(CLONE))
    )
    if mode == "updates":
        # An event-grain key part keeps inserts and deletes of one row apart.
        both = both.withColumn(
            "_event", F.when(F.col("action") != UPDATE, F.struct("_side", "event_id"))
        )
        key.append("_event")

    def last_of(side):
        mine = F.col("_side") == side
        return F.max_by(F.struct(*columns), F.when(mine, F.col("event_id"))).alias(side)

    paired = both.groupBy(*key).agg(last_of(CENTRAL), last_of(CLONE))
    conflict = (
        (F.col("action") == UPDATE) & F.col("uid").isNotNull() & F.col("field").isNotNull()
        & F.col(CENTRAL).isNotNull() & F.col(CLONE).isNotNull()
    )
    rejected = F.when(
        conflict, _rejected(F.col("central.orig_micros"), F.col("clone.orig_micros"))
    )
    return paired.withColumn("rejected", rejected).select(
        *CHANGE_KEY, CENTRAL, CLONE, "rejected"
    )


def survivors(reconciled: DataFrame, side: str) -> DataFrame:
    """Field changes of one side that won or were never disputed."""
    fields = reconciled.schema[side].dataType.names
    return reconciled.filter(
        F.col(side).isNotNull() & ~F.col("rejected").eqNullSafe(side)
    ).select(*CHANGE_KEY, *[F.col(side)[c].alias(c) for c in fields])


def reconciled_conflicts(reconciled: DataFrame, rule=LAST_MODIFIED) -> DataFrame:
    """The conflicts of ``reconcile`` in the shape of ``resolve``."""
    return reconciled.filter(F.col("rejected").isNotNull()).select(
        *CELL,
        *[F.col(s)[c].alias(f"{s}_{c}") for s in (CENTRAL, CLONE) for c in _SIDE],
        "rejected",
        F.lit(rule).alias("rule_applied"),
    )


def conflict_ledger(conflicts: DataFrame, relations: DataFrame, clone_id: str,
                    conflict_time=None, uid_column="uid") -> DataFrame:
    """Resolved conflicts in the ledger schema, with the statements of both sides."""
    now = F.current_timestamp() if conflict_time is None else F.lit(conflict_time)
    return conflicts.withColumn("keys", keys_of(relations, F.col("ident"))).select(
        now.cast("timestamp").alias("conflict_time"),
        "ident", "uid", "field",
        F.lit(clone_id).alias("clone_id"),
        F.col("central_event_id"),
        F.col("central_tstamp_tx").alias("central_tstamp"),
        update_statement(F.col("central_value"), uid_column).alias("central_sql"),
        update_statement(F.col("clone_value"), uid_column).alias("clone_sql"),
        "rejected", "rule_applied",
    )


def conflict_report(ledger: DataFrame, by=("ident", "clone_id", "rejected")) -> DataFrame:
    """Number of conflicts by table, clone, losing side, or any other ledger column."""
    return ledger.groupBy(*by).agg(F.count(F.lit(1)).alias("n_conflicts"))
