"""Ordered replay of row changes as a set-based fold.

Applying inserts, updates and deletes one after the other is expressed with one window that finds
each change's predecessor and with aggregations that keep the last value per cell:

* a row is alive before a change when the last insert or delete before it was an insert, or, if
  there was none, when the snapshot holds the row (a failed insert leaves the row alive, so it
  can count as a success here);
* an insert on a live row is a uniqueness error, an update or delete on a missing row does
  nothing, everything else is applied;
* the row survives when its last applied insert (its birth; the snapshot counts as one) comes
  after its last applied delete, and a cell keeps the last update after the birth.

Rows are identified by ``keys``; changes carry these columns plus ``event_id, action, field,
value, row_data`` and optionally ``noop``, ``tstamp_tx`` and ``orig_micros``.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsync.functions import exprs, maps
from starsync.functions.exprs import DELETE, INSERT, UPDATE
from starsync.operators.numbering import largest, number_rows
from starsync.schemas import RECEIPTS

# Outcome of one change.
APPLIED = "applied"
NO_MATCH = "no_match"
NOOP = "noop"
UNIQUE_VIOLATION = "unique_violation"
BAD_VALUE = "bad_value"
KEY_UPDATE = "key_update"
NO_TABLE = "no_table"
ERRORS = (UNIQUE_VIOLATION, BAD_VALUE, KEY_UPDATE, NO_TABLE)

# Event ids per slice of the log when one row may own a large share of it: a slice is the most a
# single task ever sorts for one row.
LOG_SLICE = 1_000_000


class ReplayError(Exception):
    """A batch that must apply as a whole holds a change that cannot be applied."""


@dataclass
class Replay:
    """Result of a replay: the new snapshot, the outcome of every change, and the net effects."""

    snapshot: DataFrame
    statuses: DataFrame
    effects: DataFrame


def _is_misfit(schema: T.StructType, keys) -> Column:
    """Text that its target column cannot hold; folds to false when all columns are text."""
    bad_update, bad_insert = F.lit(False), F.lit(False)
    for f in schema.fields:
        if f.name in keys or isinstance(f.dataType, T.StringType):
            continue
        bad_update = bad_update | (
            (F.col("field") == f.name) & exprs.misfit(F.col("value"), f.dataType)
        )
        bad_insert = bad_insert | exprs.misfit(F.element_at("row_data", f.name), f.dataType)
    return F.coalesce(
        F.when(F.col("action") == UPDATE, bad_update)
        .when(F.col("action") == INSERT, bad_insert),
        F.lit(False),
    )


def known_outcome(schema: T.StructType, keys, local_keys, has_noop=True) -> Column:
    """The outcome of a change where it does not depend on other changes, else NULL."""
    noop = F.coalesce(F.col("noop"), F.lit(False)) if has_noop else F.lit(False)
    for k in keys:
        noop = noop | F.col(k).isNull()
    is_update = F.col("action") == UPDATE
    return (
        F.when(
            noop | ~F.col("action").isin(INSERT, UPDATE, DELETE)
            | (is_update & F.col("field").isin(list(local_keys))),
            NOOP,
        )
        .when(is_update & F.col("field").isin(list(keys)), KEY_UPDATE)
        .when(is_update & ~F.coalesce(F.col("field").isin(schema.names), F.lit(False)), BAD_VALUE)
        .when(_is_misfit(schema, [*keys, *local_keys]), BAD_VALUE)
    )


def _classify(snapshot, changes, keys, local_keys):
    outcome = known_outcome(snapshot.schema, keys, local_keys, "noop" in changes.columns)
    return changes.withColumn("_known", outcome)


def _switch(column="action"):
    """The action when it may change whether the row exists, else NULL."""
    usable = F.col("_known").isNull() & F.col("action").isin(INSERT, DELETE)
    return F.when(usable, F.col(column))


def _touched_rows(snapshot, changes, keys):
    """Which of the changed rows the snapshot holds, reading only its key columns.

    The left side of the semi join is the large table, so a small set of changes is broadcast by
    the runtime planner and the table is scanned in place.
    """
    touched = changes.select(*keys).distinct()
    return snapshot.select(*keys).join(touched, list(keys), "left_semi").withColumn(
        "_in_base", F.lit(True)
    )


def _with_status(changes, existing, keys, slice_size):
    """Add ``status`` to classified changes.

    With ``slice_size`` the window runs per row and slice of the log; what a slice inherits from
    the earlier ones comes from a second window over one summary per row and slice, which also
    picks up the snapshot's answer.  The changes themselves are shuffled once, and no task sorts
    more than a slice of any row.  Without it (few changes per row, as after compaction) a row is
    one slice.  Changes already decided, among them all those without a key, get a slice each, so
    they are spread evenly.
    """
    keys = list(keys)
    undecided = F.col("_known").isNull()
    position = (
        F.lit(0) if slice_size is None else F.floor(F.col("event_id") / F.lit(slice_size))
    ).cast("long")
    sliced = changes.withColumn(
        "_slice", F.when(undecided, position).otherwise(-1 - F.col("event_id"))
    )
    if slice_size is None:
        inherited = existing.select(
            *keys, F.lit(0).cast("long").alias("_slice"),
            F.lit(None).cast("string").alias("_carry"), "_in_base",
        )
    else:
        summary = sliced.filter(undecided).groupBy(*keys, "_slice").agg(
            F.max_by(_switch(), _switch("event_id")).alias("_last")
        )
        earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
            Window.unboundedPreceding, -1
        )
        inherited = (
            summary.withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier))
            .drop("_last")
            .join(existing, keys, "left")
        )
    inside = Window.partitionBy(*keys, "_slice").orderBy("event_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    seen = (
        sliced.withColumn("_local", F.last(_switch(), ignorenulls=True).over(inside))
        .join(inherited, [*keys, "_slice"], "left")
        .withColumn("_prev", F.coalesce("_local", "_carry"))
    )
    alive = F.coalesce(F.col("_prev") == INSERT, F.col("_in_base"), F.lit(False))
    outcome = (
        F.when(F.col("_known").isNotNull(), F.col("_known"))
        .when((F.col("action") == INSERT) & alive, UNIQUE_VIOLATION)
        .when((F.col("action") != INSERT) & ~alive, NO_MATCH)
        .otherwise(APPLIED)
    )
    return seen.select(*[c for c in changes.columns if c != "_known"], outcome.alias("status"))


def replay_status(snapshot: DataFrame, changes: DataFrame, keys=("uid",), local_keys=(),
                  slice_size=LOG_SLICE) -> DataFrame:
    """Outcome of every change when all are applied in event order."""
    known = _classify(snapshot, changes, keys, local_keys)
    existing = _touched_rows(snapshot, changes, keys)
    return _with_status(known, existing, keys, slice_size)


def _lives(statuses, keys):
    """Last applied insert and delete of each row (partial results per task)."""
    applied = statuses.filter(
        (F.col("status") == APPLIED) & F.col("action").isin(INSERT, DELETE)
    )
    event = F.col("event_id")
    born = F.when(F.col("action") == INSERT, event)
    died = F.when(F.col("action") == DELETE, event)
    return applied.groupBy(*keys).agg(
        F.max(born).alias("birth"),
        F.max(died).alias("death"),
        F.max_by("row_data", born).alias("birth_row"),
        F.max_by("orig_micros", born).alias("birth_micros"),
        F.max_by("orig_micros", died).alias("death_micros"),
    )


def _cells(changes, keys):
    """Last usable update of each cell, gathered to one map per row (as long as its columns)."""
    updates = changes.filter((F.col("action") == UPDATE) & F.col("_known").isNull())
    last = updates.groupBy(*keys, "field").agg(
        F.max_by(F.struct("value", "event_id", "orig_micros"), F.col("event_id")).alias("cell")
    )
    return last.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("field", "cell"))).alias("cells")
    )


def _net_effects(changes, statuses, existing, keys):
    """One row per changed row: does it exist before and after, and which cells are new."""
    keys = list(keys)
    in_base = F.coalesce("_in_base", F.lit(False))
    reborn = F.col("birth").isNotNull()
    alive = F.when(F.col("death").isNull(), reborn | in_base).otherwise(
        F.coalesce(F.col("birth") > F.col("death"), F.lit(False))
    )
    live_cells = F.map_filter(
        F.coalesce(F.col("cells"), F.expr(
            "cast(map() as map<string, struct<value:string,event_id:bigint,orig_micros:bigint>>)"
        )),
        lambda _, c: F.col("birth").isNull() | (c["event_id"] > F.col("birth")),
    )
    return (
        _lives(statuses, keys)
        .join(_cells(changes, keys), keys, "full_outer")
        .join(existing, keys, "left")
        .select(
            *keys, "birth", "death", "birth_row", "birth_micros", "death_micros",
            in_base.alias("before"),
            alive.alias("after"),
            (alive & reborn).alias("fresh"),
            live_cells.alias("cells"),
        )
        .filter(F.col("before") | F.col("after"))
    )


def _new_value(field: T.StructField, otherwise: Column) -> Column:
    cell = F.element_at("cells", field.name)
    return F.when(
        F.map_contains_key("cells", field.name), exprs.typed(cell["value"], field.dataType)
    ).otherwise(otherwise)


def inserted_rows(snapshot: DataFrame, effects: DataFrame, keys=("uid",), local_keys=(),
                  number_local=False) -> DataFrame:
    """The rows that the net effects insert, as they are stored, with ``_birth`` (the inserting
    event) and ``_micros`` (its edit time).

    With ``number_local`` each row gets a new local key, counted on from the largest one in order
    of insertion; otherwise local keys are NULL.
    """
    keys, local_keys = list(keys), list(local_keys)
    rows = effects.filter("fresh").select(
        *[
            F.col(f.name) if f.name in keys
            else F.lit(None).cast(f.dataType).alias(f.name) if f.name in local_keys
            else _new_value(f, exprs.typed(F.element_at("birth_row", f.name), f.dataType))
            .alias(f.name)
            for f in snapshot.schema.fields
        ],
        F.col("birth").alias("_birth"), F.col("birth_micros").alias("_micros"),
    )
    if number_local and not rows.isEmpty():
        for key in local_keys:
            rows = assign_local_ids(rows, key, snapshot, ["_birth", *keys])
    return rows


def apply_effects(snapshot: DataFrame, effects: DataFrame, keys=("uid",), local_keys=(),
                  number_local=False, inserted: DataFrame = None) -> DataFrame:
    """The snapshot after the net effects.

    The table is the left side of a left join, so a small set of effects is broadcast at run time
    and the table is neither shuffled nor exploded into cells.  Inserted rows need no join; give
    those of ``inserted_rows`` when they are used elsewhere, too.
    """
    keys, local_keys = list(keys), list(local_keys)
    fields = snapshot.schema.fields
    plain = [f for f in fields if f.name not in keys and f.name not in local_keys]
    changed = effects.filter("before").select(*keys, "after", "fresh", "cells")
    kept = (
        snapshot.join(changed, keys, "left")
        .filter(F.coalesce(F.col("after") & ~F.col("fresh"), F.lit(True)))
        .select(*[
            F.when(F.col("cells").isNull(), F.col(f.name))
            .otherwise(_new_value(f, F.col(f.name))).alias(f.name) if f in plain
            else F.col(f.name)
            for f in fields
        ])
    )
    if inserted is None:
        inserted = inserted_rows(snapshot, effects, keys, local_keys, number_local)
    return kept.unionByName(inserted.select(*snapshot.columns))


def assign_local_ids(rows: DataFrame, column: str, target: DataFrame, order_by) -> DataFrame:
    """Give inserted rows fresh local ids, after the largest one of the target, in replay order."""
    start = F.coalesce(largest(target, column), F.lit(0)).cast("long")
    numbered = number_rows(rows.drop(column), order_by, column, start)
    return numbered.withColumn(column, F.col(column).cast(target.schema[column].dataType))


def fold(known: DataFrame, key_rows: DataFrame, keys, slice_size=LOG_SLICE, keep=None):
    """Statuses and net effects of classified changes.

    ``key_rows`` holds the keys of the snapshot, or of many snapshots when the keys include the
    table name: then one job folds the changes of all tables.
    """
    keep = keep or (lambda df, name: df)
    existing = _touched_rows(key_rows, known, keys)
    statuses = keep(_with_status(known, existing, keys, slice_size), "statuses")
    effects = keep(_net_effects(known, statuses, existing, keys), "effects")
    return statuses, effects


def replay(snapshot: DataFrame, changes: DataFrame, keys=("uid",), local_keys=(),
           slice_size=LOG_SLICE, number_local=False, keep=None) -> Replay:
    """Apply changes to a snapshot in event order.

    ``keep`` may name a function ``(df, name) -> df`` that stores an intermediate result, used for
    the statuses and the net effects; without it the plan stays lazy throughout.
    """
    if "orig_micros" not in changes.columns:
        changes = changes.withColumn("orig_micros", F.lit(None).cast("long"))
    known = _classify(snapshot, changes, keys, local_keys)
    statuses, effects = fold(known, snapshot, keys, slice_size, keep)
    after = apply_effects(snapshot, effects, keys, local_keys, number_local)
    return Replay(after, statuses, effects)


def failures(statuses: DataFrame) -> DataFrame:
    return statuses.filter(F.col("status").isin(*ERRORS))


def require_clean(statuses: DataFrame) -> None:
    """Raise unless every change can be applied."""
    failed = failures(statuses).select("event_id", "action", "status").limit(1).collect()
    if failed:
        raise ReplayError(
            f"event {failed[0].event_id} ({failed[0].action}): {failed[0].status}"
        )


def replay_to_clone(snapshot: DataFrame, changes: DataFrame, keys=("uid",), local_keys=(),
                    **options) -> Replay:
    """All-or-nothing replay at a clone: any error aborts the batch.  Leaves no log rows."""
    result = replay(snapshot, changes, keys, local_keys, **options)
    require_clean(result.statuses)
    return result


def effect_events(snapshot: DataFrame, effects: DataFrame, ident: str, origin: str,
                  keys=("uid",), tstamp=None, inserted: DataFrame = None) -> DataFrame:
    """Log events for the net effects of a replay at the centre, stamped with their origin.

    ``inserted`` are the inserted rows as they were stored (``inserted_rows``), so an insert is
    logged with the local key that the row has at the centre.
    One update per changed cell with the edit time of that cell, so that later rounds compare
    with the moment the clone edited it; one insert or delete per row.  A cell that already held
    the value gives no event.  ``order_key`` holds the replayed event id for ``order_events``.
    """
    keys = list(keys)
    names = snapshot.columns
    schema_name, table_name = ident.split(".", 1)
    base = snapshot.select(*keys, F.struct(*names).alias("_old"))
    paired = base.join(effects.filter("before"), keys, "inner")
    old_row = maps.row_map(names, F.col("_old"))
    empty = F.lit(None).cast("map<string,string>")

    def event(action, order, micros, row, changed=empty):
        return F.struct(
            F.lit(action).alias("action"), order.alias("order_key"), micros.alias("micros"),
            row.alias("row_data"), changed.alias("changed_fields"),
        )

    updates = F.array_compact(F.array(*[
        F.when(
            F.map_contains_key("cells", f.name)
            & ~F.col("_old")[f.name].eqNullSafe(
                exprs.typed(F.element_at("cells", f.name)["value"], f.dataType)
            ),
            event(
                UPDATE,
                F.element_at("cells", f.name)["event_id"],
                F.element_at("cells", f.name)["orig_micros"],
                old_row,
                F.create_map(
                    F.lit(f.name),
                    exprs.typed(F.element_at("cells", f.name)["value"], f.dataType)
                    .cast("string"),
                ),
            ),
        )
        for f in snapshot.schema.fields if f.name not in keys
    ]))
    died = F.array(event(DELETE, F.col("death"), F.col("death_micros"), old_row))
    ended = ~F.col("after") | F.col("fresh")
    gone_or_changed = paired.select(F.explode(
        F.when(ended, died).otherwise(updates)
    ).alias("e"))
    if inserted is None:
        inserted = inserted_rows(snapshot, effects, keys)
    new_row = F.map_from_arrays(
        F.array(*[F.lit(c) for c in names]), F.array(*[F.col(c).cast("string") for c in names]))
    born = inserted.select(
        event(INSERT, F.col("_birth"), F.col("_micros"), new_row).alias("e")
    )
    now = F.current_timestamp() if tstamp is None else F.lit(tstamp).cast("timestamp")
    text = F.lit(None).cast("string")
    return gone_or_changed.unionByName(born).select(
        F.col("e.order_key").alias("order_key"),
        F.lit(None).cast("long").alias("event_id"),
        F.lit(schema_name).alias("schema_name"),
        F.lit(table_name).alias("table_name"),
        text.alias("session_user"),
        now.alias("tstamp_tx"), now.alias("tstamp_stm"), now.alias("tstamp_clk"),
        F.lit(None).cast("long").alias("tx_id"),
        text.alias("client_query"),
        F.col("e.action").alias("action"),
        F.col("e.row_data").alias("row_data"),
        F.col("e.changed_fields").alias("changed_fields"),
        F.lit(False).alias("statement_only"),
        F.struct(
            F.lit(origin).alias("origin"),
            F.timestamp_micros("e.micros").alias("orig_tstamp"),
        ).alias("sync"),
    )


def retain_failed(log: DataFrame, statuses: DataFrame) -> DataFrame:
    """The clone log after a round: events with a failed change stay, whole."""
    failed = failures(statuses).select("event_id").distinct()
    return log.join(failed, "event_id", "left_semi").select(*log.columns)


def failed_parts(log: DataFrame, statuses: DataFrame) -> DataFrame:
    """The failed changes of a log: updates keep only the columns that failed.

    So what did apply is not applied again, over later edits, when the rest is retried.
    """
    failed = failures(statuses).groupBy("event_id").agg(F.collect_set("field").alias("_failed"))
    kept = F.map_filter("changed_fields", lambda k, _: F.array_contains("_failed", k))
    return (
        log.join(failed, "event_id")
        .withColumn("changed_fields", F.when(F.size("_failed") > 0, kept)
                    .otherwise(F.col("changed_fields")))
        .select(*log.columns)
    )


def mark_replayed(events: DataFrame, clone: str, sync_id: str) -> DataFrame:
    """Receipts: this clone has seen these events (one receipt per event)."""
    return events.select("event_id").distinct().select(
        "event_id", F.lit(clone).alias("server_id"), F.lit(sync_id).alias("sync_id")
    ).select(*RECEIPTS.names)


def _keyed(log, ident, keys):
    """Events of one table with their key columns taken from the logged row."""
    schema_name, table_name = ident.split(".", 1)
    return log.filter(
        (F.col("schema_name") == schema_name) & (F.col("table_name") == table_name)
    ).select(
        *[F.element_at("row_data", k).alias(k) for k in keys],
        "event_id", "tstamp_tx", "action", "row_data", "changed_fields",
    )


def _typed_keys(changes, snapshot, keys):
    for k in keys:
        changes = changes.withColumn(k, exprs.typed(F.col(k), snapshot.schema[k].dataType))
    return changes


def _cell_changes(events):
    return events.select(
        "*", F.explode_outer(F.map_entries("changed_fields")).alias("_c")
    ).select(
        *[c for c in events.columns if c != "changed_fields"],
        F.col("_c.key").alias("field"), F.col("_c.value").alias("value"),
    )


def replay_events(snapshot: DataFrame, log: DataFrame, ids: DataFrame, ident: str, keys,
                  **options) -> Replay:
    """Replay chosen events by primary key, with all columns including the key."""
    chosen = _keyed(log, ident, keys).join(ids.select("event_id"), "event_id", "left_semi")
    changes = _typed_keys(_cell_changes(chosen), snapshot, keys)
    return replay(snapshot, changes, keys, **options)


def rollback_guard(log: DataFrame, ids: DataFrame, keys, slice_size=LOG_SLICE) -> DataFrame:
    """For each chosen event: may it be rolled back, and if not, which event came later.

    Only the latest event of a row may be (time decides, then event id).  The latest event is
    found per row and slice of the log, with partial results per task, and then over the slices of
    a row; chosen events look it up in their own slice.  So no task holds more than a slice of any
    row, however many events it has.
    """
    row = ["ident", *keys]
    events = log.select(
        exprs.ident().alias("ident"), F.col("event_id"), F.col("tstamp_tx"),
        *[F.element_at("row_data", k).alias(k) for k in keys],
        F.floor(F.col("event_id") / F.lit(slice_size)).alias("_slice"),
    )
    for k in keys:  # events without a row (truncates) cannot be rolled back
        events = events.withColumn(
            "_slice", F.when(F.col(k).isNull(), -1 - F.col("event_id")).otherwise(F.col("_slice"))
        )
    latest = (
        events.dropna(subset=list(keys)).groupBy(*row, "_slice")
        .agg(F.max(F.struct("tstamp_tx", "event_id")).alias("_last"))
        .withColumn("_last", F.max("_last").over(Window.partitionBy(*row)))
    )
    chosen = events.join(ids.select("event_id"), "event_id", "left_semi")
    allowed = F.coalesce(F.col("event_id") == F.col("_last.event_id"), F.lit(False))
    return chosen.join(latest, [*row, "_slice"], "left").select(
        "event_id", *row,
        allowed.alias("allowed"),
        F.when(~allowed, F.col("_last.event_id")).alias("newer_event_id"),
    )


def rollback_events(snapshot: DataFrame, log: DataFrame, ids: DataFrame, ident: str, keys,
                    **options) -> Replay:
    """Undo chosen events by applying their inverse.

    An insert is undone by a delete, a delete by inserting the old row, an update by restoring
    the old values of the columns it changed.  Events that ``rollback_guard`` refuses are left
    alone; check it first to report them.
    """
    schema_name, table_name = ident.split(".", 1)
    own = log.filter(
        (F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))
    guard = rollback_guard(own, ids, keys).filter("allowed").select("event_id")
    chosen = _keyed(log, ident, keys).join(guard, "event_id", "left_semi")
    restored = F.map_filter(
        F.col("row_data"), lambda k, _: F.map_contains_key("changed_fields", k)
    )
    inverse = chosen.withColumn("changed_fields", F.when(F.col("action") == UPDATE, restored))
    inverse = inverse.withColumn(
        "action",
        F.when(F.col("action") == INSERT, DELETE).when(F.col("action") == DELETE, INSERT)
        .otherwise(F.col("action")),
    )
    changes = _typed_keys(_cell_changes(inverse), snapshot, keys)
    return replay(snapshot, changes, keys, **options)
