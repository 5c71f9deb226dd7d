"""Change capture: two snapshots of a table become insert, update and delete events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsync.functions import maps
from starsync.functions.exprs import DELETE, INSERT, TRUNCATE, UPDATE
from starsync.operators.numbering import largest, number_rows
from starsync.schemas import CHANGE_LOG

_TEXT_MAP = "map<string,string>"


def _column(value, data_type) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(data_type)


def _widened(old, new):
    """The old snapshot with the columns that only the new one has, as NULL.

    A column that only the old one has is refused: its values would be lost without an event.
    """
    missing = [c for c in old.columns if c not in new.columns]
    if missing:
        raise ValueError(f"columns only in the old snapshot: {missing}")
    added = [f for f in new.schema.fields if f.name not in old.columns]
    return old.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])


def _pair_up(old, new, uid):
    """One row per uid with both versions side by side (``o`` / ``n``, NULL when missing)."""
    o = old.select(F.col(uid).alias("_uid"), F.struct(*old.columns).alias("o"))
    n = new.select(F.col(uid).alias("_uid"), F.struct(*new.columns).alias("n"))
    return o.join(n, "_uid", "full_outer")


def _events(old, new, uid, ignored):
    """``action, row_data, changed_fields`` of every difference outside the ignored columns."""
    ignored = set(ignored)
    old = _widened(old.drop(*ignored - {uid}), new)
    names = [c for c in old.columns if c not in ignored]
    o, n = F.col("o"), F.col("n")
    differs = {c: ~o[c].eqNullSafe(n[c]) for c in names}
    any_change = F.lit(False)
    for cond in differs.values():
        any_change = any_change | cond
    action = (
        F.when(o.isNull(), INSERT).when(n.isNull(), DELETE).when(any_change, UPDATE)
    )
    old_row, new_row = maps.row_map(names, o), maps.row_map(names, n)
    changed = maps.changed_pairs([(c, cond, n[c]) for c, cond in differs.items()])
    return (
        _pair_up(old, new, uid)
        .withColumn("action", action)
        .filter(F.col("action").isNotNull())
        .select(
            "action",
            F.when(F.col("action") == INSERT, new_row).otherwise(old_row).alias("row_data"),
            F.when(F.col("action") == UPDATE, changed).alias("changed_fields"),
        )
    )


def _log_rows(events, ident, tstamp, tx_id, session_user, client_query, statement_only):
    schema_name, table_name = ident.split(".", 1)
    stamp = F.current_timestamp() if tstamp is None else tstamp
    values = {
        "event_id": None,
        "schema_name": schema_name,
        "table_name": table_name,
        "session_user": session_user,
        "tstamp_tx": stamp,
        "tstamp_stm": stamp,
        "tstamp_clk": stamp,
        "tx_id": tx_id,
        "client_query": client_query,
        "statement_only": statement_only,
        "sync": None,
        **{c: F.col(c) for c in ("action", "row_data", "changed_fields")},
    }
    return events.select(*[
        _column(values[f.name], f.dataType).alias(f.name) for f in CHANGE_LOG.fields
    ])


def capture_changes(old: DataFrame, new: DataFrame, ident: str, uid="uid", ignored=(),
                    tstamp=None, tx_id=None, session_user=None, client_query=None) -> DataFrame:
    """The row events that turn ``old`` into ``new``, in the change-log schema.

    An insert carries the new row; an update the old row plus the new values of the changed
    columns; a delete the old row.  Ignored columns appear nowhere, and an update that changes
    nothing else is not logged.  A column that only ``new`` has was NULL before.  ``event_id`` stays
    NULL until ``order_events`` assigns it.

    One full outer join on the unique ``uid``; values are compared typed, and only rows that
    differ are turned into text maps.
    """
    events = _events(old, new, uid, ignored)
    return _log_rows(events, ident, tstamp, tx_id, session_user, client_query, False)


def capture_statements(old: DataFrame, new: DataFrame, ident: str, uid="uid", ignored=(),
                       tstamp=None, tx_id=None, session_user=None, client_query=None) -> DataFrame:
    """Statement-level log: one event per kind of change and no row values.

    A table emptied as a whole is one truncate.  Everything is counted in a single pass with
    map-side partial sums.
    """
    ignored = set(ignored)
    old = _widened(old.drop(*ignored - {uid}), new)
    names = [c for c in old.columns if c not in ignored]
    o, n = F.col("o"), F.col("n")
    same = F.lit(True)
    for c in names:
        same = same & o[c].eqNullSafe(n[c])
    counts = _pair_up(old, new, uid).agg(
        F.count_if(n.isNotNull()).alias("rows_new"),
        F.count_if(o.isNotNull()).alias("rows_old"),
        F.count_if(o.isNull()).alias(INSERT),
        F.count_if(o.isNotNull() & n.isNotNull() & ~same).alias(UPDATE),
        F.count_if(n.isNull()).alias(DELETE),
    )
    emptied = (F.col("rows_new") == 0) & (F.col("rows_old") > 0)
    kinds = F.when(emptied, F.array(F.lit(TRUNCATE))).otherwise(F.array_compact(F.array(*[
        F.when(F.col(k) > 0, F.lit(k)) for k in (INSERT, UPDATE, DELETE)
    ])))
    events = counts.select(F.explode(kinds).alias("action")).select(
        "action",
        F.lit(None).cast(_TEXT_MAP).alias("row_data"),
        F.lit(None).cast(_TEXT_MAP).alias("changed_fields"),
    )
    return _log_rows(events, ident, tstamp, tx_id, session_user, client_query, True)


def stamp_provenance(log: DataFrame, origin=None, orig_tstamp=None) -> DataFrame:
    """Fill in who made an edit and when, for events that replay somebody else's edit."""
    sync = F.struct(
        _column(origin, "string").alias("origin"),
        _column(orig_tstamp, "timestamp").alias("orig_tstamp"),
    )
    return log.withColumn("sync", sync)


def provenance_receipts(log: DataFrame, server_to, sync_id) -> DataFrame:
    """Receipts for stamped events: the receiving server has them already.

    Without a receiver and a sync id there is nothing to record.
    """
    server_to, sync_id = _column(server_to, "string"), _column(sync_id, "string")
    return log.select(
        "event_id", server_to.alias("server_id"), sync_id.alias("sync_id")
    ).filter(F.col("server_id").isNotNull() & F.col("sync_id").isNotNull())


def order_events(log: DataFrame, order_by, retained: DataFrame = None, start=0) -> DataFrame:
    """Assign increasing event ids in capture order.

    Ids go on from the largest id still retained or from ``start``, whichever is larger, so a node
    that stores its last id never gives one twice, also after its log was emptied.
    ``order_by`` must be unique together (for instance time, then uid).
    """
    first = F.lit(start)
    if retained is not None:
        first = F.greatest(largest(retained, "event_id"), first)  # skips NULL
    return number_rows(log.drop("event_id"), order_by, "event_id", first).select(*log.columns)
