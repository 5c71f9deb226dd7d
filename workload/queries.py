"""Registered queries: every operator over whole given tables, in a flat comparable form.

Maps and structs never leave a query; rows come out in long form, times as epoch micros.
"""

from datetime import datetime, timedelta
from functools import partial, wraps
from itertools import count

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsync import schemas
from starsync.functions import exprs
from starsync.functions.exprs import CENTRAL, CLONE
from starsync.operators import (
    capture, compare, history, pending, receipts, registry, replay, resolve,
)
from starsync.operators.render import render_sql
from starsync.session import run_all, stage, work_dir
from starsync.sources.files import export_csv, export_sql, read_feature_collection, read_features
from starsync.sources.store import Store, read_snapshot, write_snapshot
from starsync.plans import package as packages
from starsync.plans import sync
from starsync.streaming import jobs
from workload import derive as d

ROW = ("ident", "uid")
LOCAL = ("id",)
FIELDS = [*d.ROW_FIELDS, "note"]
NOW = datetime(2024, 3, 1)
QUERIES = {}


def query(fn):
    """Register a query; times are compared as UTC micros, so the session clock is pinned."""
    @wraps(fn)
    def run(spark, sf):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


# --- helpers -----------------------------------------------------------------------------------

def central_log(spark, sf):
    return d.prepared(spark, sf, d.central_log)


def clone_log(spark, sf):
    return d.prepared(spark, sf, d.clone_log)


def base_rows(spark, sf):
    return d.prepared(spark, sf, d.base_rows)


def _pairs(df, column, keys, label="field"):
    """A map column as one row per entry."""
    return df.select(*keys, F.explode_outer(F.map_entries(column)).alias("_e")).select(
        *keys, F.col("_e.key").alias(label), F.col("_e.value").alias("value")
    )


def _long(snapshot, fields=FIELDS, keys=ROW):
    """A snapshot as one row per cell."""
    return snapshot.unpivot(list(keys), list(fields), "field", "value")


def _pending(spark, sf, log=None):
    return pending.pending_central(
        log or central_log(spark, sf), d.receipts(spark, sf),
        history.fold_history(d.history_records(spark)), d.sync_tables(spark),
        d.CLONE_A, d.CENTRAL_ID,
    )


def _fields(spark, log, **options):
    return pending.to_field_grain(log, d.relations(spark), **options)


def _central_fields(spark, sf):
    return _fields(spark, _pending(spark, sf))


def _clone_fields(spark, sf):
    return _fields(spark, pending.pending_clone(clone_log(spark, sf)))


def _conflicts(spark, sf):
    return resolve.resolve(resolve.detect_conflicts(
        resolve.compact(_central_fields(spark, sf)), resolve.compact(_clone_fields(spark, sf))
    ))


def _all_changes(spark, sf):
    """Field changes of the whole log of the centre, written once for the steps of a replay."""
    return stage(_fields(spark, central_log(spark, sf)), "changes")


# --- capture and preparation -------------------------------------------------------------------

@query
def capture_changes(spark, sf):
    events = capture.capture_changes(d.orders_old(spark, sf), d.orders_new(spark, sf),
                                     "shop.orders")
    events = events.withColumn("uid", F.element_at("row_data", "uid"))
    rows = _pairs(events, "row_data", ["uid", "action"]).withColumn("part", F.lit("row"))
    new = _pairs(events.filter("action = 'U'"), "changed_fields", ["uid", "action"])
    return rows.unionByName(new.withColumn("part", F.lit("changed")))


@query
def capture_ignored(spark, sf):
    events = capture.capture_changes(
        d.orders_old(spark, sf), d.orders_new(spark, sf), "shop.orders",
        ignored=["batch", "cents", "no_such_column"],
    ).withColumn("uid", F.element_at("row_data", "uid"))
    return _pairs(
        events.withColumn("n_row_values", F.size("row_data")), "changed_fields",
        ["uid", "action", "n_row_values"],
    )


@query
def capture_noop(spark, sf):
    """Updates that change nothing, or only ignored columns, leave no event."""
    old, new = d.orders_old(spark, sf), d.orders_new(spark, sf)

    def count(label, **options):
        return capture.capture_changes(old, new, "shop.orders", **options).groupBy("action").agg(
            F.count(F.lit(1)).alias("n_events")).withColumn("ignoring", F.lit(label))

    return count("nothing").unionByName(count("batch", ignored=["batch"]))


@query
def capture_statements(spark, sf):
    old, new = d.orders_old(spark, sf), d.orders_new(spark, sf)
    edited = capture.capture_statements(old, new, "shop.orders")
    emptied = capture.capture_statements(old, new.filter(F.lit(False)), "shop.orders")

    def flat(events, label):
        return events.select(
            F.lit(label).alias("run"), "action", "statement_only",
            F.col("row_data").isNull().alias("no_values"),
        )

    return flat(edited, "edited").unionByName(flat(emptied, "emptied"))


@query
def stamp_provenance(spark, sf):
    log = clone_log(spark, sf)
    stamped = capture.stamp_provenance(log, d.CLONE_A, F.col("tstamp_tx"))
    given = capture.provenance_receipts(log, d.CENTRAL_ID, "round-1")
    return stamped.join(given, "event_id").select(
        "event_id", F.col("sync.origin").alias("origin"),
        F.unix_micros("sync.orig_tstamp").alias("orig_micros"), "server_id", "sync_id",
    )


@query
def order_events(spark, sf):
    """New ids in time order, after the largest id of a retained log."""
    log = clone_log(spark, sf).withColumn("tx_id", F.col("event_id"))
    ordered = capture.order_events(log, ["tstamp_tx", "tx_id"], retained=central_log(spark, sf))
    return ordered.select("event_id", F.col("tx_id").alias("old_event_id"))


def _returned(spark, sf):
    """Parts of which more pieces came back than stayed, over all lines."""
    back = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0))
    return (
        d.read(spark, sf, "lineitem").groupBy("l_partkey")
        .agg(back.alias("back"), F.sum("l_quantity").alias("pieces"))
        .filter(F.col("back") * 3 > F.col("pieces"))
    )


@query
def insert_if_absent(spark, sf):
    part = d.read(spark, sf, "part")
    keys = ["p_brand", "p_type", "p_size"]
    target = (
        part.join(_returned(spark, sf), F.col("p_partkey") == F.col("l_partkey"), "left_semi")
        .groupBy(*keys).agg(F.max("p_partkey").alias("first_part"))
    )
    rows = part.select(*keys, F.col("p_partkey").alias("first_part"))
    return registry.insert_if_absent(target, rows, keys)


def _inventory(spark, sf):
    name = F.concat("p_type", F.lit("_"), F.col("p_size").cast("string"))
    part = d.read(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").alias("schema_name"), name.alias("table_name")
    )
    relations = part.join(
        _returned(spark, sf), F.col("p_partkey") == F.col("l_partkey"), "left_semi"
    ).select(
        F.concat_ws(".", "schema_name", "table_name").alias("relation_name"),
        F.lit("id").alias("uid_column"),
    ).distinct()
    return part.select("schema_name", "table_name").distinct(), relations


@query
def missing_capture(spark, sf):
    return registry.missing_capture(*_inventory(spark, sf))


@query
def captured_tables(spark, sf):
    return registry.captured_tables(*_inventory(spark, sf))


@query
def add_uid(spark, sf):
    customers = d.read(spark, sf, "customer")
    with_uid, added = registry.add_uid(customers, ["c_custkey", "c_name"])
    unchanged, again = registry.add_uid(with_uid, ["c_custkey"])
    return unchanged.select("c_custkey", "uid").withColumn("added", F.lit(added)).withColumn(
        "added_again", F.lit(again))


def _columns(spark, sf):
    return d.read(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("schema_name"),
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("table_name"),
        F.when(F.col("c_acctbal") < 0, "uid").otherwise(F.col("c_name")).alias("column_name"),
    )


@query
def missing_uid(spark, sf):
    return registry.missing_uid(_columns(spark, sf))


@query
def check_uid_unique(spark, sf):
    line = F.concat_ws("|", F.col("l_orderkey").cast("string"),
                       F.col("l_linenumber").cast("string"))
    uid = F.when(F.col("l_quantity") < 50, F.md5(line))
    return registry.check_uid_unique(d.read(spark, sf, "lineitem").select(uid.alias("uid")))


# --- pending -----------------------------------------------------------------------------------

@query
def last_sync(spark, sf):
    rounds = history.fold_history(d.order_rounds(spark, sf))
    return history.last_sync(rounds, d.CENTRAL_ID).select(
        "clone_id", "sync_id", "max_event_id",
        F.unix_micros("sync_time").alias("sync_micros"),
        F.unix_micros("max_tstamp_tx").alias("max_micros"),
    )


@query
def whitelist(spark, sf):
    """The table list of the clone in the first nation, written twice and read once."""
    lists = d.table_lists(d.server_tables(spark, sf))
    return pending.whitelist(registry.merge_whitelist(lists, lists), "clone_0")


@query
def pending_central(spark, sf):
    return _pending(spark, sf).select(
        "event_id", exprs.ident().alias("ident"), "action",
        F.element_at("row_data", "uid").alias("uid"),
        F.unix_micros("tstamp_tx").alias("tx_micros"),
    )


@query
def pending_by_receipts(spark, sf):
    """The same without high-water marks: receipts alone decide."""
    return pending.pending_central(
        central_log(spark, sf), d.receipts(spark, sf),
        history.fold_history(d.history_records(spark)), d.sync_tables(spark),
        d.CLONE_A, d.CENTRAL_ID, use_marks=False,
    ).select("event_id", "action")


@query
def receipt_ranges(spark, sf):
    """The receipts of clone A, and the orders as receipts of their customers: runs of ids."""
    shipped = d.read(spark, sf, "orders").select(
        F.concat(F.lit("clone_"), (F.col("o_custkey") % 3).cast("string")).alias("server_id"),
        F.col("o_orderkey").alias("event_id"))
    return receipts.to_ranges(
        d.receipts(spark, sf).select("server_id", "event_id").unionByName(shipped))


@query
def pending_by_ranges(spark, sf):
    """What is pending for clone A when its receipts are stored as ranges."""
    return pending.pending_central(
        central_log(spark, sf), receipts.to_ranges(d.receipts(spark, sf)),
        history.fold_history(d.history_records(spark)), d.sync_tables(spark),
        d.CLONE_A, d.CENTRAL_ID, use_marks=False,
    ).select("event_id", "action")


@query
def pending_clone(spark, sf):
    return pending.pending_clone(clone_log(spark, sf)).select(
        "event_id", exprs.ident().alias("ident"), "action",
        F.size("changed_fields").alias("n_changed"),
        F.unix_micros("tstamp_tx").alias("tx_micros"),
    )


@query
def field_grain(spark, sf):
    return _fields(spark, central_log(spark, sf)).select(
        "event_id", "ident", "action", "origin_label", "field", "value", "uid", "orig_micros",
        "noop",
    )


@query
def effective_time(spark, sf):
    return central_log(spark, sf).select(
        "event_id", exprs.effective_time().alias("orig_micros"))


@query
def origin_label(spark, sf):
    return central_log(spark, sf).select(
        "event_id", exprs.origin_label().alias("origin_label"))


@query
def render_statements(spark, sf):
    return render_sql(_fields(spark, central_log(spark, sf)), d.relations(spark)).select(
        "event_id", "field", "statement")


@query
def exclude_columns(spark, sf):
    hidden = ["note", "click"]
    changes = _fields(spark, central_log(spark, sf), excluded=hidden)
    return render_sql(changes, d.relations(spark), excluded=hidden).select("event_id", "field", "noop", "statement")


# --- analysis and conflicts --------------------------------------------------------------------

@query
def sync_bounds(spark, sf):
    return resolve.sync_bounds(_pending(spark, sf)).select(
        "n_events", "min_event_id", "max_event_id",
        F.unix_micros("max_tstamp_tx").alias("max_micros"),
    )


def _flat_changes(changes):
    return changes.select("event_id", "ident", "action", "field", "value", "uid")


@query
def compact_central(spark, sf):
    return _flat_changes(resolve.compact(_central_fields(spark, sf), "reference"))


@query
def compact_clone(spark, sf):
    return _flat_changes(resolve.compact(_clone_fields(spark, sf)))


@query
def detect_conflicts(spark, sf):
    pairs = resolve.detect_conflicts(
        resolve.compact(_central_fields(spark, sf)), resolve.compact(_clone_fields(spark, sf)))
    return pairs.select(
        "ident", "uid", "field", "central_event_id", "clone_event_id", "central_value",
        "clone_value", "central_orig_micros", "clone_orig_micros",
    )


@query
def resolve_conflicts(spark, sf):
    return _conflicts(spark, sf).select("ident", "uid", "field", "rejected", "rule_applied")


@query
def drop_rejected(spark, sf):
    lost = _conflicts(spark, sf)
    central = resolve.drop_rejected(
        resolve.compact(_central_fields(spark, sf)), lost, CENTRAL)
    clone = resolve.drop_rejected(resolve.compact(_clone_fields(spark, sf)), lost, CLONE)
    return _flat_changes(central).withColumn("side", F.lit(CENTRAL)).unionByName(
        _flat_changes(clone).withColumn("side", F.lit(CLONE)))


def _reconciled(spark, sf):
    return resolve.reconcile(_central_fields(spark, sf), _clone_fields(spark, sf))


@query
def reconcile(spark, sf):
    """Survivors of both sides from the one-shuffle form."""
    merged = _reconciled(spark, sf)
    return _flat_changes(resolve.survivors(merged, CENTRAL)).withColumn(
        "side", F.lit(CENTRAL)
    ).unionByName(
        _flat_changes(resolve.survivors(merged, CLONE)).withColumn("side", F.lit(CLONE)))


def _ledger(spark, sf):
    return resolve.conflict_ledger(
        resolve.reconciled_conflicts(_reconciled(spark, sf)), d.relations(spark), d.CLONE_A, NOW)


@query
def conflict_ledger(spark, sf):
    return _ledger(spark, sf).select(
        "ident", "uid", "field", "clone_id", "central_event_id",
        F.unix_micros("conflict_time").alias("conflict_micros"),
        F.unix_micros("central_tstamp").alias("central_micros"),
        "central_sql", "clone_sql", "rejected", "rule_applied",
    )


@query
def conflict_report(spark, sf):
    return resolve.conflict_report(_ledger(spark, sf))


# --- replay ------------------------------------------------------------------------------------

def _replayed(spark, sf, **options):
    return replay.replay(
        base_rows(spark, sf), _all_changes(spark, sf), ROW, LOCAL, keep=stage,
        **options)


@query
def replay_fold(spark, sf):
    return _long(_replayed(spark, sf).snapshot)


@query
def replay_status(spark, sf):
    return replay.replay_status(
        base_rows(spark, sf), _all_changes(spark, sf), ROW, LOCAL, slice_size=1000,
    ).select("event_id", "ident", "action", "field", "status")


@query
def replay_to_clone(spark, sf):
    """The centre's survivors, inserts included, at the clone."""
    log = d.prepared(spark, sf, d.star_central_log)
    changes = stage(resolve.compact(_fields(spark, _pending(spark, sf, log))), "news")
    base = d.prepared(spark, sf, d.star_base)
    result = replay.replay_to_clone(base, changes, ROW, LOCAL, keep=stage)
    return _long(result.snapshot)


def _to_central(spark, sf):
    base = base_rows(spark, sf)
    changes = stage(resolve.compact(_clone_fields(spark, sf)), "edits")
    return base, replay.replay(base, changes, ROW, LOCAL, keep=stage)


@query
def replay_to_central(spark, sf):
    """New log events of the centre after a clone's edits are replayed there."""
    base, result = _to_central(spark, sf)
    inserted = stage(
        replay.inserted_rows(base, result.effects, ROW, LOCAL, number_local=True), "inserted")
    events = replay.effect_events(
        base, result.effects, "app.any", d.CLONE_A, ROW, NOW, inserted)
    flat = events.select(
        "order_key", "action", F.element_at("row_data", "uid").alias("uid"),
        F.element_at("row_data", "id").cast("long").alias("row_id"),
        F.element_at("row_data", "click").alias("row_click"),
        F.col("sync.origin").alias("origin"),
        F.unix_micros("sync.orig_tstamp").alias("orig_micros"), "changed_fields",
    )
    return _pairs(flat, "changed_fields", [c for c in flat.columns if c != "changed_fields"])


@query
def retain_failed(spark, sf):
    _, result = _to_central(spark, sf)
    return replay.retain_failed(clone_log(spark, sf), result.statuses).select(
        "event_id", "action")


@query
def mark_replayed(spark, sf):
    return replay.mark_replayed(_central_fields(spark, sf), d.CLONE_A, "round-2")


@query
def assign_local_ids(spark, sf):
    """Inserted rows continue the local ids of the target in order of insertion."""
    snapshot = _replayed(spark, sf, number_local=True).snapshot
    return snapshot.select(*ROW, "id")


def _by_id(spark, sf):
    return base_rows(spark, sf).drop("ident"), central_log(spark, sf)


def _per_table(run):
    """The same job for each table of the log."""
    parts = [run(i).withColumn("ident", F.lit(i)) for i in d.IDENTS]
    return parts[0].unionByName(parts[1])


@query
def replay_events(spark, sf):
    """All purchases replayed by primary key."""
    log = central_log(spark, sf)
    base = base_rows(spark, sf)
    ids = d.read(spark, sf, "events").filter("event_type = 'purchase'").select(
        (F.col("event_id") + 1).alias("event_id"))

    def run(ident):
        snapshot = base.filter(F.col("ident") == ident).drop("ident")
        done = replay.replay_events(snapshot, log, ids, ident, ["id"], keep=stage)
        return _long(done.snapshot, ["uid", *FIELDS], ["id"])

    return _per_table(run)


@query
def rollback_guard(spark, sf):
    log = central_log(spark, sf)
    return replay.rollback_guard(log, log.select("event_id"), ["id"])


@query
def rollback_events(spark, sf):
    """Every event that may be rolled back is rolled back."""
    log = central_log(spark, sf)
    base = base_rows(spark, sf)

    def run(ident):
        snapshot = base.filter(F.col("ident") == ident).drop("ident")
        done = replay.rollback_events(
            snapshot, log, log.select("event_id"), ident, ["id"], keep=stage)
        return _long(done.snapshot, ["uid", *FIELDS], ["id"])

    return _per_table(run)


@query
def cast_row(spark, sf):
    """Order texts as typed rows; priorities are no numbers, so they are reported."""
    orders = d.read(spark, sf, "orders").select(
        "o_orderkey",
        F.map_from_arrays(
            F.array(F.lit("customer"), F.lit("day"), F.lit("rank"), F.lit("status")),
            F.array(
                F.col("o_custkey").cast("string"),
                F.date_format("o_orderdate", "yyyy-MM-dd"),
                F.when(F.col("o_orderstatus") == "O", F.substring("o_orderpriority", 1, 1))
                .otherwise(F.col("o_orderpriority")),
                F.col("o_orderstatus"),
            ),
        ).alias("m"),
    )
    schema = T.StructType([
        T.StructField("customer", T.LongType()),
        T.StructField("day", T.DateType()),
        T.StructField("rank", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("absent", T.LongType()),
    ])
    return orders.select(
        "o_orderkey", exprs.cast_row(F.col("m"), schema).alias("r"),
        F.array_join(exprs.cast_errors(F.col("m"), schema), ",").alias("bad_columns"),
    ).select("o_orderkey", "r.*", "bad_columns")


# --- history and lists -------------------------------------------------------------------------

@query
def fold_history(spark, sf):
    return history.fold_history(d.order_rounds(spark, sf)).select(
        "sync_id", "server_from", F.array_join("server_to", ",").alias("server_to"),
        "min_event_id", "max_event_id", F.unix_micros("sync_time").alias("sync_micros"),
        "sync_type", "sync_status",
    )


@query
def merge_whitelist(spark, sf):
    pairs = d.server_tables(spark, sf)
    current = d.table_lists(pairs.filter("l_returnflag != 'R'"))
    new = d.table_lists(pairs.filter("l_returnflag = 'R'"))
    return registry.merge_whitelist(current, new).select(
        "server_id", F.size("tables").alias("n_tables"),
        F.array_join("tables", ",").alias("tables"),
    )


@query
def tables_by_schema(spark, sf):
    return registry.tables_by_schema(d.table_lists(d.server_tables(spark, sf)))


@query
def sync_lag(spark, sf):
    return history.sync_lag(
        history.fold_history(d.order_rounds(spark, sf)), central_log(spark, sf), d.CENTRAL_ID)


# --- whole tables and jobs ---------------------------------------------------------------------

def _flat_differences(diff):
    keys = ["uid", "status"]
    left = _pairs(diff, "left_values", keys).withColumn("side", F.lit("left"))
    right = _pairs(diff, "right_values", keys).withColumn("side", F.lit("right"))
    return left.unionByName(right)


@query
def compare_tables(spark, sf):
    return _flat_differences(compare.compare_tables(
        d.orders_old(spark, sf), d.orders_new(spark, sf), ["id"]))


@query
def compare_all(spark, sf):
    old, new = d.orders_old(spark, sf), d.orders_new(spark, sf)
    base = base_rows(spark, sf).drop("ident")
    replayed = _replayed(spark, sf).snapshot.drop("ident")
    return compare.compare_all({
        "orders": (old, new, ["id"]),
        "same orders": (old, old, ["id"]),
        "rows": (base, replayed, ["id"]),
    })


def star_centre(spark, sf):
    """The rows of the centre: where its log has led from the base."""
    log = d.prepared(spark, sf, d.star_central_log)
    return replay.replay(d.prepared(spark, sf, d.star_base), stage(_fields(spark, log), "edits"),
                         ROW, LOCAL, keep=stage).snapshot


def star_clone(spark, sf):
    """The rows of a clone: where its log has led from the base."""
    log = d.prepared(spark, sf, d.star_clone_log)
    return replay.replay(d.prepared(spark, sf, d.star_base), stage(_fields(spark, log), "edits"),
                         ROW, LOCAL, keep=stage).snapshot


def _star(spark, sf):
    """A store with a centre and a clone that started from the same rows and logged their edits since,
    inserts and deletes included; some rows were inserted at both."""
    store = Store(spark, work_dir(spark, "star"))
    nodes = {d.CENTRAL_ID: (star_centre, d.star_central_log),
             d.CLONE_A: (star_clone, d.star_clone_log)}
    tables = {
        f"{d.CENTRAL_ID}/receipts": d.receipts(spark, sf),
        f"{d.CENTRAL_ID}/history": d.history_records(spark, (d.CLONE_A,)),
        f"{d.CENTRAL_ID}/sync_tables": d.sync_tables(spark),
        f"{d.CENTRAL_ID}/relations": d.relations(spark),
    }
    d.prepared(spark, sf, d.star_base)  # what both sides start from, before they are made together
    both = run_all([partial(d.prepared, spark, sf, rows) for rows, _ in nodes.values()])
    for now, (node, (_, log)) in zip(both, nodes.items()):
        tables[f"{node}/log"] = d.prepared(spark, sf, log)
        for ident in d.IDENTS:
            tables[sync.table_name(node, ident)] = now.filter(F.col("ident") == ident).drop("ident")
    tx = store.begin()
    run_all([partial(tx.overwrite, name, df) for name, df in tables.items()])
    tx.commit()
    return store


def _rows_of(store, nodes):
    parts = [
        _long(store.read(sync.table_name(node, ident)), keys=["uid"])
        .withColumn("ident", F.lit(ident)).withColumn("node", F.lit(node))
        for node in nodes for ident in d.IDENTS
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def synchronize(spark, sf):
    """One round on the whole logs: the rows of both sides afterwards."""
    store = _star(spark, sf)
    sync.synchronize(store, d.CLONE_A, d.CENTRAL_ID, NOW)
    return _rows_of(store, (d.CENTRAL_ID, d.CLONE_A))


@query
def synchronize_counts(spark, sf):
    """What one round reports, and what it leaves in the ledger, receipts and clone log."""
    store = _star(spark, sf)
    done = sync.synchronize(store, d.CLONE_A, d.CENTRAL_ID, NOW)
    counts = [
        ("to_central", done.to_central), ("to_clone", done.to_clone),
        ("conflicts", done.conflicts), ("failed_changes", done.failed),
    ]
    reported = spark.createDataFrame(counts, "what string, n long")
    stored = [
        store.read(name, schema).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(what).alias("what"), "n")
        for what, name, schema in (
            ("ledger_rows", f"{d.CENTRAL_ID}/conflicts", schemas.CONFLICTS),
            ("kept_in_clone_log", f"{d.CLONE_A}/log", schemas.CHANGE_LOG),
        )
    ]
    return reported.unionByName(stored[0]).unionByName(stored[1])


@query
def synchronize_star(spark, sf):
    """Rounds over two clones until they have converged: the rows of all nodes afterwards.

    All nodes start from the same rows and make their edits, inserts and deletes through the log.
    """
    store = Store(spark, work_dir(spark, "star"))
    nodes, clones = (d.CENTRAL_ID, d.CLONE_A, d.CLONE_B), (d.CLONE_A, d.CLONE_B)
    base = base_rows(spark, sf)
    tx = store.begin()
    start = {
        f"{d.CENTRAL_ID}/history": d.history_records(spark),
        f"{d.CENTRAL_ID}/sync_tables": d.sync_tables(spark, ("alerts", "users")),
        f"{d.CENTRAL_ID}/relations": d.relations(spark),
        f"{d.CENTRAL_ID}/last_event": spark.createDataFrame([(d.MARK_ID,)], schemas.LAST_EVENT),
        **{sync.table_name(node, ident): base.filter(F.col("ident") == ident).drop("ident")
           for node in nodes for ident in d.IDENTS},
    }
    run_all([partial(tx.overwrite, name, df) for name, df in start.items()])
    tx.commit()
    clock = (datetime(2024, 2, 1) + timedelta(minutes=n) for n in count())
    for number, node in enumerate(nodes):
        edited, now = d.edited_rows(spark, sf, base, number), next(clock)
        for ident in d.IDENTS:
            after = edited.filter(F.col("ident") == ident).drop("ident")
            sync.log_edit(store, node, ident, after, now)
    sync.synchronize_star(store, clones, d.CENTRAL_ID, lambda: next(clock))
    return _rows_of(store, nodes)


def _packaged(spark, sf):
    store = _star(spark, sf)
    return store, packages.package(
        store, work_dir(spark, "package"), d.IDENTS, d.CENTRAL_ID, NOW)


@query
def package(spark, sf):
    store, pack = _packaged(spark, sf)
    m = packages.open_package(spark, pack.path).manifest
    return _per_table(lambda ident: pack.table(spark, ident).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(m["min_event_id"]).alias("min_event_id"),
        F.lit(m["max_event_id"]).alias("max_event_id"),
        F.unix_micros(F.lit(m["max_tstamp_tx"])).alias("max_micros"),
    ))


@query
def deploy(spark, sf):
    """A third clone seeded from a package, with one table edited on arrival."""
    store, pack = _packaged(spark, sf)
    packages.deploy(store, pack.path, "clone_c", NOW, post_deploy={
        "app.alerts": lambda df: df.withColumn("note", F.lit("deployed"))})
    rows = _rows_of(store, ("clone_c",)).drop("node")
    state = history.fold_history(store.read(f"{d.CENTRAL_ID}/history"))
    opened = history.last_sync(state, d.CENTRAL_ID).filter("clone_id = 'clone_c'")
    mark = opened.select("max_event_id").scalar()
    return rows.withColumn("mark", mark)


@query
def deploy_guard(spark, sf):
    rounds = history.fold_history(d.order_rounds(spark, sf))
    return packages.deploy_guard(rounds, d.CENTRAL_ID, datetime(2001, 7, 1))


@query
def preflight(spark, sf):
    inventory, relations = _inventory(spark, sf)
    return packages.preflight(inventory, _columns(spark, sf), relations)


# --- sources and sinks -------------------------------------------------------------------------

_CUSTOMER_FEATURE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("segment", T.StringType()),
])


@query
def feature_collection(spark, sf):
    """Customers written as feature collections, one per line, and read back."""
    path = work_dir(spark, "features")
    customer = d.read(spark, sf, "customer")
    # A collection holds a bounded run of customers, so no nation ends up in one line.
    run = F.floor(F.col("c_custkey") / 500)
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                 F.col("c_mktsegment").alias("segment")).alias("properties"),
        F.struct(F.lit("Point").alias("type"),
                 F.array("c_custkey", F.col("c_nationkey").cast("long")).alias("coordinates"))
        .alias("geometry"),
    )
    customer.groupBy("c_nationkey", run).agg(F.collect_list(feature).alias("features")).select(
        F.lit("FeatureCollection").alias("type"), "features"
    ).write.json(path)
    return read_feature_collection(spark, path, _CUSTOMER_FEATURE, multi_line=False)


@query
def feature_files(spark, sf):
    """Customers written as indented collections, many lines a feature, and read back by blocks."""
    path = work_dir(spark, "feature-files")
    feature = F.concat(
        F.lit('  {"type": "Feature",\n   "properties": {"id": '), F.col("c_custkey").cast("string"),
        F.lit(',\n     "name": "'), "c_name", F.lit('", "segment": "'), "c_mktsegment",
        F.lit('"},\n   "geometry": {"type": "Point", "coordinates": ['), F.concat_ws(
            ", ", F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")), F.lit("]}\n  }"))
    customer = d.read(spark, sf, "customer").select(
        (F.floor(F.col("c_custkey") / 500)).alias("run"), "c_custkey", feature.alias("value"))
    runs = customer.groupBy("run").agg(F.max("c_custkey").alias("last"))
    edges = runs.select("run", F.explode(F.array(
        F.struct(F.lit(-1).cast("long").alias("c_custkey"), F.lit(
            '{"type": "FeatureCollection", "name": "a } in [ text",\n "features": [').alias("value")),
        F.struct((F.col("last") + 1).alias("c_custkey"), F.lit(" ]\n}").alias("value")))).alias("e")).select("run", "e.*")
    ended = customer.join(runs, "run").select("run", "c_custkey", F.when(
        F.col("c_custkey") < F.col("last"), F.concat("value", F.lit(","))).otherwise(F.col("value")).alias("value"))
    ended.unionByName(edges).repartition("run").sortWithinPartitions("run", "c_custkey").select("value").write.text(path)
    return read_features(spark, path, _CUSTOMER_FEATURE)


@query
def snapshot_roundtrip(spark, sf):
    """Two versions of the orders table; readers get the newer one."""
    store = Store(spark, work_dir(spark, "snapshot"))
    write_snapshot(store, "orders", d.orders_old(spark, sf))
    write_snapshot(store, "orders", d.orders_new(spark, sf))
    return read_snapshot(store, "orders").withColumn("version", F.lit(store.version).cast("long"))


@query
def compact_store(spark, sf):
    """Orders appended in one commit per priority, merged to one segment, old files removed."""
    store = Store(spark, work_dir(spark, "compact"))
    orders = d.orders_old(spark, sf)
    for priority in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"):
        tx = store.begin()
        tx.append("orders", orders.filter(F.col("priority") == priority))
        tx.commit()
    before = store.segments("orders")
    store.compact(most=1)
    store.vacuum(keep=1)
    return store.read("orders").groupBy("priority").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("cents").alias("cents"),
    ).withColumn("before", F.lit(before)).withColumn("after", F.lit(store.segments("orders")))


@query
def compare_added_column(spark, sf):
    """The orders against a copy with one more column, filled for some of them."""
    old = d.orders_old(spark, sf)
    more = old.withColumn("urgent", F.when(F.col("priority") == "1-URGENT", F.lit("yes")))
    return _pairs(compare.compare_tables(old, more, ["id"]), "right_values", ["uid", "status"])


@query
def capture_added_column(spark, sf):
    """The log of an edit that adds a column to the orders and fills it for some of them."""
    old = d.orders_old(spark, sf)
    more = old.withColumn("urgent", F.when(F.col("priority") == "1-URGENT", F.lit("yes")))
    events = capture.capture_changes(old, more, "shop.orders", tstamp=F.lit(NOW))
    return _pairs(events.select("action", F.element_at("row_data", "uid").alias("uid"),
                                "changed_fields"), "changed_fields", ["action", "uid"])


@query
def export_csv_dump(spark, sf):
    path = work_dir(spark, "csv")
    export_csv(d.orders_old(spark, sf), path, ["uid"])
    return spark.read.csv(path, sep="\t", schema="uid string, id long, custkey long, "
                          "status string, priority string, cents long, batch long")


@query
def export_sql_script(spark, sf):
    path = work_dir(spark, "sql")
    export_sql(_fields(spark, central_log(spark, sf)), d.relations(spark), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


# --- streaming ---------------------------------------------------------------------------------

def _log_stream(spark, sf, derive):
    """A derived log as a file stream over the given events table."""
    class Streaming:
        @staticmethod
        def parquet(path):
            schema = spark.read.parquet(path).schema
            source = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = source.getFileSystem(spark._jsc.hadoopConfiguration())
            stream = spark.readStream.schema(schema)
            if files.getFileStatus(source).isDirectory():  # a table of many part files
                return stream.parquet(path)
            folder, name = path.rsplit("/", 1)
            return stream.option("pathGlobFilter", name).parquet(folder)

    class Session:
        read = Streaming

    return derive(Session, sf)


@query
def stream_pending(spark, sf):
    out, seen = work_dir(spark, "pending"), work_dir(spark, "receipts")
    jobs.stream_pending(
        _log_stream(spark, sf, d.central_log), d.relations(spark), d.sync_tables(spark),
        d.CLONE_A, out, seen, work_dir(spark, "checkpoint"),
    ).awaitTermination()
    return spark.read.parquet(out).select("event_id", "action", "field", "value", "uid", "noop")


@query
def stream_dedup(spark, sf):
    """Every event delivered twice, stored once."""
    once, again = _log_stream(spark, sf, d.central_log), _log_stream(spark, sf, d.central_log)
    out = work_dir(spark, "dedup")
    jobs.stream_dedup(
        once.unionByName(again), out, work_dir(spark, "checkpoint"), "31 days"
    ).awaitTermination()
    return spark.read.parquet(out).select(
        "event_id", "action", F.unix_micros("tstamp_tx").alias("tx_micros"))


@query
def stream_latest(spark, sf):
    out = work_dir(spark, "latest")
    changes = _fields(spark, _log_stream(spark, sf, d.central_log))
    jobs.stream_latest(changes, out, work_dir(spark, "checkpoint")).awaitTermination()
    return jobs.latest_cells(spark.read.parquet(out)).select(
        "ident", "uid", "field", "event_id", "value")


@query
def late_events(spark, sf):
    return pending.late_events(
        central_log(spark, sf), d.receipts(spark, sf),
        history.fold_history(d.history_records(spark)), d.sync_tables(spark),
        d.CLONE_A, d.CENTRAL_ID,
    ).select("event_id", "action", F.unix_micros("tstamp_tx").alias("tx_micros"))


def _deliveries(spark, log, *conditions):
    """A log that arrives in several files, one run of a stream after each: yields the stream."""
    path = work_dir(spark, "deliveries")
    for condition in conditions:
        log.filter(condition).write.mode("append").parquet(path)
        yield spark.readStream.schema(log.schema).parquet(path)


@query
def stream_late(spark, sf):
    """A tenth of the log comes in a second delivery, together with a repeat of the first one.

    Every event is stored by the dedup or, if it came too late, in its side output.
    """
    out, late, marks = (work_dir(spark, name) for name in ("dedup", "late", "marks"))
    checkpoints = work_dir(spark, "checkpoint"), work_dir(spark, "checkpoint")
    for stream in _deliveries(spark, central_log(spark, sf), F.col("event_id") % 10 != 3, F.lit(True)):
        jobs.stream_dedup(stream, out, checkpoints[0], "1 day").awaitTermination()
        jobs.stream_late(stream, late, marks, checkpoints[1], "1 day").awaitTermination()
    stored = spark.read.parquet(out)
    first = jobs.late_first(spark.read.parquet(late).drop("batch"), stored)
    return stored.select("event_id", F.lit("in time").alias("came")).unionByName(
        first.select("event_id", F.lit("late").alias("came")))


@query
def stream_sessions(spark, sf):
    """Sessions that are over, from a log that arrives in three files."""
    out, checkpoint = work_dir(spark, "sessions"), work_dir(spark, "checkpoint")
    day = F.dayofmonth("tstamp_tx")
    for stream in _deliveries(
            spark, central_log(spark, sf), day < 10, day.between(10, 19), day > 19):
        jobs.stream_sessions(stream, 4 * 3600, out, checkpoint, "1 hour").awaitTermination()
    return spark.read.parquet(out)


@query
def stream_retry(spark, sf):
    """The log replayed as a stream; what cannot be applied waits in the dead letters."""
    store = Store(spark, work_dir(spark, "retry"))
    write_snapshot(store, "rows", base_rows(spark, sf))
    jobs.stream_retry(
        _log_stream(spark, sf, d.central_log), store, "rows", "dead_letters",
        d.relations(spark), ROW, LOCAL, work_dir(spark, "checkpoint"),
    ).awaitTermination()
    store.begin()
    rows = _long(store.read("rows")).withColumn("event_id", F.lit(None).cast("long"))
    none = F.lit(None).cast("string")
    dead = store.read("dead_letters").select(
        *[none.alias(c) for c in (*ROW, "field", "value")], "event_id")
    return rows.unionByName(dead)


@query
def activity_tumbling(spark, sf):
    return jobs.activity_windows(central_log(spark, sf), "1 hour").select(
        "ident", F.unix_micros("window_start").alias("start_micros"), "n_events")


@query
def activity_sliding(spark, sf):
    return jobs.activity_windows(central_log(spark, sf), "6 hours", "1 hour").select(
        "ident", F.unix_micros("window_start").alias("start_micros"), "n_events")


@query
def activity_sessions(spark, sf):
    return jobs.activity_sessions(central_log(spark, sf), 4 * 3600)
