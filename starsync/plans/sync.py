"""Two-way sync rounds between one centre and its clones, on a versioned store.

Names in the store: ``<node>/log`` and ``<node>/table/<schema.table>`` for every node, and at the
centre also ``receipts``, ``receipt_ranges``, ``history``, ``sync_tables``, ``relations`` and
``conflicts``.
"""

import hashlib
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync import schemas
from starsync.functions.exprs import CENTRAL, CLONE
from starsync.operators import capture, compare, pending, receipts, registry, replay, resolve
from starsync.operators.history import DONE, PARTIAL, PENDING, fold_history
from starsync.session import run_all, scratch, stage
from starsync.sources.store import Store, bucket, rewrite_touched, touched_buckets


@dataclass
class Round:
    """What one sync round did."""

    sync_id: str
    to_central: int
    to_clone: int
    conflicts: int
    failed: int
    logged: int = 0
    failures: tuple = ()

    @property
    def quiet(self):
        """Nothing changed at either side (failed events may be waiting in the clone's log)."""
        return not (self.logged or self.to_clone)


class NotConverged(Exception):
    """The rounds over a star still change something after the cycles its caller allowed."""


def table_name(node: str, ident: str) -> str:
    return f"{node}/table/{ident}"


def make_sync_id(*parts) -> str:
    """A uuid-shaped id that is the same when the same round is run again."""
    h = hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def history_rows(spark, *rows) -> DataFrame:
    """History records from dictionaries; absent columns are NULL."""
    names = schemas.HISTORY_RECORDS.names
    return spark.createDataFrame(
        [tuple(r.get(n) for n in names) for r in rows], schemas.HISTORY_RECORDS
    )


def log_edit(store: Store, node: str, ident: str, after: DataFrame, now: datetime, uid="uid",
             **capture_options) -> None:
    """Replace a table of a node by an edited version and log the difference."""
    before = store.read(table_name(node, ident))
    log = store.read(f"{node}/log", schemas.CHANGE_LOG)
    events = capture.capture_changes(
        before, after, ident, uid, tstamp=F.lit(now), **capture_options
    ).withColumn("_uid", F.element_at("row_data", uid))
    events = capture.order_events(
        events, ["_uid"], retained=log, start=last_event_id(store, node)).drop("_uid")
    tx = store.begin()
    name = table_name(node, ident)
    layout = store.layout(name)
    events = tx.append(f"{node}/log", events)
    if layout and layout[0] == uid and before.schema == after.schema:
        edited = events.select(F.element_at("row_data", uid).cast(after.schema[uid].dataType).alias(uid))
        hit = touched_buckets(store, name, edited, uid)
        rewrite_touched(tx, name, after.filter(bucket(*layout).isin(hit)), uid, hit)
    else:
        tx.overwrite(name, after, key=uid, rows=before.count())
    count_events(tx, node, events)
    tx.commit()


def last_event_id(store: Store, node: str) -> int:
    """The last event id that a node has given, also when its log was emptied since."""
    return store.read(f"{node}/last_event", schemas.LAST_EVENT).agg(
        F.coalesce(F.max("event_id"), F.lit(0))).first()[0]


def count_events(tx, node: str, events: DataFrame):
    """Keep the node's counter with the events of the same commit."""
    held = tx.store.read(f"{node}/last_event", schemas.LAST_EVENT)
    top = held.unionByName(events.select("event_id")).agg(F.max("event_id")).first()[0] or 0
    tx.overwrite(f"{node}/last_event", tx.store.spark.createDataFrame([(top,)], schemas.LAST_EVENT))


def _replay_tables(store, tx, node, changes, idents, local_keys, uid, strict):
    """Replay one side's survivors onto the tables of a node.

    The changes of all tables are folded together, keyed by table and uid; only the rewrite is
    one job per changed table, over the uid buckets that the effects hit.  Returns the statuses, per
    table the rows of these buckets before, its net effects and inserts and the buckets, and the
    rewrites still to be run.
    """
    keys = ["ident", uid]
    present = [i for i in idents if table_name(node, i) in store]
    before = {i: store.read(table_name(node, i)) for i in present}
    outcome = F.when(F.col("noop"), replay.NOOP)
    for ident in present:
        outcome = outcome.when(F.col("ident") == ident, replay.known_outcome(
            before[ident].schema, [uid], local_keys.get(ident, ())))
    absent = ~F.col("ident").isin(present)
    known = changes.withColumn("_known", outcome).withColumn(
        "_known", F.when(absent & F.col("_known").isNull(), replay.NO_TABLE)
        .otherwise(F.col("_known"))
    )
    key_rows = _union([
        df.select(F.lit(i).alias("ident"), uid) for i, df in before.items()
    ]) if present else changes.select(*keys).limit(0)
    statuses, effects = replay.fold(known, key_rows, keys, keep=_keep_by_table)
    if strict:
        replay.require_clean(statuses)
    def with_inserts(ident):
        # Numbered once: the table and the log get the same rows.
        mine = effects.filter(F.col("ident") == ident).drop("ident")
        hit = touched_buckets(store, table_name(node, ident), mine, uid)
        old = before[ident] if hit is None else store.read_buckets(table_name(node, ident), hit)
        return old, mine, stage(replay.inserted_rows(
            before[ident], mine, (uid,), tuple(local_keys.get(ident, ())), number_local=True),
            "inserted"), hit

    by_table = dict(zip(present, run_all([partial(with_inserts, i) for i in present])))

    def rewrite(ident):
        old, mine, inserted, hit = by_table[ident]
        rewrite_touched(tx, table_name(node, ident), replay.apply_effects(
            old, mine, (uid,), tuple(local_keys.get(ident, ())), inserted=inserted), uid, hit)

    return statuses, by_table, [partial(rewrite, i) for i in present]


def _keep_by_table(df, name):
    """Stage effects in one folder per table, so that each rewrite reads its own only."""
    return stage(df, name, ["ident"] if name == "effects" else None)


def _union(frames):
    return reduce(DataFrame.unionByName, frames)


def synchronize(store: Store, clone: str, central: str, now: datetime, uid="uid",
                mode="updates", excluded=(), use_marks=True, only_listed=False) -> Round:
    """One round: the centre's news to the clone, then the clone's to the centre.

    ``excluded`` columns do not travel.  ``use_marks=False`` looks for news by receipts alone, which
    also finds events that committed late.  ``only_listed`` sends the centre only the tables on the
    clone's list; the other events stay in the clone's log.  What the round stages is deleted at
    its end.

    Both logs are brought to field grain once, and one shuffle compacts them, pairs the edits of
    the same cell and decides the conflicts.  Everything becomes visible with a single commit at
    the end: a round that dies, or a batch the clone cannot apply as a whole, leaves the store as
    it was, and running it again gives the same result.
    """
    with scratch(store.spark):
        return _round(store, clone, central, now, uid, mode, excluded, use_marks, only_listed)


def _round(store, clone, central, now, uid, mode, excluded, use_marks, only_listed):
    spark = store.spark
    tx = store.begin()
    sync_id = make_sync_id(clone, store.version)
    relations = store.read(f"{central}/relations", schemas.RELATIONS)
    central_log = store.read(f"{central}/log", schemas.CHANGE_LOG)
    clone_log = store.read(f"{clone}/log", schemas.CHANGE_LOG)
    history = fold_history(store.read(f"{central}/history", schemas.HISTORY_RECORDS))
    sync_tables = store.read(f"{central}/sync_tables", schemas.SYNC_TABLES)
    last_id = last_event_id(store, central)
    local_keys = {
        r["ident"]: r["keys"] for r in registry.relation_keys(relations).collect()
    }  # catalogue metadata: a few names per table

    news = pending.pending_central(
        central_log,
        store.read(f"{central}/receipts", schemas.RECEIPTS),
        history,
        sync_tables, clone, central, use_marks,
    )
    # Rounds keep ranges of ids; receipts of single events are those that were there before.
    held = store.read(f"{central}/receipt_ranges", schemas.RECEIPT_RANGES)
    news = receipts.unreceived(news, held.filter(F.col("server_id") == clone))
    from_central = stage(
        pending.to_field_grain(news, relations, uid, excluded), "from_central")
    edits = pending.pending_clone(clone_log)
    held_back = clone_log.limit(0)
    if only_listed:
        listed = F.coalesce(pending.allowed(sync_tables, clone), F.lit(False))
        edits, held_back = clone_log.filter(listed), clone_log.filter(~listed)
    from_clone = pending.to_field_grain(edits, relations, uid, excluded)
    merged = stage(resolve.reconcile(from_central, from_clone, mode), "reconciled")

    bounds = resolve.sync_bounds(from_central).first()
    wins = {
        side: F.col(side).isNotNull() & ~F.col("rejected").eqNullSafe(side)
        for side in (CENTRAL, CLONE)
    }
    per_table = merged.groupBy("ident").agg(
        F.count_if(wins[CENTRAL]).alias(CENTRAL),
        F.count_if(wins[CLONE]).alias(CLONE),
        F.count("rejected").alias("conflicts"),
    ).collect()  # three counts per table
    idents = {s: sorted(r["ident"] for r in per_table if r[s]) for s in (CENTRAL, CLONE)}
    n_conflicts = sum(r["conflicts"] for r in per_table)
    records = []

    def record(direction, server_from, server_to, b=None):
        round_id = make_sync_id(sync_id, direction)
        base = {"sync_id": round_id, "sync_time": now, "server_from": server_from,
                "server_to": server_to, "sync_type": PARTIAL, "seq": 1, "sync_status": PENDING}
        if b is not None:
            base.update(min_event_id=b["min_event_id"], max_event_id=b["max_event_id"],
                        max_tstamp_tx=b["max_tstamp_tx"])
        records.extend([base, {"sync_id": round_id, "seq": 2, "sync_status": DONE}])
        return round_id

    down_id = record("down", central, clone, bounds) if bounds["n_events"] else None
    up_id = record("up", clone, central) if idents[CLONE] else None

    def down():
        """Centre to clone: all or nothing, no log rows at the clone."""
        _, _, rewrites = _replay_tables(
            store, tx, clone, resolve.survivors(merged, CENTRAL), idents[CENTRAL], local_keys,
            uid, strict=True)
        seen = receipts.to_ranges(replay.mark_replayed(from_central, clone, down_id))
        run_all([*rewrites, lambda: tx.append(f"{central}/receipt_ranges", seen)])

    def up():
        """Clone to centre: change by change; failed events stay in the clone's log."""
        statuses, by_table, rewrites = _replay_tables(
            store, tx, central, resolve.survivors(merged, CLONE), idents[CLONE], local_keys,
            uid, strict=False)

        def log_effects():
            events = _union([
                replay.effect_events(before, effects, ident, clone, (uid,), now, inserted)
                for ident, (before, effects, inserted, _) in by_table.items()
            ]).withColumn("order_field", F.coalesce(F.map_keys("changed_fields")[0], F.lit("")))
            events = tx.append(f"{central}/log", capture.order_events(
                events, ["order_key", "order_field"], retained=central_log, start=last_id
            ).drop("order_key", "order_field"))
            count_events(tx, central, events)
            tx.append(f"{central}/receipt_ranges", receipts.to_ranges(
                capture.provenance_receipts(events, central, up_id)))
            return events.count()

        def failed():
            """How many changes failed, and a sum that tells which (order does not matter)."""
            f = replay.failures(statuses).agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("event_id", "field").cast("decimal(38,0)")))
            return tuple(f.first())

        kept = replay.retain_failed(edits, statuses).unionByName(held_back)
        done = run_all([
            failed,
            lambda: tx.overwrite(f"{clone}/log", kept),
            log_effects if by_table else lambda: 0,
            *rewrites,
        ])
        return done[0], done[2]

    def ledger():
        tx.append(f"{central}/conflicts", resolve.conflict_ledger(
            resolve.reconciled_conflicts(merged), relations, clone, now, uid))

    def history_entry():
        tx.append(f"{central}/history", history_rows(spark, *records))

    # The two directions change different tables, and all their inputs are staged by now.
    jobs = {
        "up": up if up_id else lambda: tx.overwrite(f"{clone}/log", held_back),
        "down": down if down_id else None,
        "ledger": ledger if n_conflicts else None,
        "history": history_entry if records else None,
        "counter": lambda: count_events(tx, clone, clone_log),  # the log is about to be emptied
    }
    outcome = run_all([job for job in jobs.values() if job])
    failures, n_logged = outcome[0] if up_id else ((0, None), 0)
    n_failed = failures[0]
    tx.commit(note=sync_id)
    return Round(
        sync_id=sync_id,
        to_central=sum(r[CLONE] for r in per_table) - n_failed,
        to_clone=sum(r[CENTRAL] for r in per_table),
        conflicts=n_conflicts,
        failed=n_failed,
        logged=n_logged,
        failures=failures,
    )


def synchronize_star(store: Store, clones, central: str, clock, uid="uid", schedule=None,
                     max_cycles=None) -> list:
    """Rounds over several clones: in the order of ``schedule``, or until they have converged.

    Converged means that a whole cycle changed no table and failed with the same changes as the
    cycle before: more rounds would do the same again.  There is no limit of cycles unless the
    caller sets one; if it is reached first, ``NotConverged`` is raised.  ``clock`` gives the time
    of each round; times must increase.
    """
    if schedule is not None:
        return [(c, synchronize(store, c, central, clock(), uid)) for c in schedule]
    rounds, failed_before = [], None
    while max_cycles is None or len(rounds) < max_cycles * len(clones):
        cycle = [(c, synchronize(store, c, central, clock(), uid)) for c in clones]
        rounds.extend(cycle)
        failed = [r.failures for _, r in cycle]
        none = all(not r.failed for _, r in cycle)
        if all(r.quiet for _, r in cycle) and (none or failed == failed_before):
            return rounds
        failed_before = failed
    raise NotConverged(f"tables still change or other events fail after {max_cycles} cycles")


def merge_receipts(store: Store, central: str) -> int:
    """All receipts of the centre as the fewest ranges, those of single events included; how many."""
    tx = store.begin()
    singles = store.read(f"{central}/receipts", schemas.RECEIPTS)
    ranges = store.read(f"{central}/receipt_ranges", schemas.RECEIPT_RANGES).unionByName(
        receipts.to_ranges(singles))
    merged = tx.overwrite(f"{central}/receipt_ranges", receipts.to_ranges(ranges))
    tx.overwrite(f"{central}/receipts", singles.limit(0))
    n = merged.count()
    tx.commit("receipts")
    return n


def compare_star(store: Store, clones, central: str, uid="uid") -> DataFrame:
    """Differences between every table of each clone and the centre.

    Tables on a clone's list that it lacks, and tables without registered keys, are reported.
    """
    relations = store.read(f"{central}/relations", schemas.RELATIONS)
    keys = {r["ident"]: r["keys"] for r in registry.relation_keys(relations).collect()}
    sync_tables = store.read(f"{central}/sync_tables", schemas.SYNC_TABLES)
    listed = {
        r["server_id"]: [n.replace('"', "") for n in r["tables"]]
        for r in registry.merge_whitelist(sync_tables, sync_tables.limit(0)).collect()
    }  # a few names per clone
    pairs = {}
    for clone in clones:
        prefix = table_name(clone, "")
        held = {name[len(prefix):] for name in store.names(prefix)}
        for ident in sorted(held.union(listed.get(clone, ()))):
            pairs[f"{clone}:{ident}"] = tuple(
                store.read(name) if (name := table_name(node, ident)) in store else None
                for node in (clone, central)
            ) + (keys.get(ident),)
    pairs = {k: p for k, p in pairs.items() if p[0] is not None or p[1] is not None}
    return compare.compare_all(pairs, uid)
