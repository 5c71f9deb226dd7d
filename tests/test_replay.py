"""The set-based fold against a plain loop, on random logs."""

import random

import pytest
from pyspark.sql import functions as F

from starsync.operators import capture, compare, replay, resolve

CHANGES = ("event_id long, uid string, action string, field string, value string,"
           " row_data map<string,string>, noop boolean")
BASE = "uid string, id long, a string, n long"


def random_log(seed, n_rows, n_events, hot=False):
    rng = random.Random(seed)
    base = [(f"u{i}", i, f"a{i}", i * 10) for i in range(n_rows) if rng.random() < 0.6]
    changes = []
    for e in range(1, n_events + 1):
        uid = "u0" if hot and rng.random() < 0.5 else f"u{rng.randrange(n_rows)}"
        kind = rng.choice("IUUUDT")
        if kind == "I":
            n = rng.choice(["5", None, "7", "bad"]) if rng.random() < 0.3 else str(e)
            changes.append((e, uid, "I", None, None,
                            {"uid": uid, "id": "99", "a": f"i{e}", "n": n}, False))
        elif kind == "U":
            for field in rng.sample(["a", "n", "id", "zz", "uid"], rng.choice([1, 1, 2])):
                value = {"a": rng.choice([f"v{e}", None]), "n": rng.choice([str(e), "bad", None]),
                         "id": "3", "zz": "1", "uid": "q"}[field]
                if field in ("id", "zz", "uid") and rng.random() < 0.7:
                    continue
                changes.append((e, uid, "U", field, value, None, False))
        elif kind == "D":
            changes.append((e, uid, "D", None, None, None, False))
        elif rng.random() < 0.3:
            changes.append((e, None, "T", None, None, None, True))
    return base, changes


def as_long(text):
    return int(text) if text is not None else None


def loop(base, changes):
    """One change after the other."""
    rows = {uid: {"a": a, "n": n} for uid, _, a, n in base}
    statuses = []
    for e, uid, action, field, value, row, noop in changes:
        live = uid in rows
        if noop or (action == "U" and field == "id"):
            status = "noop"
        elif action == "U" and field == "uid":
            status = "key_update"
        elif action == "U" and (field == "zz" or (field == "n" and value == "bad")):
            status = "bad_value"
        elif action == "I" and row["n"] == "bad":
            status = "bad_value"
        elif action == "I" and live:
            status = "unique_violation"
        elif action != "I" and not live:
            status = "no_match"
        else:
            status = "applied"
            if action == "I":
                rows[uid] = {"a": row["a"], "n": as_long(row["n"])}
            elif action == "D":
                del rows[uid]
            else:
                rows[uid][field] = as_long(value) if field == "n" else value
        statuses.append((e, field, status))
    return {(u, r["a"], r["n"]) for u, r in rows.items()}, sorted(statuses, key=str)


@pytest.mark.parametrize("seed,slice_size,hot", [
    (1, None, False), (2, 7, False), (3, 1, True), (4, 1_000_000, True), (5, 50, True)])
def test_fold_equals_loop(spark, seed, slice_size, hot):
    base, changes = random_log(seed, 40, 400, hot)
    want_rows, want_statuses = loop(base, changes)
    result = replay.replay(
        spark.createDataFrame(base, BASE), spark.createDataFrame(changes, CHANGES),
        local_keys=("id",), slice_size=slice_size)
    got = {(r.uid, r.a, r.n) for r in result.snapshot.collect()}
    assert got == want_rows
    got_statuses = sorted(
        ((r.event_id, r.field, r.status) for r in result.statuses.collect()), key=str)
    assert got_statuses == want_statuses


@pytest.mark.parametrize("seed", [11, 12])
def test_compaction_does_not_change_the_result(spark, seed):
    base, changes = random_log(seed, 15, 400, True)
    changes = [c for c in changes if c[5] is None or c[5]["n"] != "bad"]
    df = spark.createDataFrame(changes, CHANGES).withColumn("ident", F.lit("s.t"))
    compacted = resolve.compact(df)
    assert compacted.filter("action = 'U'").groupBy("uid", "field").count().filter(
        "count > 1").isEmpty()
    # A failing last update hides an earlier good one once compacted, so compare good ones only.
    good = df.filter("not (action = 'U' and (field in ('zz', 'uid') or value <=> 'bad'))")
    want, _ = loop(base, [c for c in changes if not (
        c[2] == "U" and (c[3] in ("zz", "uid") or c[4] == "bad"))])
    result = replay.replay(
        spark.createDataFrame(base, BASE), resolve.compact(good), local_keys=("id",))
    assert {(r.uid, r.a, r.n) for r in result.snapshot.collect()} == want


def test_local_ids_continue_in_order(spark):
    base = spark.createDataFrame([("u1", 7, "x", 1)], BASE)
    changes = spark.createDataFrame([
        (i, f"new{i}", "I", None, None, {"uid": f"new{i}", "id": "1", "a": "y", "n": "1"}, False)
        for i in (5, 9, 2)], CHANGES)
    got = replay.replay(base, changes, local_keys=("id",), number_local=True).snapshot
    assert {(r.uid, r.id) for r in got.collect()} == {
        ("u1", 7), ("new2", 8), ("new5", 9), ("new9", 10)}


def test_clone_replay_is_all_or_nothing(spark):
    base = spark.createDataFrame([("u1", 7, "x", 1)], BASE)
    changes = spark.createDataFrame([
        (1, "u1", "U", "a", "y", None, False),
        (2, "u1", "I", None, None, {"uid": "u1", "a": "y", "n": "1"}, False)], CHANGES)
    with pytest.raises(replay.ReplayError, match="event 2"):
        replay.replay_to_clone(base, changes, local_keys=("id",))


def test_replaying_a_capture_gives_the_new_snapshot(spark):
    rng = random.Random(3)
    old = [(f"u{i}", i, rng.choice(["p", "q", None]), rng.choice([1, 2, None]))
           for i in range(60)]
    new = [(u, i, rng.choice([a, "r", None]), rng.choice([n, 3])) for u, i, a, n in old[5:]]
    new += [(f"x{i}", 100 + i, "z", None) for i in range(5)]
    old_df, new_df = spark.createDataFrame(old, BASE), spark.createDataFrame(new, BASE)
    log = capture.capture_changes(old_df, new_df, "s.t", ignored=["id"])
    log = log.withColumn("k", F.element_at("row_data", "uid"))
    log = capture.order_events(log, ["k"])
    assert sorted(r.event_id for r in log.collect()) == list(range(1, log.count() + 1))
    changes = log.select(
        "event_id", "action", "row_data", F.element_at("row_data", "uid").alias("uid"),
        F.explode_outer(F.map_entries("changed_fields")).alias("c"),
    ).select("event_id", "action", "row_data", "uid", F.col("c.key").alias("field"),
             F.col("c.value").alias("value"))
    after = replay.replay(old_df, changes, local_keys=("id",)).snapshot
    assert compare.compare_tables(after, new_df, ["id"]).isEmpty()


LOG = ("event_id long, schema_name string, table_name string, tstamp_tx timestamp,"
       " action string, row_data map<string,string>, changed_fields map<string,string>")


def test_rollback_restores_and_refuses(spark):
    from datetime import datetime

    t = datetime(2024, 1, 1)
    rows = [
        (1, "s", "t", t, "U", {"id": "1", "a": "old"}, {"a": "new"}),
        (2, "s", "t", t, "D", {"id": "2", "a": "gone"}, None),
        (3, "s", "t", t, "I", {"id": "3", "a": "born"}, None),
        (4, "s", "t", t, "U", {"id": "4", "a": "p"}, {"a": "q"}),
        (5, "s", "t", t, "U", {"id": "4", "a": "q"}, {"a": "r"}),
    ]
    log = spark.createDataFrame(rows, LOG)
    base = spark.createDataFrame([(1, "new"), (3, "born"), (4, "r")], "id long, a string")
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "event_id long")
    guard = {r.event_id: (r.allowed, r.newer_event_id)
             for r in replay.rollback_guard(log, ids, ["id"]).collect()}
    assert guard == {1: (True, None), 2: (True, None), 3: (True, None), 4: (False, 5)}
    after = replay.rollback_events(base, log, ids, "s.t", ["id"]).snapshot
    assert {(r.id, r.a) for r in after.collect()} == {(1, "old"), (2, "gone"), (4, "r")}
    # Replaying the rolled back events brings the state back.
    again = replay.replay_events(after, log, ids, "s.t", ["id"]).snapshot
    assert {(r.id, r.a) for r in again.collect()} == {(1, "new"), (3, "born"), (4, "q")}
