"""Streams over several files: the result equals the batch operators on all rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starsync import schemas
from starsync.operators import pending, receipts, replay
from starsync.sources.store import Store, write_snapshot
from starsync.streaming import jobs

T0 = datetime(2024, 1, 1)


def event(e, uid, action, changed=None, row=None, origin=None, table="t", minutes=None):
    t = T0 + timedelta(minutes=e if minutes is None else minutes)
    row = {"uid": uid, "id": "0", **(row or {})}
    return (e, "s", table, None, t, t, t, None, None, action, row, changed, False,
            (origin, None))


@pytest.fixture
def feed(spark, tmp_path):
    """Writes each batch of events as one file and opens them as a stream, one file per batch."""
    class Feed:
        path = str(tmp_path / "log")
        root = str(tmp_path)

        def add(self, *events):
            spark.createDataFrame(list(events), schemas.CHANGE_LOG).coalesce(1).write.mode(
                "append").parquet(self.path)

        def stream(self):
            return spark.readStream.schema(schemas.CHANGE_LOG).option(
                "maxFilesPerTrigger", 1).parquet(self.path)

        def batch(self):
            return spark.read.schema(schemas.CHANGE_LOG).parquet(self.path)

    return Feed()


def relations(spark):
    return spark.createDataFrame([("s.t", "id")], schemas.RELATIONS)


def test_pending_drops_repeats_of_earlier_batches(spark, feed):
    lists = spark.createDataFrame([("a", ['"s"."t"'])], schemas.SYNC_TABLES)
    feed.add(event(1, "u1", "U", {"x": "1"}), event(2, "u1", "U", {"x": "2"}, origin="a"))
    feed.add(event(1, "u1", "U", {"x": "1"}), event(3, "u2", "U", {"x": "3", "y": None}),
             event(4, "u2", "U", {"x": "4"}, table="other"))
    out, seen = f"{feed.root}/out", f"{feed.root}/seen"

    def run():
        jobs.stream_pending(feed.stream(), relations(spark), lists, "a", out, seen,
                            f"{feed.root}/cp").awaitTermination()
        return sorted((r.event_id, r.field, r.value) for r in spark.read.parquet(out).collect())

    assert run() == [(1, "x", "1"), (3, "x", "3"), (3, "y", None)]
    feed.add(event(3, "u2", "U", {"x": "3", "y": None}), event(5, "u2", "D"))
    assert run() == [(1, "x", "1"), (3, "x", "3"), (3, "y", None), (5, None, None)]
    held = receipts.to_events(spark.read.parquet(seen)).collect()
    assert sorted(r.event_id for r in held) == [1, 3, 5]


def test_dedup_across_batches(spark, feed):
    feed.add(event(1, "u1", "D"), event(2, "u1", "D"))
    feed.add(event(2, "u1", "D"), event(3, "u1", "D"))
    out = f"{feed.root}/out"
    jobs.stream_dedup(feed.stream(), out, f"{feed.root}/cp", "1 hour").awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_late_first_deliveries_are_in_the_side_output(spark, feed):
    """Hours 0 to 8, then older and newer ones: those an hour or more behind the newest are late."""
    out, late, marks = (f"{feed.root}/{n}" for n in ("out", "late", "marks"))

    def run(*hours):
        feed.add(*[event(h, "u1", "D", minutes=60 * h) for h in hours])
        query = jobs.stream_dedup(feed.stream(), out, f"{feed.root}/cp", "1 hour")
        query.awaitTermination()
        jobs.stream_late(
            feed.stream(), late, marks, f"{feed.root}/cp2", "1 hour").awaitTermination()
        return jobs.watermark_metrics(query)

    runs = [run(0, 2, 3, 5, 6, 8), run(1, 2, 4, 4, 10), run(7, 11)]
    stored, behind = spark.read.parquet(out), spark.read.parquet(late)
    assert sorted(r.event_id for r in stored.collect()) == [0, 2, 3, 5, 6, 8, 10, 11]
    assert sorted(r.event_id for r in behind.collect()) == [1, 2, 4, 4, 7]
    assert sorted(r.event_id for r in jobs.late_first(behind, stored).collect()) == [1, 4, 7]
    assert [sum(m["dropped"] for m in metrics) for metrics in runs] == [0, 4, 1]
    assert runs[1][0]["lag_seconds"] == 3 * 3600  # hour 10 over hour 8 less one


def test_late_rows_that_were_stored_are_told_apart(spark, feed):
    """Files in one run: Spark's watermark is a batch behind, so hour 1 is stored though it is late."""
    for hours in ((0, 5), (1, 6), (2, 3)):
        feed.add(*[event(h, "u1", "D", minutes=60 * h) for h in hours])
    out, late = f"{feed.root}/out", f"{feed.root}/late"
    jobs.stream_dedup(feed.stream(), out, f"{feed.root}/cp", "1 hour").awaitTermination()
    jobs.stream_late(feed.stream(), late, f"{feed.root}/marks", f"{feed.root}/cp2",
                     "1 hour").awaitTermination()
    stored, behind = spark.read.parquet(out), spark.read.parquet(late)
    assert sorted(r.event_id for r in behind.collect()) == [1, 2, 3]
    found = [*stored.collect(), *jobs.late_first(behind, stored).collect()]
    assert sorted(r.event_id for r in found) == [0, 1, 2, 3, 5, 6]


@pytest.mark.parametrize("seed", range(2))
def test_sessions_on_a_stream_equal_those_over(spark, feed, seed):
    """Gaps of exactly the limit and of one second more, sessions over several files, a row without uid."""
    import random

    rng, minute, events = random.Random(seed), 0.0, []
    for e in range(160):
        minute += rng.choice([0, 1, 5, 20, 20 + 1 / 60, 50])
        events.append(event(e, rng.choice(["hot", "hot", "b", None]), "D", minutes=minute))
    for start in range(0, 160, 40):
        feed.add(*events[start:start + 40])
    out = f"{feed.root}/out"
    jobs.stream_sessions(feed.stream(), 1200, out, f"{feed.root}/cp", "10 minutes").awaitTermination()
    end = T0 + timedelta(minutes=minute - 10)
    done = (F.timestamp_micros("last_micros") + F.expr("interval 20 minutes")) < F.lit(end)
    want = jobs.activity_sessions(feed.batch(), 1200).filter(done)
    assert want.count() > 10

    def plain(df):
        return sorted(map(str, df.select("ident", "uid", "first_micros", "last_micros",
                                         "n_events").collect()))

    assert plain(spark.read.parquet(out)) == plain(want)


def test_latest_value_across_batches(spark, feed):
    feed.add(event(1, "u1", "U", {"x": "1"}), event(5, "u1", "U", {"x": "5"}))
    feed.add(event(3, "u1", "U", {"x": "3", "y": "3"}), event(6, "u2", "U", {"x": None}))
    out = f"{feed.root}/out"
    changes = pending.to_field_grain(feed.stream(), relations(spark))
    jobs.stream_latest(changes, out, f"{feed.root}/cp").awaitTermination()
    got = {(r.uid, r.field, r.value) for r in jobs.latest_cells(spark.read.parquet(out)).collect()}
    assert got == {("u1", "x", "5"), ("u1", "y", "3"), ("u2", "x", None)}


def test_failed_events_are_tried_again(spark, feed):
    store = Store(spark, f"{feed.root}/store")
    write_snapshot(store, "t", spark.createDataFrame(
        [("u1", 1, "old")], "uid string, id long, x string"))
    feed.add(event(1, "u1", "I", row={"x": "new"}), event(2, "u1", "U", {"x": "two"}))
    args = (store, "t", "dead", relations(spark), ("uid",), ("id",), f"{feed.root}/cp")
    jobs.stream_retry(feed.stream(), *args).awaitTermination()
    store.begin()
    assert [r.event_id for r in store.read("dead").collect()] == [1]
    assert [r.x for r in store.read("t").collect()] == ["two"]
    # After the old row is gone the waiting insert goes through with the next batch.
    tx = store.begin()
    tx.overwrite("t", store.read("t").limit(0))
    tx.commit()
    feed.add(event(3, "u2", "I", row={"x": "three"}))
    jobs.stream_retry(feed.stream(), *args).awaitTermination()
    store.begin()
    assert store.read("dead").isEmpty()
    assert {(r.uid, r.x) for r in store.read("t").collect()} == {("u1", "new"), ("u2", "three")}


def test_two_streams_of_one_store(spark, feed, tmp_path):
    """Each stream counts its own batches, and other commits in between do not matter."""
    store = Store(spark, f"{feed.root}/store")
    for name in ("t1", "t2"):
        write_snapshot(store, name, spark.createDataFrame(
            [("u1", 1, "old")], "uid string, id long, x string"))
    feed.add(event(1, "u1", "U", {"x": "new"}))

    def run(name, checkpoint):
        jobs.stream_retry(feed.stream(), store, name, f"{name}/dead", relations(spark), ("uid",),
                          ("id",), checkpoint).awaitTermination()
        store.begin()
        return [r.x for r in store.read(name).collect()]

    assert run("t1", f"{feed.root}/cp1") == ["new"]
    assert run("t2", f"{feed.root}/cp2") == ["new"]
    # The first stream's batch 0 comes again after a foreign commit and a later edit: no effect.
    write_snapshot(store, "t1", spark.createDataFrame(
        [("u1", 1, "edited")], "uid string, id long, x string"))
    commit = next((tmp_path / "cp1" / "commits").glob("0"))
    commit.unlink()
    (commit.parent / ".0.crc").unlink(missing_ok=True)
    assert run("t1", f"{feed.root}/cp1") == ["edited"]


def test_retries_do_not_bring_old_values_back(spark, feed):
    store = Store(spark, f"{feed.root}/store")
    write_snapshot(store, "t", spark.createDataFrame(
        [("u1", 1, "old", 0)], "uid string, id long, x string, n int"))
    args = (store, "t", "dead", relations(spark), ("uid",), ("id",), f"{feed.root}/cp")
    for e, changed in enumerate(({"x": "one", "n": "bad"}, {"x": "two"}, {"n": "5"}), start=1):
        feed.add(event(e, "u1", "U", changed))
        jobs.stream_retry(feed.stream(), *args).awaitTermination()
    store.begin()
    assert [(r.x, r.n) for r in store.read("t").collect()] == [("two", 5)]
    assert [r.changed_fields for r in store.read("dead").collect()] == [{"n": "bad"}]


def test_sessions_over_block_edges(spark, monkeypatch):
    """One row edited every second for a while, with one gap, in blocks of three slots."""
    monkeypatch.setattr(jobs, "SLOT_BLOCK", 3)
    log = spark.createDataFrame([
        event(e, "hot", "U", {"x": "1"}, minutes=e / 60 + (10 if e >= 70 else 0)) for e in range(120)
    ] + [event(500 + e, "slow", "D", minutes=30 * e) for e in range(9)], schemas.CHANGE_LOG)
    got = sorted((r.uid, r.n_events) for r in jobs.activity_sessions(log, 2).collect())
    assert got == [("hot", 50), ("hot", 70)] + [("slow", 1)] * 9


def test_sessions_against_a_loop(spark):
    import random

    rng = random.Random(4)
    minutes = sorted(rng.sample(range(2000), 150))
    events = [event(e, rng.choice(["hot", "hot", "b"]), "D", minutes=m)
              for e, m in enumerate(minutes)]
    log = spark.createDataFrame(events, schemas.CHANGE_LOG)
    want = []
    for uid in ("hot", "b"):
        times = [ev[4] for ev in events if ev[10]["uid"] == uid]
        burst = [times[0]]
        for t in times[1:]:
            if (t - burst[-1]).total_seconds() > 1200:
                want.append((uid, len(burst)))
                burst = []
            burst.append(t)
        want.append((uid, len(burst)))
    got = [(r.uid, r.n_events) for r in jobs.activity_sessions(log, 1200).collect()]
    assert sorted(got) == sorted(want)


def test_windows_also_run_on_a_stream(spark, feed):
    feed.add(event(1, "u1", "D"), event(2, "u1", "D"))
    feed.add(event(61, "u1", "D"))
    rows = {(r.window_start, r.n_events)
            for r in jobs.activity_windows(feed.batch(), "1 hour").collect()}
    assert {n for _, n in rows} == {2, 1}
    query = jobs.activity_windows(feed.stream(), "1 hour").writeStream.outputMode(
        "complete").format("memory").queryName("activity").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r.window_start, r.n_events) for r in spark.table("activity").collect()} == rows


def test_mark_replayed_is_one_receipt_per_event(spark, feed):
    feed.add(event(1, "u1", "U", {"x": "1", "y": "2"}))
    changes = pending.to_field_grain(feed.batch(), relations(spark))
    assert changes.count() == 2
    got = replay.mark_replayed(changes, "a", "s1").select(F.struct("*")).collect()
    assert [tuple(r[0]) for r in got] == [(1, "a", "s1")]
