"""Lag by dominance counting and receipts as ranges, against plain versions."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from starsync import schemas
from starsync.operators import history, receipts

T0 = datetime(2024, 1, 1)
RECORD = "clone string, id long, t timestamp"


def state(spark, marks):
    """One finished round from the centre for each mark."""
    return spark.createDataFrame(marks, RECORD).select(
        F.col("clone").alias("sync_id"), F.lit(T0).alias("sync_time"),
        F.lit("c").alias("server_from"), F.array("clone").alias("server_to"),
        F.lit(1).cast("long").alias("min_event_id"), F.col("id").alias("max_event_id"),
        F.col("t").alias("max_tstamp_tx"), F.lit("done").alias("sync_status"))


@pytest.mark.parametrize("n_marks, n_events, span", [
    (0, 10, 5), (1, 40, 6), (2, 40, 4), (7, 300, 9), (8, 300, 40), (10_000, 3_000, 20_000)])
def test_lag_equals_a_plain_count(spark, n_marks, n_events, span):
    rng = random.Random(n_marks)

    def draw(n):
        return [(rng.randrange(span), rng.randrange(span)) for _ in range(n)]

    marks, events = draw(n_marks), draw(n_events)
    rounds = state(spark, [
        (f"k{i}", a, T0 + timedelta(seconds=b)) for i, (a, b) in enumerate(marks)])
    log = spark.createDataFrame(
        [(a, T0 + timedelta(seconds=b)) for a, b in events], "event_id long, tstamp_tx timestamp")
    got = {r.clone_id: (r.max_event_id, r.n_events)
           for r in history.sync_lag(rounds, log, "c").collect()}
    e = np.array(events)
    assert got == {f"k{i}": (a, int(((e[:, 0] > a) & (e[:, 1] > b)).sum()))
                   for i, (a, b) in enumerate(marks)}


def test_lag_of_marks_and_events_without_id_or_time(spark):
    rounds = state(spark, [("a", None, T0), ("b", 1, None), ("c", 1, T0)])
    late = T0 + timedelta(days=1)
    log = spark.createDataFrame([(2, late), (None, late), (3, None)],
                                "event_id long, tstamp_tx timestamp")
    got = {r.clone_id: r.n_events for r in history.sync_lag(rounds, log, "c").collect()}
    assert got == {"a": 0, "b": 0, "c": 1}
    empty = history.sync_lag(rounds, log.limit(0), "c").collect()
    assert {r.clone_id: r.n_events for r in empty} == {"a": 0, "b": 0, "c": 0}


def ranges_of(ids):
    out = []
    for i in sorted(set(ids)):
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return [tuple(r) for r in out]


def test_a_run_of_receipts_is_one_row_over_many_blocks(spark):
    n = 3 * receipts.BLOCK + 17
    rows = spark.range(5, 5 + n).select(
        F.col("id").alias("event_id"), F.lit("a").alias("server_id"), F.lit("r").alias("sync_id"))
    assert [tuple(r) for r in receipts.to_ranges(rows).collect()] == [("a", 5, 4 + n)]


@pytest.mark.parametrize("seed", range(4))
def test_ranges_hold_the_receipts_of_each_clone(spark, seed):
    rng = random.Random(seed)
    top = 3 * receipts.BLOCK
    seen = {c: [i for i in range(top) if rng.random() < share]
            for c, share in (("a", 0.9), ("b", 0.01), ("c", 0.999))}
    rows = [(i, c, "r") for c, ids in seen.items() for i in ids]
    rows += rng.sample(rows, 500) + [(None, "a", "r"), (3, None, "r")]
    given = spark.createDataFrame(rows, schemas.RECEIPTS)
    ranges = receipts.to_ranges(given).persist()
    for c, ids in seen.items():
        got = ranges.filter(F.col("server_id") == c)
        assert sorted((r.lo, r.hi) for r in got.collect()) == ranges_of(ids)
        log = spark.range(-5, top + 5).withColumnRenamed("id", "event_id")
        want = set(range(-5, top + 5)) - set(ids)
        assert {r.event_id for r in receipts.unreceived(log, got).collect()} == want
        after = receipts.unreceived(log.filter("event_id > 4100"), got, F.lit(4100)).collect()
        assert {r.event_id for r in after} == {i for i in want if i > 4100}
    back = {(r.server_id, r.event_id) for r in receipts.to_events(ranges).collect()}
    assert back == {(c, i) for c, ids in seen.items() for i in ids}
    # What rounds append, overlapping or adjacent, is merged the same way.
    again = receipts.to_ranges(ranges.unionByName(spark.createDataFrame(
        [("a", 0, top), ("a", top + 1, top + 9), ("d", 7, 7)], schemas.RECEIPT_RANGES)))
    merged = sorted(tuple(r) for r in again.collect() if r.server_id in "ad")
    assert merged == [("a", 0, top + 9), ("d", 7, 7)]


def test_no_receipts(spark):
    none = spark.createDataFrame([], schemas.RECEIPTS)
    assert receipts.to_ranges(none).count() == 0
    log = spark.range(3).withColumnRenamed("id", "event_id")
    assert receipts.unreceived(log, receipts.to_ranges(none)).count() == 3
