import random

from pyspark.sql import functions as F

from starsync.operators import resolve

SCHEMA = ("event_id long, tstamp_tx timestamp, ident string, action string,"
          " field string, value string, uid string, orig_micros long")


def side(spark, seed, n, letter):
    from datetime import datetime

    rng = random.Random(seed)
    rows = []
    for e in range(n):
        action = rng.choice("UUUUIDT")
        uid = None if action == "T" else ("hot" if rng.random() < 0.4 else f"u{rng.randrange(8)}")
        rows.append((
            e, datetime(2024, 1, 1), "s.t", action,
            rng.choice("abc") if action == "U" else None, f"{letter}{e}", uid,
            rng.randrange(20)))
    return spark.createDataFrame(rows, SCHEMA)


def key(rows):
    return sorted(
        (str(r.event_id), r.action, str(r.field), str(r.uid), r.value) for r in rows.collect())


def test_one_shuffle_form_equals_the_steps(spark):
    for mode in ("updates", "reference"):
        central, clone = side(spark, 1, 200, "x"), side(spark, 2, 200, "y")
        a, b = resolve.compact(central, mode), resolve.compact(clone, mode)
        fights = resolve.resolve(resolve.detect_conflicts(a, b))
        merged = resolve.reconcile(central, clone, mode)
        assert key(resolve.survivors(merged, "central")) == key(
            resolve.drop_rejected(a, fights, "central"))
        assert key(resolve.survivors(merged, "clone")) == key(
            resolve.drop_rejected(b, fights, "clone"))
        cols = ["uid", "field", "central_event_id", "clone_event_id", "rejected"]
        assert sorted(map(tuple, resolve.reconciled_conflicts(merged).select(cols).collect())) \
            == sorted(map(tuple, fights.select(cols).collect()))


def test_tie_goes_to_the_centre(spark):
    base = side(spark, 1, 1, "x").limit(0)
    row = ("s.t", "U", "a", "v", "u1")
    from datetime import datetime

    def change(micros):
        return spark.createDataFrame(
            [(1, datetime(2024, 1, 1), *row, micros)], base.schema)

    for central, clone, loser in ((5, 5, "clone"), (5, 6, "central"), (6, 5, "clone")):
        fights = resolve.resolve(resolve.detect_conflicts(change(central), change(clone)))
        assert [r.rejected for r in fights.collect()] == [loser]


def test_updates_against_deletes_do_not_conflict(spark):
    log = side(spark, 5, 60, "x")
    assert resolve.detect_conflicts(
        log.filter("action = 'U'"), log.filter("action = 'D'")).isEmpty()


def test_hot_row_is_reduced_before_the_shuffle(spark):
    """The plan aggregates per task before it exchanges rows."""
    plan = resolve.reconcile(side(spark, 1, 10, "x"), side(spark, 2, 10, "y"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange") < text.index("partial_max_by")


def test_report_counts(spark):
    ledger = spark.createDataFrame(
        [("s.t", "a", "clone"), ("s.t", "a", "clone"), ("s.t", "b", "central")],
        "ident string, clone_id string, rejected string")
    got = {tuple(r) for r in resolve.conflict_report(ledger).collect()}
    assert got == {("s.t", "a", "clone", 2), ("s.t", "b", "central", 1)}
    assert {tuple(r) for r in resolve.conflict_report(ledger, ["rejected"]).select(
        "rejected", F.col("n_conflicts")).collect()} == {("clone", 2), ("central", 1)}
