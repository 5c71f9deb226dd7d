from datetime import datetime

from pyspark.sql import functions as F

from starsync import schemas
from starsync.operators import capture, history, numbering, registry


def test_insert_if_absent_takes_many_keys(spark):
    schema = "relation_name string, uid_column string"
    target = spark.createDataFrame([("s.a", "id")], schema)
    rows = spark.createDataFrame(
        [("s.a", "id"), ("s.v", "k1"), ("s.v", "k2"), ("s.v", "k2")], schema)
    got = registry.insert_if_absent(target, rows, ["relation_name", "uid_column"])
    assert sorted(map(tuple, got.collect())) == [("s.a", "id"), ("s.v", "k1"), ("s.v", "k2")]


def test_capture_audits(spark):
    inventory = spark.createDataFrame(
        [("s", "a"), ("s", "b"), ("public", "p"), ("starsync", "x"), ("z", "c")],
        "schema_name string, table_name string")
    relations = spark.createDataFrame([("s.a", "id"), ("public.p", "id")], schemas.RELATIONS)

    def names(df):
        return sorted(r.relation_name for r in df.collect())

    assert names(registry.missing_capture(inventory, relations)) == ["s.b", "z.c"]
    assert names(registry.missing_capture(inventory, relations, schemas=["s", "public"])) == [
        "s.b"]
    assert names(registry.captured_tables(inventory, relations, only=["public.p", "s.b"])) == [
        "public.p"]


def test_random_uid_column_is_added_once(spark):
    df, added = registry.add_uid(spark.range(5))
    assert added and df.filter(F.col("uid").rlike("^[0-9a-f-]{36}$")).count() == 5
    assert registry.add_uid(df) == (df, False)


def test_whitelists_keep_repeats_on_write(spark):
    lists = [spark.createDataFrame(rows, schemas.SYNC_TABLES) for rows in (
        [("a", ['"s"."t"']), ("b", ['"s"."u"'])], [("a", ['"s"."v"', '"s"."t"']), ("c", ["x.y"])])]
    got = {r.server_id: r.tables for r in registry.merge_whitelist(*lists).collect()}
    assert got == {"a": ['"s"."v"', '"s"."t"', '"s"."t"'], "b": ['"s"."u"'], "c": ["x.y"]}
    by_schema = {tuple(r) for r in registry.tables_by_schema(lists[0]).collect()}
    assert by_schema == {("s", '"t","u"')}


def test_history_needs_a_finished_round(spark):
    t = [datetime(2024, 1, d) for d in range(1, 6)]
    rows = [
        ("r1", 1, t[0], "c", "a", 1, 10, t[0], "full", "pending"),
        ("r1", 3, None, None, None, None, None, None, None, "done"),
        ("r1", 2, None, None, "b", None, None, None, None, None),
        ("r2", 1, t[1], "c", "a", 11, 20, t[1], "partial", "pending"),
        ("r3", 1, t[2], "a", "c", None, None, None, "partial", "done"),
        ("r4", 1, t[3], "c", None, 1, 30, t[3], "full", "done"),
    ]
    state = history.fold_history(spark.createDataFrame(rows, schemas.HISTORY_RECORDS))
    got = {r.sync_id: (r.server_to, r.sync_status, r.max_event_id) for r in state.collect()}
    assert got == {"r1": (["a", "b"], "done", 10), "r2": (["a"], "pending", 20),
                   "r3": (["c"], "done", None), "r4": (None, "done", 30)}
    marks = {r.clone_id: r.max_event_id for r in history.last_sync(state, "c").collect()}
    assert marks == {"a": 10, "b": 10}
    log = spark.createDataFrame(
        [(10, t[4]), (11, t[4]), (12, t[0]), (13, t[1])], "event_id long, tstamp_tx timestamp")
    lag = {r.clone_id: r.n_events for r in history.sync_lag(state, log, "c").collect()}
    assert lag == {"a": 2, "b": 2}


def test_numbers_have_no_gaps_when_leading_keys_tie(spark):
    df = spark.range(1000).withColumn("t", F.lit(1)).repartition(7)
    got = [r.n for r in numbering.number_rows(df, ["t", "id"], "n", 5).orderBy("id").collect()]
    assert got == list(range(6, 1006))


def test_statement_level_capture(spark):
    old = spark.createDataFrame([("u1", 1), ("u2", 2)], "uid string, x long")
    new = spark.createDataFrame([("u1", 5), ("u3", 2)], "uid string, x long")

    def kinds(a, b):
        return sorted(r.action for r in capture.capture_statements(a, b, "s.t").collect())

    assert kinds(old, new) == ["D", "I", "U"]
    assert kinds(old, old.limit(0)) == ["T"]
    assert kinds(old.limit(0), old.limit(0)) == []
    assert kinds(old, old) == []
