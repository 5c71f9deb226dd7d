"""Tables laid out by uid: a change rewrites the buckets that it hits, and nothing else."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starsync import schemas
from starsync.operators import compare
from starsync.plans import sync
from starsync.sources.store import Store, bucket

CENTRE, CLONE, IDENT = "centre", "clone_a", "field.posts"
NAME = sync.table_name(CENTRE, IDENT)
ROWS = [(i, f"p{i:03d}", f"post {i}") for i in range(100)]


def segments(store, name=NAME):
    """The folders of a table, by bucket."""
    return {int(s.rsplit("=", 1)[1]): s for s in store._manifest()[name]["segments"]}


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path), bucket_rows=10)
    tx = made.begin()
    table = spark.createDataFrame(ROWS, "id long, uid string, name string")
    for node in (CENTRE, CLONE):
        tx.overwrite(sync.table_name(node, IDENT), table, key="uid", rows=100)
    tx.overwrite(f"{CENTRE}/relations", spark.createDataFrame([(IDENT, "id")], schemas.RELATIONS))
    tx.overwrite(f"{CENTRE}/sync_tables", spark.createDataFrame([(CLONE, ['"field"."posts"'])], schemas.SYNC_TABLES))
    tx.append(f"{CENTRE}/history", sync.history_rows(spark, {
        "sync_id": "s", "seq": 1, "sync_time": datetime(2024, 1, 1), "server_from": CENTRE, "server_to": CLONE,
        "min_event_id": -1, "max_event_id": 0, "max_tstamp_tx": datetime(2024, 1, 1), "sync_type": "full",
        "sync_status": "done"}))
    tx.commit()
    return made


def edit(store, node, now, expr):
    name = sync.table_name(node, IDENT)
    sync.log_edit(store, node, IDENT, store.read(name).withColumn("name", F.expr(expr)), now)


def test_buckets_hold_all_rows_once(store):
    assert store.layout(NAME) == ("uid", 10) and len(segments(store)) > 5
    assert sorted(map(tuple, store.read(NAME).collect())) == ROWS
    some = store.read_buckets(NAME, [0, 3])
    assert some.count() and some.where(~bucket("uid", 10).isin(0, 3)).isEmpty()
    assert store.read_buckets(NAME, []).isEmpty()


def test_a_round_rewrites_the_buckets_that_it_hits(store, spark):
    """One row in a hundred changes on either side: one bucket's files are new on either side."""
    hit = {u: spark.createDataFrame([(u,)], "uid string").select(bucket("uid", 10)).first()[0] for u in ("p007", "p042")}
    names = (NAME, sync.table_name(CLONE, IDENT))
    before = {n: segments(store, n) for n in names}
    edit(store, CENTRE, datetime(2024, 1, 2), "if(uid = 'p007', 'by centre', name)")
    edit(store, CLONE, datetime(2024, 1, 3), "if(uid = 'p042', 'by clone', name)")
    for name, uid in zip(names, hit):  # the edits themselves
        now = segments(store, name)
        assert {k for k in now if now[k] != before[name][k]} == {hit[uid]}
    before = {n: segments(store, n) for n in names}
    done = sync.synchronize(store, CLONE, CENTRE, datetime(2024, 1, 4))
    assert (done.to_clone, done.to_central) == (1, 1)
    for name, uid in zip(names, reversed(hit)):
        now = segments(store, name)
        assert {k for k in now if now[k] != before[name][k]} == {hit[uid]}
        found = {r.uid: r.name for r in store.read(name).where("uid in ('p007', 'p042')").collect()}
        assert found == {"p007": "by centre", "p042": "by clone"} and store.read(name).count() == 100
    assert sync.compare_star(store, [CLONE], CENTRE).isEmpty()


def test_inserts_and_deletes_reach_their_buckets(store, spark):
    name = sync.table_name(CLONE, IDENT)
    rows = store.read(name).where("uid <> 'p010'")
    more = spark.createDataFrame([(900, "new1", "x"), (901, "new2", "y")], rows.schema)
    sync.log_edit(store, CLONE, IDENT, rows.unionByName(more), datetime(2024, 1, 2))
    before = segments(store)
    sync.synchronize(store, CLONE, CENTRE, datetime(2024, 1, 3))
    uids = {r.uid for r in store.read(NAME).collect()}
    assert uids == {u for _, u, _ in ROWS if u != "p010"} | {"new1", "new2"}
    assert sum(before.get(k) != s for k, s in segments(store).items()) <= 3
    assert sync.compare_star(store, [CLONE], CENTRE).isEmpty()


def test_plain_tables_get_a_layout_with_their_first_change(store, spark):
    tx = store.begin()
    tx.overwrite(NAME, store.read(NAME))
    tx.commit()
    assert store.layout(NAME) is None
    edit(store, CLONE, datetime(2024, 1, 2), "if(uid = 'p007', 'a', name)")
    sync.synchronize(store, CLONE, CENTRE, datetime(2024, 1, 3))
    assert store.layout(NAME) == ("uid", 10) and store.read(NAME).count() == 100


def test_appends_end_a_layout(store, spark):
    tx = store.begin()
    tx.append(NAME, spark.createDataFrame([(500, "p500", "z")], store.read(NAME).schema))
    tx.commit()
    assert store.layout(NAME) is None and store.read(NAME).count() == 101


def test_vacuum_keeps_buckets_in_use(store):
    for i in range(3):
        edit(store, CENTRE, datetime(2024, 1, 2 + i), f"if(uid = 'p00{i}', 'v{i}', name)")
    assert store.compact(most=1) != [] and store.layout(NAME)
    assert store.vacuum(keep=1) > 0
    assert store.read(NAME).count() == 100
    assert sorted(r.name for r in store.read(NAME).where("uid in ('p000', 'p001', 'p002')").collect()) == ["v0", "v1", "v2"]


def test_a_bucket_may_become_empty(store, spark):
    rows = store.read(NAME)
    gone = rows.where(bucket("uid", 10) == 4)
    assert gone.count()
    sync.log_edit(store, CENTRE, IDENT, rows.where(bucket("uid", 10) != 4), datetime(2024, 1, 2))
    assert 4 not in segments(store)
    sync.synchronize(store, CLONE, CENTRE, datetime(2024, 1, 3))
    assert sync.compare_star(store, [CLONE], CENTRE).isEmpty()


def test_equal_buckets_are_not_compared_row_by_row(store, spark):
    """Digests of buckets tell where rows differ; equal tables shuffle no rows."""
    left = store.read(NAME)
    right = left.withColumn("name", F.expr("if(uid = 'p042', null, name)"))
    assert compare.compare_all({"same": (left, left, ["id"])}).collect() == []
    found = compare.compare_all({"same": (left, left, ["id"]), "one": (left, right, ["id"])}, buckets=16)
    assert [tuple(r) for r in found.collect()] == [("one", "table 1 != table 2", 1)]
    # A null that moves to another column is a difference.
    a = spark.createDataFrame([(1, "u", None, "x")], "id long, uid string, c string, d string")
    b = spark.createDataFrame([(1, "u", "x", None)], "id long, uid string, c string, d string")
    assert compare.compare_all({"moved": (a, b, ["id"])}).count() == 1
    plan = compare.compare_all({"same": (left, left, ["id"])})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "FileScan" not in plan
