"""Sync rounds between a centre and two clones: the golden scenarios, and the error paths."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starsync import schemas
from starsync.operators.history import fold_history, last_sync
from starsync.operators import receipts, replay
from starsync.operators.replay import ReplayError
from starsync.plans import package, sync
from starsync.sources.store import Store

CENTRE, A, B = "centre", "clone_a", "clone_b"
GAUGES, AREAS = "field.gauges", "field.areas"
NAMES = {
    GAUGES: "id long, uid string, name string, photo string",
    AREAS: "id long, uid string, code string, label string, url string",
}


class Star:
    """A centre with two tables, and clones seeded from its package."""

    def __init__(self, spark, root):
        self.spark = spark
        self.store = Store(spark, f"{root}/store")
        self.root = root
        self.time = datetime(2024, 1, 1)
        tables = {
            GAUGES: [(i, f"g{i}", f"gauge {i}", None) for i in range(1, 5)],
            AREAS: [(i, f"a{i}", f"C{i}", f"area {i}", None) for i in range(1, 6)],
        }
        tx = self.store.begin()
        for ident, rows in tables.items():
            tx.overwrite(sync.table_name(CENTRE, ident), spark.createDataFrame(rows, NAMES[ident]))
        tx.overwrite(f"{CENTRE}/relations", spark.createDataFrame(
            [(GAUGES, "id"), (AREAS, "id")], schemas.RELATIONS))
        tx.commit()

    def now(self):
        self.time += timedelta(minutes=1)
        return self.time

    def seed(self, *clones):
        path = f"{self.root}/package-{self.store.version}"
        package.package(self.store, path, [GAUGES, AREAS], CENTRE, self.now())
        for clone in clones:
            package.deploy(self.store, path, clone, self.now())
        return path

    def read(self, node, ident):
        return self.store.read(sync.table_name(node, ident))

    def edit(self, node, ident, uid, **values):
        df = self.read(node, ident)
        for column, value in values.items():
            df = df.withColumn(
                column, F.when(F.col("uid") == uid, F.lit(value)).otherwise(F.col(column)))
        sync.log_edit(self.store, node, ident, df, self.now())

    def insert(self, node, ident, *row):
        df = self.read(node, ident)
        new = self.spark.createDataFrame([row], df.schema)
        sync.log_edit(self.store, node, ident, df.unionByName(new), self.now())

    def delete(self, node, ident, uid):
        df = self.read(node, ident)
        sync.log_edit(self.store, node, ident, df.filter(F.col("uid") != uid), self.now())

    def sync(self, clone):
        return sync.synchronize(self.store, clone, CENTRE, self.now())

    def cell(self, node, ident, uid, column):
        rows = self.read(node, ident).filter(F.col("uid") == uid).select(column).collect()
        return rows[0][0] if rows else "(no row)"

    def everywhere(self, ident, uid, column, nodes=(CENTRE, A, B)):
        return {self.cell(n, ident, uid, column) for n in nodes}

    def differences(self, *clones):
        return sync.compare_star(self.store, clones, CENTRE).collect()


@pytest.fixture
def star(spark, tmp_path):
    return Star(spark, str(tmp_path))


def test_one_clone(star):
    star.seed(A)
    # The centre edits one row, the clone another table.
    star.edit(CENTRE, GAUGES, "g1", name="by centre")
    star.edit(A, AREAS, "a1", label="by a")
    done = star.sync(A)
    assert (done.to_clone, done.to_central, done.conflicts) == (1, 1, 0)
    assert star.everywhere(GAUGES, "g1", "name", (CENTRE, A)) == {"by centre"}
    assert star.everywhere(AREAS, "a1", "label", (CENTRE, A)) == {"by a"}
    # Same column of different rows, and different columns of the same row: all edits survive.
    star.edit(CENTRE, AREAS, "a2", label="a2 by centre")
    star.edit(A, AREAS, "a3", label="a3 by a")
    star.edit(CENTRE, AREAS, "a4", label="a4 by centre")
    star.edit(A, AREAS, "a4", url="a4 by a")
    # Same row and column, the clone is later: the clone wins and the fight is on record.
    star.edit(CENTRE, AREAS, "a5", label="a5 by centre")
    star.edit(A, AREAS, "a5", label="a5 by a, it's later")
    done = star.sync(A)
    assert (done.to_clone, done.to_central, done.conflicts) == (2, 3, 1)
    assert star.everywhere(AREAS, "a2", "label", (CENTRE, A)) == {"a2 by centre"}
    assert star.everywhere(AREAS, "a3", "label", (CENTRE, A)) == {"a3 by a"}
    assert star.everywhere(AREAS, "a4", "label", (CENTRE, A)) == {"a4 by centre"}
    assert star.everywhere(AREAS, "a4", "url", (CENTRE, A)) == {"a4 by a"}
    assert star.everywhere(AREAS, "a5", "label", (CENTRE, A)) == {"a5 by a, it's later"}
    fight = star.store.read(f"{CENTRE}/conflicts").collect()
    assert [(r.ident, r.uid, r.rejected, r.clone_id) for r in fight] == [
        (AREAS, "a5", "central", A)]
    assert fight[0].clone_sql.endswith("""'a5 by a, it''s later' WHERE "uid" = 'a5'""")
    # Nothing is left: the rejected event of the centre counts as seen and never comes back.
    assert star.sync(A).quiet
    assert star.differences(A) == []


def test_two_clones_edit_the_same_cell(star):
    star.seed(A, B)
    star.edit(A, GAUGES, "g1", photo="from A")
    star.edit(B, GAUGES, "g1", photo="from B")
    for clone in (A, B, A):
        star.sync(clone)
    assert star.everywhere(GAUGES, "g1", "photo") == {"from B"}
    # The later editor syncs first: the earlier edit must lose to the original time.
    star.edit(A, AREAS, "a1", label="label a")
    star.edit(B, AREAS, "a1", label="label b, it's last")
    star.sync(B)
    done = star.sync(A)
    assert (done.conflicts, done.to_central) == (1, 0)
    star.sync(B)
    assert star.everywhere(AREAS, "a1", "label") == {"label b, it's last"}
    assert star.differences(A, B) == []


def test_inserts_deletes_and_failures(star):
    star.seed(A, B)
    star.insert(A, GAUGES, 5, "g5", "new at a", None)
    star.insert(B, GAUGES, 5, "g6", "new at b", None)
    star.delete(A, AREAS, "a1")
    star.edit(B, AREAS, "a1", label="edited while deleted elsewhere")
    star.sync(A)
    star.sync(B)
    done = star.sync(A)
    assert done.failed == 0
    # Each database numbers the rows itself; the uid is what counts.
    assert star.everywhere(GAUGES, "g5", "name") == {"new at a"}
    assert star.everywhere(GAUGES, "g6", "name") == {"new at b"}
    ids = [r.id for r in star.read(CENTRE, GAUGES).collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6]
    assert star.everywhere(AREAS, "a1", "label") == {"(no row)"}
    assert star.differences(A, B) == []

    # A row both sides insert under one uid fails at the centre and stays in the clone's log ...
    star.insert(A, GAUGES, 7, "g7", "twin at a", None)
    log = star.store.read(f"{A}/log")
    star.insert(CENTRE, GAUGES, 7, "g7", "twin at centre", None)
    version = star.store.version
    with pytest.raises(ReplayError):
        star.sync(A)  # ... but the centre's twin cannot be applied at the clone as a whole
    star.store.begin()
    assert star.store.version == version
    # Once the centre's twin is gone, the kept events go through.
    star.delete(CENTRE, GAUGES, "g7")
    star.delete(A, GAUGES, "g7")
    assert log.count() == 1


def test_failed_insert_is_retried(star):
    star.seed(A)
    # A twin that the centre holds without having logged it.
    tx = star.store.begin()
    name = sync.table_name(CENTRE, GAUGES)
    twin = star.spark.createDataFrame([(9, "g9", "twin", None)], NAMES[GAUGES])
    tx.overwrite(name, star.read(CENTRE, GAUGES).unionByName(twin))
    tx.commit()
    star.insert(A, GAUGES, 9, "g9", "from a", None)
    star.edit(A, GAUGES, "g1", name="fine")
    done = star.sync(A)
    assert (done.to_central, done.failed) == (1, 1)
    assert star.cell(CENTRE, GAUGES, "g1", "name") == "fine"
    kept = star.store.read(f"{A}/log").collect()
    assert [r.action for r in kept] == ["I"]
    tx = star.store.begin()
    tx.overwrite(name, star.read(CENTRE, GAUGES).filter("uid != 'g9'"))
    tx.commit()
    done = star.sync(A)
    assert (done.to_central, done.failed) == (1, 0)
    assert star.cell(CENTRE, GAUGES, "g9", "name") == "from a"
    assert star.store.read(f"{A}/log").isEmpty()


def test_nothing_pending_without_history_or_list(star):
    star.seed(A)
    star.edit(CENTRE, GAUGES, "g1", name="by centre")
    tx = star.store.begin()
    lists = star.store.read(f"{CENTRE}/sync_tables")
    tx.overwrite(f"{CENTRE}/sync_tables", lists.filter("server_id = 'nobody'"))
    tx.commit()
    assert star.sync(A).quiet
    tx = star.store.begin()
    tx.overwrite(f"{CENTRE}/sync_tables", lists)
    tx.overwrite(f"{CENTRE}/history", star.store.read(f"{CENTRE}/history").limit(0))
    tx.commit()
    assert star.sync(A).quiet


def test_package_guards(star, spark):
    path = star.seed(A)
    star.edit(CENTRE, GAUGES, "g1", name="by centre")
    star.sync(A)
    with pytest.raises(package.PackageError, match="newer sync"):
        package.deploy(star.store, path, A, star.now())
    package.deploy(star.store, path, B, star.now(), post_deploy={
        GAUGES: lambda df: df.withColumn("photo", F.lit("hooked"))})
    assert star.cell(B, GAUGES, "g2", "photo") == "hooked"
    marks = last_sync(fold_history(star.store.read(f"{CENTRE}/history")), CENTRE)
    assert {r.clone_id for r in marks.collect()} == {A, B}
    # The clone seeded later still gets what happened since the package.
    star.sync(B)
    assert star.cell(B, GAUGES, "g1", "name") == "by centre"

    tx = star.store.begin()
    tx.overwrite(f"{CENTRE}/table/field.loose", spark.createDataFrame([(1,)], "id long"))
    tx.commit()
    with pytest.raises(package.PackageError) as error:
        package.package(star.store, f"{path}-x", ["field.loose"], CENTRE, star.now())
    assert "not captured" in str(error.value) and "no uid column" in str(error.value)
    twice = spark.createDataFrame([(1, "x"), (2, "x")], "id long, uid string")
    tx = star.store.begin()
    tx.overwrite(f"{CENTRE}/table/field.loose", twice)
    tx.append(f"{CENTRE}/relations", spark.createDataFrame(
        [("field.loose", "id")], schemas.RELATIONS))
    tx.commit()
    with pytest.raises(package.PackageError, match="uid is not unique"):
        package.package(star.store, f"{path}-y", ["field.loose"], CENTRE, star.now())


def test_failed_events_do_not_keep_a_star_going(star):
    star.seed(A, B)
    # A table that the centre does not have: its events fail in every round.
    tx = star.store.begin()
    own = star.spark.createDataFrame([(1, "x1", "old")], "id long, uid string, note string")
    tx.overwrite(sync.table_name(A, "field.private"), own)
    tx.append(f"{CENTRE}/relations", star.spark.createDataFrame(
        [("field.private", "id")], schemas.RELATIONS))
    tx.commit()
    star.edit(A, "field.private", "x1", note="new")
    star.edit(A, AREAS, "a1", label="by a")
    star.edit(B, AREAS, "a1", label="by b, later")
    rounds = sync.synchronize_star(star.store, (A, B), CENTRE, star.now)
    assert [(c, r.failed) for c, r in rounds] == [(A, 1), (B, 0)] * (len(rounds) // 2)
    assert len(rounds) <= 8 and all(r.quiet for _, r in rounds[-2:])
    assert star.everywhere(AREAS, "a1", "label") == {"by b, later"}
    assert [r.table_name for r in star.store.read(f"{A}/log").collect()] == ["private"]
    star.edit(A, AREAS, "a2", label="again")
    with pytest.raises(sync.NotConverged):
        sync.synchronize_star(star.store, (A, B), CENTRE, star.now, max_cycles=1)


def test_inserts_are_logged_as_stored(star):
    star.seed(A, B)
    star.insert(A, GAUGES, 5, "g5", "from a", None)
    star.insert(B, GAUGES, 5, "g6", "from b", None)
    star.sync(A)
    star.sync(B)
    log = star.store.read(f"{CENTRE}/log").filter("action = 'I'")
    ids = {r.uid: int(r.id) for r in log.selectExpr("row_data['uid'] uid", "row_data['id'] id").collect()}
    assert ids == {r.uid: r.id for r in star.read(CENTRE, GAUGES).filter("uid in ('g5', 'g6')").collect()}
    assert len(set(ids.values())) == 2
    # Rolling back the second insert by its primary key removes that row.
    chosen = log.filter("row_data['uid'] = 'g6'").select("event_id")
    left = replay.rollback_events(
        star.read(CENTRE, GAUGES), star.store.read(f"{CENTRE}/log"), chosen, GAUGES, ["id"]).snapshot
    assert {r.uid for r in left.collect()} == {"g1", "g2", "g3", "g4", "g5"}


def test_event_ids_go_on_after_the_log_is_emptied(star):
    star.seed(A)
    star.edit(A, AREAS, "a1", label="one")
    first = star.store.read(f"{A}/log").first().event_id
    star.sync(A)
    assert star.store.read(f"{A}/log").isEmpty()
    star.edit(A, AREAS, "a1", label="two")
    assert star.store.read(f"{A}/log").first().event_id == first + 1


def test_missing_and_unregistered_tables_are_reported(star):
    star.seed(A)
    tx = star.store.begin()
    del tx._entries[sync.table_name(A, AREAS)]
    tx.overwrite(sync.table_name(A, "field.extra"), star.read(A, GAUGES))
    tx.overwrite(sync.table_name(CENTRE, "field.extra"), star.read(A, GAUGES))
    tx.commit()
    assert {(r.label, r.status, r.n_rows) for r in star.differences(A)} == {
        (f"{A}:{AREAS}", "table 1 is missing", 5), (f"{A}:field.extra", "not registered", 4)}


def test_round_options(star):
    star.seed(A)
    star.edit(CENTRE, AREAS, "a1", label="new label", url="hidden")
    star.edit(A, AREAS, "a2", url="hidden, too")
    sync.synchronize(star.store, A, CENTRE, star.now(), excluded=("url",))
    assert star.cell(A, AREAS, "a1", "label") == "new label"
    assert star.cell(A, AREAS, "a1", "url") is None and star.cell(CENTRE, AREAS, "a2", "url") is None
    # Only listed tables go to the centre; the other events wait in the clone's log.
    tx = star.store.begin()
    tx.overwrite(f"{CENTRE}/sync_tables", star.spark.createDataFrame(
        [(A, ['"field"."gauges"'])], schemas.SYNC_TABLES))
    tx.commit()
    star.edit(A, GAUGES, "g1", name="listed")
    star.edit(A, AREAS, "a3", label="not listed")
    sync.synchronize(star.store, A, CENTRE, star.now(), only_listed=True)
    assert star.cell(CENTRE, GAUGES, "g1", "name") == "listed"
    assert star.cell(CENTRE, AREAS, "a3", "label") == "area 3"
    assert [r.table_name for r in star.store.read(f"{A}/log").collect()] == ["areas"]
    # Without marks, an event that committed below the mark still arrives.
    log = star.store.read(f"{CENTRE}/log")
    late = log.orderBy("event_id").limit(1).withColumn("event_id", F.lit(-1).cast("long")).withColumn(
        "table_name", F.lit("gauges")).withColumn("action", F.lit("U")).withColumn(
        "row_data", F.expr("map('uid', 'g2')")).withColumn(
        "changed_fields", F.expr("map('name', 'late')"))
    tx = star.store.begin()
    tx.append(f"{CENTRE}/log", late)
    tx.commit()
    star.sync(A)
    assert star.cell(A, GAUGES, "g2", "name") == "gauge 2"
    sync.synchronize(star.store, A, CENTRE, star.now(), use_marks=False)
    assert star.cell(A, GAUGES, "g2", "name") == "late"


def test_rounds_keep_receipts_as_ranges(spark, tmp_path):
    star = Star(spark, str(tmp_path))
    star.seed(A, B)
    for n in range(3):
        star.edit(CENTRE, GAUGES, f"g{n + 1}", name=f"new {n}")
        star.sync(A)
    star.edit(B, AREAS, "a1", label="other")
    star.sync(B)
    held = star.store.read(f"{CENTRE}/receipt_ranges", schemas.RECEIPT_RANGES)
    before = {(r.server_id, r.event_id) for r in receipts.to_events(held).collect()}
    assert f"{CENTRE}/receipts" not in star.store
    mine = {e for who, e in before if who == A}
    assert len(mine) == 3 and held.filter(F.col("server_id") == A).count() == 3
    # Three rounds' runs are adjacent: one row after merging, the same events.
    assert mine == set(range(min(mine), max(mine) + 1))
    n = sync.merge_receipts(star.store, CENTRE)
    merged = star.store.read(f"{CENTRE}/receipt_ranges", schemas.RECEIPT_RANGES)
    assert merged.count() == n and merged.filter(F.col("server_id") == A).count() == 1
    assert {(r.server_id, r.event_id) for r in receipts.to_events(merged).collect()} == before
    # Ranges alone tell what a clone has seen.
    done = sync.synchronize(star.store, A, CENTRE, star.now(), use_marks=False)
    assert done.to_clone == 1 and star.cell(A, AREAS, "a1", "label") == "other"
