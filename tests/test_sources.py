import json

import pytest
from pyspark.sql import types as T

from starsync.sources.files import export_csv, read_feature_collection, read_features
from starsync.sources.jdbc import jdbc_options
from starsync.sources.store import CommitConflict, Store, read_snapshot, write_snapshot


def test_uncommitted_writes_do_not_show(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    write_snapshot(store, "t", spark.range(3))
    tx = store.begin()
    tx.overwrite("t", spark.range(10))
    assert read_snapshot(Store(spark, str(tmp_path)), "t").count() == 3
    tx.append("t", spark.range(5))
    tx.overwrite("u", spark.range(1))
    tx.commit("note")
    fresh = Store(spark, str(tmp_path))
    assert (fresh.read("t").count(), fresh.read("u").count()) == (15, 1)
    assert (fresh.version, fresh.note, fresh.names()) == (2, "note", ["t", "u"])


def test_second_writer_of_a_version_fails(spark, tmp_path):
    store, other = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    write_snapshot(store, "t", spark.range(3))
    first, second = store.begin(), other.begin()
    first.overwrite("t", spark.range(4))
    second.overwrite("t", spark.range(5))
    first.commit()
    with pytest.raises(CommitConflict):
        second.commit()
    store.begin()
    assert store.read("t").count() == 4


def test_feature_collection_keeps_geometry_text(spark, tmp_path):
    doc = {"type": "FeatureCollection", "name": "stations", "features": [
        {"type": "Feature", "properties": {"id": 1, "nm": "north"},
         "geometry": {"type": "Point", "coordinates": [1.5, 2]}},
        {"type": "Feature", "properties": {"id": 2, "nm": None}, "geometry": None},
    ]}
    path = tmp_path / "stations.geojson"
    path.write_text(json.dumps(doc, indent=2))
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("nm", T.StringType())])
    rows = read_feature_collection(spark, str(path), schema).orderBy("id").collect()
    assert [(r.id, r.nm) for r in rows] == [(1, "north"), (2, None)]
    assert json.loads(rows[0].geometry) == {"type": "Point", "coordinates": [1.5, 2]}
    assert rows[1].geometry is None


def test_csv_parts_are_in_order(spark, tmp_path):
    path = tmp_path / "dump"
    export_csv(spark.range(100).repartition(5), str(path), ["id"])
    lines = [line for part in sorted(path.glob("part-*")) for line in part.read_text().split()]
    assert lines == [str(i) for i in range(100)]


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "log", "event_id", (10, 90), 4)
    assert options["partitionColumn"] == "event_id" and options["numPartitions"] == "4"
    assert (options["lowerBound"], options["upperBound"]) == ("10", "90")
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "event_id")


def test_two_commits_at_once(spark, tmp_path):
    """Of writers that start from the same version one wins, the other gets a clear error."""
    from concurrent.futures import ThreadPoolExecutor

    for attempt in range(3):
        root = str(tmp_path / f"store{attempt}")
        stores = [Store(spark, root) for _ in range(2)]
        transactions = [s.begin() for s in stores]
        for i, tx in enumerate(transactions):
            tx.overwrite("t", spark.range(i + 1))

        def commit(tx):
            try:
                return tx.commit()
            except CommitConflict:
                return None

        with ThreadPoolExecutor(2) as pool:
            assert sorted(pool.map(commit, transactions), key=str) == [1, None]


def test_compaction_and_vacuum(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for i in range(5):
        tx = store.begin()
        tx.append("node/table/a.b", spark.range(i, i + 1))
        tx.commit()
    assert store.segments("node/table/a.b") == 5
    assert store.compact(most=5) == [] and store.compact(most=4) == ["node/table/a.b"]
    assert store.segments("node/table/a.b") == 1
    assert store.vacuum(keep=1) == 10  # five segments, five manifests
    assert sorted(r.id for r in Store(spark, store.root).read("node/table/a.b").collect()) == [0, 1, 2, 3, 4]


FEATURE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def written(path, collections, **options):
    path.write_text("".join(json.dumps(c, **options) + "\n" for c in collections))
    return str(path)


def collection(ids, **more):
    return {"type": "FeatureCollection", **more, "crs": {"type": "name", "properties": {"at": [{"a": 1}, {"b": 2}]}},
            "features": [{"type": "Feature", "properties": {"id": i, "name": f'"{{[{i}\\'},
                          "geometry": {"type": "Point", "coordinates": [i, 2]}} for i in ids]}


def test_features_of_one_large_file_are_read_by_many_tasks(spark, tmp_path):
    path = written(tmp_path / "large.geojson", [collection(range(2000)), collection([]), collection([5000, 5001])], indent=1)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7001b")  # blocks end inside features
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        rows = read_features(spark, path, FEATURE).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r.id, r.name, r.geometry) for r in rows) == [
        (i, f'"{{[{i}\\', f'{{"type":"Point","coordinates":[{i},2]}}') for i in [*range(2000), 5000, 5001]]


def test_features_one_a_line_and_their_closing_line(spark, tmp_path):
    lines = ['{ "type": "FeatureCollection",', '"features": [', '{"type": "Feature", "properties": {"id": 1}},',
             '', '{"type": "Feature", "properties": {"id": 2}, "geometry": null}, {"type": "Feature", "properties": {"id": 3}}]}']
    (tmp_path / "lines").write_text("\n".join(lines))
    rows = read_features(spark, str(tmp_path / "lines"), FEATURE).collect()
    assert sorted((r.id, r.name, r.geometry) for r in rows) == [(1, None, None), (2, None, None), (3, None, None)]
    (tmp_path / "empty").write_text("")
    assert read_features(spark, str(tmp_path / "empty"), FEATURE).collect() == []


@pytest.mark.parametrize("options", [{}, {"bad": True}])
def test_features_that_cannot_be_told_are_an_error(spark, tmp_path, options):
    path = tmp_path / "x"
    if options:
        path.write_text('{"features": [\n{"type": "Feature", "properties": {"id": }}\n]}')
    else:
        written(path, [collection([1, 2])])  # all in one line
    with pytest.raises(Exception, match="line of its own|MALFORMED"):
        read_features(spark, str(path), FEATURE).collect()
