from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsync.functions import exprs, maps
from starsync.operators.render import render_sql
from starsync.schemas import RELATIONS

MAPS = T.StructType([
    T.StructField("a", T.MapType(T.StringType(), T.StringType())),
    T.StructField("b", T.MapType(T.StringType(), T.StringType())),
])


def pair(spark, a, b):
    return spark.createDataFrame([(a, b)], MAPS)


def one(df, column):
    return df.select(column.alias("x")).first().x


def test_minus_keeps_new_null_keys(spark):
    df = pair(spark, {"k": "1", "n": None, "new": None, "c": "x"}, {"k": "1", "n": None, "c": "y"})
    assert one(df, maps.minus(F.col("a"), F.col("b"))) == {"new": None, "c": "x"}


def test_drop_keys_ignores_unknown(spark):
    df = pair(spark, {"k": "1", "m": None}, {})
    assert one(df, maps.drop_keys(F.col("a"), ["k", "nope"])) == {"m": None}
    assert one(df, maps.drop_keys(F.col("a"), [])) == {"k": "1", "m": None}


def test_differs_and_contains(spark):
    same = pair(spark, {"x": None, "y": "1"}, {"y": "1", "x": None})
    assert one(same, maps.differs(F.col("a"), F.col("b"))) is False
    assert one(same, maps.contains(F.col("a"), F.col("b"))) is True
    less = pair(spark, {"x": None, "y": "1"}, {"y": "1"})
    assert one(less, maps.differs(F.col("a"), F.col("b"))) is True
    assert one(less, maps.contains(F.col("a"), F.col("b"))) is True
    assert one(less, maps.contains(F.col("b"), F.col("a"))) is False


def test_ordered_entries_short_names_first(spark):
    df = pair(spark, {"bb": "1", "a": "2", "ccc": None, "b": "3"}, {})
    entries = one(df, maps.ordered_entries(F.col("a")))
    assert [e.key for e in entries] == ["a", "b", "bb", "ccc"]


def test_effective_time_needs_origin_and_time(spark):
    t0, t1 = datetime(2024, 1, 2), datetime(2024, 1, 1)
    schema = T.StructType([
        T.StructField("tstamp_tx", T.TimestampType()),
        T.StructField("sync", T.StructType([
            T.StructField("origin", T.StringType()),
            T.StructField("orig_tstamp", T.TimestampType()),
        ])),
    ])
    rows = [(t0, ("a", t1)), (t0, (None, t1)), (t0, ("a", None)), (t0, None)]
    got = spark.createDataFrame(rows, schema).select(
        F.timestamp_micros(exprs.effective_time()).alias("t"), exprs.origin_label().alias("o")
    ).collect()
    assert [r.t for r in got] == [t1, t0, t0, t0]
    assert [r.o for r in got] == ["clone", "central", "clone", "central"]


def test_statements(spark):
    schema = ("event_id long, ident string, action string, field string, value string,"
              " uid string, row_data map<string,string>")
    rows = [
        (1, "s.t", "I", None, None, "u1", {"id": "4", "uid": "u1", "nm": "it's", "z": None}),
        (2, "s.t", "U", "nm", None, "u1", None),
        (3, "s.t", "U", "id", "9", "u1", None),
        (4, "s.t", "D", None, None, "u1", None),
        (5, "s.t", "T", None, None, None, None),
        (6, "s.loose", "I", None, None, "u1", {"nm": "x"}),
        (7, "s.loose", "D", None, None, "u1", None),
        (8, "s.t", "I", None, None, "u1", {"id": "4"}),
    ]
    relations = spark.createDataFrame([("s.t", "id")], RELATIONS)
    rendered = render_sql(spark.createDataFrame(rows, schema), relations)
    got = {r.event_id: r.statement for r in rendered.collect()}
    assert got == {
        1: """INSERT INTO "s"."t" ("z","nm","uid") VALUES ( NULL,'it''s','u1')""",
        2: """UPDATE "s"."t" SET "nm" = NULL WHERE "uid" = 'u1'""",
        3: "",
        4: """DELETE FROM "s"."t" WHERE "uid" = 'u1'""",
        5: "",
        6: "",
        7: """DELETE FROM "s"."loose" WHERE "uid" = 'u1'""",
        8: "",
    }
