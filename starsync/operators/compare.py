"""Convergence checks: do two copies of a table hold the same rows?"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsync.functions import maps

# Status texts (table 1 is the clone, table 2 the centre).
ONLY_RIGHT = "not in table 1"
ONLY_LEFT = "not in table 2"
DIFFERENT = "table 1 != table 2"
# Of tables that cannot be compared row by row.
NO_LEFT = "table 1 is missing"
NO_RIGHT = "table 2 is missing"
NO_KEYS = "not registered"

#: Buckets of uids whose rows are digested together.
BUCKETS = 1024
#: Bucket of rows without a uid, which equal nothing.
NO_UID = -1


def _with_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    absent = [f for f in other.schema.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])


def compare_tables(left: DataFrame, right: DataFrame, key_cols, uid="uid") -> DataFrame:
    """Rows that are missing on one side or differ outside the local key columns.

    Columns of either side are compared; one that a side lacks is NULL there.
    One full outer join on the unique uid; columns are compared typed and NULL-safe, and only
    rows that differ get their maps of differing values.
    """
    key_cols = list(key_cols or ())
    if not key_cols:
        raise ValueError("a table needs registered key columns to be compared")
    left, right = _with_columns_of(left, right), _with_columns_of(right, left)
    names = [c for c in left.columns if c not in key_cols]
    a = left.select(F.col(uid).alias("_uid"), F.struct(*names).alias("a"))
    b = right.select(F.col(uid).alias("_uid"), F.struct(*names).alias("b"))
    cells = {c: ~F.col("a")[c].eqNullSafe(F.col("b")[c]) for c in names}
    different = reduce(lambda x, y: x | y, cells.values())
    status = (
        F.when(F.col("a").isNull(), ONLY_RIGHT).when(F.col("b").isNull(), ONLY_LEFT)
        .when(different, DIFFERENT)
    )
    return (
        a.join(b, "_uid", "full_outer")
        .withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .select(
            F.col("_uid").alias("uid"),
            "status",
            maps.changed_pairs([(c, d, F.col("a")[c]) for c, d in cells.items()])
            .alias("left_values"),
            maps.changed_pairs([(c, d, F.col("b")[c]) for c, d in cells.items()])
            .alias("right_values"),
        )
    )


def _bucket(uid, buckets):
    return F.when(F.col(uid).isNull(), NO_UID).otherwise(F.pmod(F.xxhash64(uid), F.lit(buckets)))


def _hashable(field: T.StructField):
    """A column for a hash; the hash would pass over nulls inside nested values."""
    if isinstance(field.dataType, (T.ArrayType, T.StructType)):
        return F.to_json(F.struct(field.name), {"ignoreNullFields": "false"})
    return F.col(field.name)


def _digests(df: DataFrame, names, uid, label, side, buckets) -> DataFrame:
    """(label, side, bucket, n, a, b): number and sums of two hashes of the rows of each uid bucket,
    whatever their order.  Nulls are hashed by place, as the hash itself passes over them."""
    row = [uid, *[_hashable(df.schema[c]) for c in names], *[F.col(c).isNull() for c in names]]
    total = lambda h: F.sum(h.cast("decimal(38,0)"))
    return df.groupBy(_bucket(uid, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), total(F.xxhash64(*row)).alias("a"),
        total(F.xxhash64(F.lit(1), *row)).alias("b"),
    ).select(F.lit(label).alias("label"), F.lit(side).alias("side"), "bucket", "n", "a", "b")


def differing_buckets(pairs, uid="uid", buckets=BUCKETS) -> dict:
    """The uid buckets in which the two tables of each pair differ, by label.

    One aggregation over all tables with partial sums per task: what is shuffled is one short row
    for each task, table and bucket.  At most ``buckets`` numbers a pair come to the driver.
    """
    parts = []
    for label, (left, right, keys) in pairs.items():
        left, right = _with_columns_of(left, right), _with_columns_of(right, left)
        names = [c for c in left.columns if c not in (*keys, uid)]
        parts += [_digests(df, names, uid, label, side, buckets) for side, df in enumerate((left, right))]
    if not parts:
        return {}
    same = reduce(DataFrame.unionByName, parts).groupBy("label", "bucket").agg(
        F.count(F.lit(1)).alias("sides"), *[
            (F.min(c) == F.max(c)).alias(c) for c in ("n", "a", "b")])
    equal = (F.col("sides") == 2) & F.col("n") & F.col("a") & F.col("b") & (F.col("bucket") != NO_UID)
    rows = same.filter(~equal).select(
        "label", "bucket").collect()
    found = {label: [] for label in pairs}
    for r in rows:
        found[r["label"]].append(r["bucket"])
    return found


def compare_all(pairs, uid="uid", buckets=BUCKETS) -> DataFrame:
    """Differences per table and status over many tables; no row means all copies agree.

    ``pairs`` maps a label to ``(left, right, key_cols)``.  A table that one side lacks (None) or
    that has no registered keys is reported with the rows of the side that is there.  Both sides are
    digested by uid bucket first, and only the rows of differing buckets are joined: tables that
    agree are scanned, but their rows are not shuffled.
    """
    whole = {k: p for k, p in pairs.items() if p[0] is not None and p[1] is not None and p[2]}
    differing = differing_buckets(whole, uid, buckets)

    def part(label, left, right, keys):
        if label not in whole:
            status = NO_LEFT if left is None else NO_RIGHT if right is None else NO_KEYS
            rows = (right if left is None else left).agg(F.count(F.lit(1)).alias("n_rows"))
            return rows.withColumn("status", F.lit(status))
        mine = _bucket(uid, buckets).isin(differing[label])
        return compare_tables(left.filter(mine), right.filter(mine), keys, uid).groupBy("status").agg(
            F.count(F.lit(1)).alias("n_rows"))

    parts = [
        part(label, *pair).select(F.lit(label).alias("label"), "status", "n_rows")
        for label, pair in pairs.items() if label not in whole or differing[label]
    ]
    if not parts:
        spark = next(df for pair in pairs.values() for df in pair[:2] if df is not None).sparkSession
        return spark.createDataFrame([], "label string, status string, n_rows long")
    return reduce(DataFrame.unionByName, parts)
