"""Full snapshots that seed a clone: check, package, guard, deploy."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsync import schemas
from starsync.operators import history as H
from starsync.operators import registry
from starsync.plans.sync import count_events, history_rows, make_sync_id, table_name
from starsync.sources.store import Store

STRUCTURE_VERSION = "1"

MANIFEST = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("central", T.StringType()),
    T.StructField("sync_id", T.StringType()),
    T.StructField("packaged_at", T.TimestampType()),
    T.StructField("min_event_id", T.LongType()),
    T.StructField("max_event_id", T.LongType()),
    T.StructField("max_tstamp_tx", T.TimestampType()),
    T.StructField("tables", T.ArrayType(T.StringType())),
])


# Marks are compared to the microsecond; the default JSON format would cut them to milliseconds.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


class PackageError(Exception):
    """The package cannot be made or must not be deployed."""


@dataclass
class Package:
    path: str
    manifest: dict

    def table(self, spark: SparkSession, ident: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/table/{ident}")


def preflight(inventory: DataFrame, columns: DataFrame, relations: DataFrame, only=None,
              uid="uid") -> DataFrame:
    """What is missing before tables can be packaged; no row means they are ready.

    ``inventory`` lists tables (schema, table), ``columns`` their columns; checks that every table
    is captured and has a uid column.
    """
    names = ["schema_name", "table_name"]
    return (
        registry.missing_capture(inventory, relations, only=only).select(
            F.lit("not captured").alias("problem"), *names
        ).unionByName(
            registry.missing_uid(columns, only=only, uid=uid).select(
                F.lit("no uid column").alias("problem"), *names
            )
        )
    )


def marks(log: DataFrame, now) -> DataFrame:
    """Where a clone seeded by a package starts: the bounds of the log at packaging time."""
    return log.agg(
        F.coalesce(F.min("event_id"), F.lit(-1)).alias("min_event_id"),
        F.coalesce(F.max("event_id"), F.lit(0)).alias("max_event_id"),
        F.coalesce(F.max("tstamp_tx"), F.lit(now).cast("timestamp")).alias("max_tstamp_tx"),
    )


def deploy_guard(history: DataFrame, central: str, packaged_at) -> DataFrame:
    """Per clone: has it had a newer sync from the centre than the package?

    One aggregation over the history for all clones; clones it has never served do not appear and
    may be deployed to.
    """
    served = history.filter(F.col("server_from") == central).select(
        F.explode("server_to").alias("clone_id"), "sync_id", "sync_time"
    )
    newer = F.col("sync_time") > F.lit(packaged_at).cast("timestamp")
    return served.groupBy("clone_id").agg(
        F.count_if(newer).alias("newer_syncs"), (F.count_if(newer) == 0).alias("allowed")
    )


def _inventory(store, idents, central):
    spark = store.spark
    tables = [tuple(i.split(".", 1)) for i in idents]
    columns = [
        (*i.split(".", 1), c) for i in idents for c in store.read(table_name(central, i)).columns
    ]
    return (
        spark.createDataFrame(tables, "schema_name string, table_name string"),
        spark.createDataFrame(
            columns, "schema_name string, table_name string, column_name string"
        ),
    )


def package(store: Store, path: str, idents, central: str, now: datetime, uid="uid") -> Package:
    """Write a full snapshot of the chosen tables and open a history round for it."""
    spark = store.spark
    # What is checked and what is packed, the marks and the tables, are of one committed version.
    tx = store.begin()
    idents = list(idents)
    absent = [i for i in idents if table_name(central, i) not in store]
    if absent:
        raise PackageError(f"no such tables: {absent}")
    inventory, columns = _inventory(store, idents, central)
    relations = store.read(f"{central}/relations", schemas.RELATIONS)
    problems = preflight(inventory, columns, relations, only=idents, uid=uid).collect()
    problems = [f"{r.schema_name}.{r.table_name}: {r.problem}" for r in problems]
    for ident in idents:
        table = store.read(table_name(central, ident))
        if uid in table.columns and not registry.check_uid_unique(table, uid).isEmpty():
            problems.append(f"{ident}: uid is not unique")
    if problems:
        raise PackageError("; ".join(problems))

    bounds = marks(store.read(f"{central}/log", schemas.CHANGE_LOG), now).first().asDict()
    for ident in idents:
        store.read(table_name(central, ident)).write.parquet(f"{path}/table/{ident}")
    manifest = {
        "version": STRUCTURE_VERSION, "central": central,
        "sync_id": make_sync_id("package", path, store.version), "packaged_at": now,
        "tables": idents, **bounds,
    }
    spark.createDataFrame(
        [tuple(manifest[f] for f in MANIFEST.names)], MANIFEST
    ).coalesce(1).write.json(f"{path}/manifest", timestampFormat=TIME_FORMAT)
    tx.append(f"{central}/history", history_rows(spark, {
        "sync_id": manifest["sync_id"], "seq": 1, "sync_time": now, "server_from": central,
        "sync_type": H.FULL, "sync_status": H.PENDING, **bounds,
    }))
    tx.commit()
    return Package(path, manifest)


def open_package(spark: SparkSession, path: str) -> Package:
    row = spark.read.schema(MANIFEST).json(
        f"{path}/manifest", timestampFormat=TIME_FORMAT
    ).first()
    if row is None:
        raise PackageError(f"no package at {path}")
    return Package(path, row.asDict())


def deploy(store: Store, path: str, clone: str, now: datetime, post_deploy=None, uid="uid") -> None:
    """Seed a clone from a package: replace its tables, allow them, close the history round.

    ``post_deploy`` maps table names to functions that may edit a table before it is stored.
    """
    spark = store.spark
    pack = open_package(spark, path)
    m = pack.manifest
    if m["version"] != STRUCTURE_VERSION:
        raise PackageError(f"package version {m['version']}, expected {STRUCTURE_VERSION}")
    central = m["central"]
    tx = store.begin()
    records = store.read(f"{central}/history", schemas.HISTORY_RECORDS)
    guard = deploy_guard(H.fold_history(records), central, m["packaged_at"])
    if not guard.filter((F.col("clone_id") == clone) & ~F.col("allowed")).isEmpty():
        raise PackageError(f"{clone} has a newer sync than this package")
    for ident in m["tables"]:
        table = pack.table(spark, ident)
        edit = (post_deploy or {}).get(ident)
        after = edit(table) if edit else table
        tx.overwrite(table_name(clone, ident), after, key=uid if uid in after.columns else None, rows=table.count())
    quoted = ['"{}"."{}"'.format(*i.split(".", 1)) for i in m["tables"]]
    tx.overwrite(f"{central}/sync_tables", registry.merge_whitelist(
        store.read(f"{central}/sync_tables", schemas.SYNC_TABLES),
        spark.createDataFrame([(clone, quoted)], schemas.SYNC_TABLES),
    ))
    # Record numbers grow with every deployment, so servers are appended in that order.
    last = records.filter(F.col("sync_id") == m["sync_id"]).agg(F.max("seq")).first()[0] or 0
    tx.append(f"{central}/history", history_rows(spark, {
        "sync_id": m["sync_id"], "seq": last + 1, "server_to": clone, "sync_status": H.DONE,
    }))
    # The log is emptied, its ids go on.
    count_events(tx, clone, store.read(f"{clone}/log", schemas.CHANGE_LOG))
    tx.overwrite(f"{clone}/log", spark.createDataFrame([], schemas.CHANGE_LOG))
    tx.commit()
