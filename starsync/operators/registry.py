"""Table inventory, key registry, uid columns and per-server table lists."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemas never offered for capture.
OWN_SCHEMA = "starsync"
EXCLUDED_SCHEMAS = ("public", OWN_SCHEMA)


def insert_if_absent(target: DataFrame, rows: DataFrame, keys) -> DataFrame:
    """``target`` plus those ``rows`` whose keys it does not hold yet.

    Several new rows with the same keys count once, the smallest by its other columns, so that a
    repeated run gives the same table.  Works for any number of key columns.
    """
    keys = list(keys)
    others = [c for c in target.columns if c not in keys]
    if others:
        fresh = (
            rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in others])
        )
    else:
        fresh = rows.select(*keys).distinct()
    fresh = fresh.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def _scope(inventory, schemas, only):
    if schemas is not None:
        wanted = [s for s in schemas if s not in EXCLUDED_SCHEMAS]
        return inventory.filter(F.col("schema_name").isin(wanted))
    if only is not None:
        return inventory.filter(
            F.concat_ws(".", "schema_name", "table_name").isin(list(only))
        )
    return inventory.filter(~F.col("schema_name").isin(*EXCLUDED_SCHEMAS))


def _with_name(inventory):
    return inventory.withColumn(
        "relation_name", F.concat_ws(".", "schema_name", "table_name")
    )


def missing_capture(inventory: DataFrame, relations: DataFrame, schemas=None, only=None):
    """Tables of the inventory that no key registration covers."""
    return _with_name(_scope(inventory, schemas, only)).join(
        relations.select("relation_name"), "relation_name", "left_anti"
    )


def captured_tables(inventory: DataFrame, relations: DataFrame, schemas=None, only=None):
    """Tables of the inventory that are captured: the complement of ``missing_capture``."""
    return _with_name(_scope(inventory, schemas, only)).join(
        relations.select("relation_name"), "relation_name", "left_semi"
    )


def relation_keys(relations: DataFrame) -> DataFrame:
    """Key columns of each registered table as a sorted array (a handful per table)."""
    return relations.groupBy(F.col("relation_name").alias("ident")).agg(
        F.array_sort(F.collect_set("uid_column")).alias("keys")
    )


def keys_of(relations: DataFrame, ident: Column) -> Column:
    """Key columns of a table, NULL when it is not registered.

    The registry is catalogue metadata (a few names per table) and travels as one scalar value:
    a join on the table name would shuffle the log onto as many tasks as there are tables.
    """
    registry = relation_keys(relations).agg(
        F.map_from_entries(F.collect_list(F.struct("ident", "keys"))).alias("m")
    ).scalar()
    return F.element_at(registry, ident)


def add_uid(df: DataFrame, business_key=None, uid="uid"):
    """``(df with a uid column, True)``, or ``(df, False)`` when it has one already.

    With a business key the uid is derived from it, so that a retried task gives the same uid;
    without one it is random and the caller should store the result before using it twice.
    """
    if uid in df.columns:
        return df, False
    if business_key:
        digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in business_key]))
        value = F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    else:
        value = F.expr("uuid()")
    return df.withColumn(uid, value), True


def missing_uid(columns: DataFrame, schemas=None, only=None, uid="uid"):
    """Tables of a column inventory (schema, table, column) without a uid column.

    One aggregation: a wide table costs one partial row per task, not a self join.
    """
    return (
        _scope(columns, schemas, only)
        .groupBy("schema_name", "table_name")
        .agg(F.max((F.col("column_name") == uid).cast("int")).alias("_has"))
        .filter(F.col("_has") == 0)
        .drop("_has")
    )


def check_uid_unique(df: DataFrame, uid="uid"):
    """Uids that occur more than once, and NULL if any row has none, with their row counts."""
    return (
        df.groupBy(uid).agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col(uid).isNull() | (F.col("n_rows") > 1))
    )


def merge_whitelist(current: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert of server → tables: the new list first, then the old one, repeats kept."""
    empty = F.array().cast("array<string>")
    merged = F.concat(F.coalesce(F.col("_new"), empty), F.coalesce(F.col("_old"), empty))
    return (
        current.select("server_id", F.col("tables").alias("_old"))
        .join(new.select("server_id", F.col("tables").alias("_new")), "server_id", "full_outer")
        .select("server_id", merged.alias("tables"))
    )


def tables_by_schema(sync_tables: DataFrame) -> DataFrame:
    """Distinct synchronised tables of each schema, names quoted and joined by commas."""
    name = F.split("quoted", r"\.")
    return (
        sync_tables.select(F.explode("tables").alias("quoted"))
        .distinct()
        .select(
            F.trim(F.replace(name[0], F.lit('"'), F.lit(""))).alias("schema_name"),
            name[1].alias("table_name"),
        )
        .groupBy("schema_name")
        .agg(F.array_join(F.array_sort(F.collect_list("table_name")), ",").alias("tables"))
    )
