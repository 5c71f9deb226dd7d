"""File sources and sinks: feature collections, ordered tab-separated dumps, SQL scripts."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsync.operators.render import render_sql
from starsync.session import stage


_STRING = r'"(\\.|[^"\\])*"'


def _feature(properties):
    return T.StructType([
        T.StructField("properties", properties),
        T.StructField("geometry", T.StringType()),
    ])


def read_feature_collection(spark: SparkSession, path: str, properties: T.StructType,
                            multi_line=True) -> DataFrame:
    """Features of GeoJSON collections as rows: the properties plus ``geometry`` as JSON text.

    ``multi_line`` reads whole files, one collection each, in one task.  Inputs that hold one
    collection (or a piece of one) per line are split inside files with ``multi_line=False``; large
    files whose features begin on lines of their own are for ``read_features``.
    """
    schema = T.StructType([T.StructField("features", T.ArrayType(_feature(properties)))])
    return (
        spark.read.schema(schema).json(path, multiLine=multi_line)
        .select(F.explode("features").alias("f"))
        .select("f.properties.*", F.col("f.geometry").alias("geometry"))
    )


def read_features(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """The rows of ``read_feature_collection`` from large files, each read by many tasks.

    Each feature must begin on a line of its own, as GIS tools and indented JSON have it, and may go on
    over any number of lines.  A JSON string holds no line break, so a line's brackets can be counted
    alone; sums over the blocks of a file, a row each, give the depth at which a block begins.  A feature
    begins at depth two.  A file may hold several collections.  Features that begin behind other text,
    or that cannot be parsed, are an error; blank lines, empty files and empty collections give no rows.
    """
    bare = F.regexp_replace("value", _STRING, "")
    opened = F.length(F.regexp_replace(bare, r"[^{\[]", ""))
    closed = F.length(F.regexp_replace(bare, r"[^}\]]", ""))
    place = ["file", "block"]
    lines = stage(
        spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"), "value", (opened - closed).alias("delta")),
        "feature-lines")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*place).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)

    def earlier(rows, column):
        """What the earlier blocks of the file add up to, one row a block."""
        return rows.groupBy(*place).agg(F.sum(column).alias("of_block")).select(
            *place, F.coalesce(F.sum("of_block").over(before), F.lit(0)).alias("earlier"))

    begins = (F.col("depth") == 2) & F.col("value").rlike(r"^[\s,]*\{")
    placed = lines.join(earlier(lines, "delta"), place).withColumn(
        "ends", F.sum("delta").over(upto) + F.col("earlier")).withColumn(
        "depth", F.col("ends") - F.col("delta")).drop("earlier")
    hidden = (F.col("depth") < 2) & (
        F.col("value").rlike(r'"type"\s*:\s*"Feature"') | (F.col("ends") > 2) & F.col("value").contains('"features"'))
    # Lines outside of lists and objects part features from what other members of a collection hold.
    placed = stage(placed.withColumn("begins", begins).withColumn(
        "part", (begins | (F.col("depth") < 2)).cast("long")).withColumn("value", F.when(hidden, F.raise_error(
        F.concat(F.lit("a feature does not begin on a line of its own: "), F.substring("value", 1, 200))))
        .otherwise(F.col("value"))), "feature-depths")
    # The line that closes the list may hold the end of a feature, too.
    text = F.when(F.col("ends") < 2, F.regexp_replace("value", r"\][^\]]*$", "")).otherwise(F.col("value"))
    numbered = placed.join(earlier(placed, "part"), place).withColumn("nth", F.sum("part").over(upto) + F.col("earlier"))
    whole = numbered.filter(F.col("depth") >= 2).groupBy("file", "nth").agg(
        F.max("begins").alias("feature"),
        F.sort_array(F.collect_list(F.struct("block", "line", text.alias("text")))).alias("parts"),
    ).filter("feature")
    body = F.regexp_replace(F.array_join("parts.text", "\n"), r"^[\s,]+|[\s,]+$", "")
    found = F.from_json(F.concat(F.lit("["), body, F.lit("]")), T.ArrayType(_feature(properties)), {"mode": "FAILFAST"})
    return (
        whole.select(F.explode(found).alias("f"))
        .select("f.properties.*", F.col("f.geometry").alias("geometry"))
    )


def export_csv(df: DataFrame, path: str, order_by, mode="errorifexists") -> None:
    """A tab-separated dump in a fixed order: parts sorted by range, to be read one after another."""
    df.orderBy(*order_by).write.csv(path, sep="\t", header=False, mode=mode)


def export_sql(changes: DataFrame, relations: DataFrame, path: str, uid_column="uid",
               excluded=(), mode="errorifexists") -> None:
    """The statements of field-grain changes as text, in replay order; empty ones are left out."""
    (
        render_sql(changes, relations, uid_column, excluded)
        .filter(F.col("statement") != "")
        .orderBy("event_id", "field")
        .select(F.concat("statement", F.lit(";")).alias("value"))
        .write.mode(mode).text(path)
    )
