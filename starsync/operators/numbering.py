"""Gap-free global numbering in a given order, without sending all rows through one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsync.session import stage


def number_rows(df: DataFrame, order_by, column, start=0) -> DataFrame:
    """Add ``column`` = start+1, start+2, ... following ``order_by`` (column names, unique together).

    Rows are range-partitioned on the whole order key, so a burst of rows sharing the leading key
    is still split; each task numbers its own range, and only one count per task is summed up to
    give the offsets.  The ranges are staged first: sampling may choose other bounds when a plan
    is run again, so positions must be written before they are counted.
    """
    spark = df.sparkSession
    local_bits = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(parts, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", local_bits))
        .withColumn("_pos", F.col("_id").bitwiseAND(F.lit((1 << local_bits) - 1)))
        .drop("_id")
    )
    staged = stage(ranged, "numbered")
    # One count per task, whatever the size of the data; the running totals travel to the tasks
    # as one array indexed by range, so the rows are not shuffled again.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = (
        spark.range(parts).select(F.col("id").alias("_part"))
        .join(counts, "_part", "left")
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
        .agg(F.array_sort(F.collect_list(F.struct("_part", "_offset"))).alias("a"))
        .select(F.transform("a", lambda e: e["_offset"]).alias("a"))
        .scalar()
    )
    first = start if isinstance(start, Column) else F.lit(start)
    number = F.element_at(offsets, (F.col("_part") + 1).cast("int")) + F.col("_pos") + 1 + first
    return staged.withColumn(column, number.cast("long")).drop("_part", "_pos")


def largest(df: DataFrame, column) -> Column:
    """The largest value of ``column`` as a scalar sub-query (NULL when ``df`` is empty)."""
    return df.agg(F.max(column).alias("m")).scalar()
