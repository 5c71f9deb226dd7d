"""Logs and tables in a remote relational database, through Spark's JDBC source."""

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, partition_column=None, bounds=None, partitions=8,
                 fetch_size=10_000, **extra) -> dict:
    """Options of a parallel read.

    With ``bounds`` the range of ``partition_column`` is split over ``partitions`` connections;
    rows outside the bounds still belong to the first or last one.  Filters and column selection
    on the resulting DataFrame are pushed down to the database.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a parallel read needs the bounds of its partition column")
        low, high = bounds
        options.update(
            partitionColumn=partition_column, lowerBound=str(low), upperBound=str(high),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A remote table (or parenthesised sub-query with an alias)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def read_jdbc_log(spark: SparkSession, url: str, table: str, after_id: int, up_to_id: int,
                  partitions=8, **options) -> DataFrame:
    """The part of a remote log past a mark, read in parallel by ranges of event ids."""
    log = read_jdbc_table(
        spark, url, table, partition_column="event_id", bounds=(after_id, up_to_id),
        partitions=partitions, **options,
    )
    return log.filter(log["event_id"] > after_id)
