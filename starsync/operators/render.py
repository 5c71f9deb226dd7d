"""Changes as statement text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync.functions.render import statement
from starsync.operators.registry import keys_of


def render_sql(changes: DataFrame, relations: DataFrame, uid_column="uid", excluded=()):
    """Field-grain changes with their ``statement`` text: a projection, no look-ups per row."""
    return (
        changes.withColumn("keys", keys_of(relations, F.col("ident")))
        .withColumn("statement", statement(uid_column, excluded))
        .drop("keys")
    )
