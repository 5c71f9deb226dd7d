"""Scalar expressions of the change log."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Event actions, side labels and conflict rule names of the log format.
INSERT, UPDATE, DELETE, TRUNCATE = "I", "U", "D", "T"
CENTRAL, CLONE = "central", "clone"
LAST_MODIFIED = "last_modified"


def ident(schema_name="schema_name", table_name="table_name") -> Column:
    """``schema.table``, the name under which a table is known in the log."""
    return F.concat(F.col(schema_name), F.lit("."), F.col(table_name))


def quoted_ident(schema_name="schema_name", table_name="table_name") -> Column:
    """``"schema"."table"``, the form used in the lists of synchronised tables."""
    return F.concat(
        F.lit('"'), F.col(schema_name), F.lit('"."'), F.col(table_name), F.lit('"')
    )


def effective_time(tstamp="tstamp_tx", sync="sync") -> Column:
    """Epoch micros of the edit: the original time when a clone made it, else the event time."""
    original = F.col(f"{sync}.orig_tstamp")
    from_clone = original.isNotNull() & F.col(f"{sync}.origin").isNotNull()
    return F.unix_micros(F.when(from_clone, original).otherwise(F.col(tstamp)))


def origin_label(sync="sync") -> Column:
    """``central`` for edits made at the centre, ``clone`` for replayed ones."""
    return F.when(F.col(f"{sync}.origin").isNull(), CENTRAL).otherwise(CLONE)


def typed(value: Column, data_type: T.DataType) -> Column:
    """Text to ``data_type``; NULL where the text does not fit."""
    if isinstance(data_type, T.StringType):
        return value
    return value.try_cast(data_type)


def misfit(value: Column, data_type: T.DataType) -> Column:
    """True for text that is not NULL but does not fit ``data_type``."""
    if isinstance(data_type, T.StringType):
        return F.lit(False)
    return value.isNotNull() & typed(value, data_type).isNull()


def cast_row(m: Column, schema: T.StructType) -> Column:
    """A text map as a typed struct; absent keys and texts that do not fit become NULL."""
    return F.struct(*[
        typed(F.element_at(m, f.name), f.dataType).alias(f.name) for f in schema.fields
    ])


def cast_errors(m: Column, schema: T.StructType) -> Column:
    """Names of the columns whose text does not fit, in schema order (an empty array if none)."""
    return F.array_compact(F.array(*[
        F.when(misfit(F.element_at(m, f.name), f.dataType), F.lit(f.name)) for f in schema.fields
    ]))
