"""Statement text of a field-grain change, for ledgers and exports (replay never parses it)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from starsync.functions import maps
from starsync.functions.exprs import DELETE, INSERT, UPDATE

# Statement formats.
INSERT_FORM = 'INSERT INTO %s (%s) VALUES ( %s)'
UPDATE_FORM = 'UPDATE %s SET %s = %s WHERE "%s" = %s'
DELETE_FORM = 'DELETE FROM %s WHERE "%s" = %s'


def quote_literal(value: Column) -> Column:
    """``'text'`` with quotes doubled, or the bare word NULL."""
    quoted = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.coalesce(quoted, F.lit("NULL"))


def quote_name(name: Column) -> Column:
    return F.concat(F.lit('"'), name, F.lit('"'))


def _update(table, keys, hidden, uid, uid_column, field, value):
    """An update of one column; NULL when the column is hidden or the row has no uid."""
    # format_string prints the word null for a NULL argument, so each form is guarded.
    return F.when(
        keys.isNotNull() & uid.isNotNull() & ~F.array_contains(hidden, field),
        F.format_string(
            UPDATE_FORM, table, quote_name(field), quote_literal(value), F.lit(uid_column),
            quote_literal(uid),
        ),
    )


def _table():
    ident = F.col("ident")
    rest = F.substring(ident, F.instr(ident, ".") + 1, F.length(ident))
    return F.concat(quote_name(F.substring_index(ident, ".", 1)), F.lit("."), quote_name(rest))


def update_statement(value: Column, uid_column="uid") -> Column:
    """Text of the update of one cell to ``value`` (for conflicts, which are always updates).

    Needs ``ident, uid, field`` and ``keys``, the local key columns of the table.
    """
    keys = F.col("keys")
    text = _update(_table(), keys, keys, F.col("uid"), uid_column, F.col("field"), value)
    return F.coalesce(text, F.lit(""))


def statement(uid_column="uid", excluded=()) -> Column:
    """SQL text of one field-grain change, which also has the ``keys`` of its table.

    A table without registered keys, an update of a key or excluded column, an event without uid
    and a truncate give the empty string.
    """
    keys, uid = F.col("keys"), F.col("uid")
    hidden = F.concat(keys, F.array(*[F.lit(c) for c in excluded]).cast("array<string>"))
    entries = maps.ordered_entries(maps.drop_keys(F.col("row_data"), hidden))
    names = F.array_join(F.transform(entries, lambda e: quote_name(e["key"])), ",")
    values = F.array_join(F.transform(entries, lambda e: quote_literal(e["value"])), ",")
    insert = F.when(
        F.size(entries) > 0, F.format_string(INSERT_FORM, _table(), names, values)
    )
    update = _update(_table(), keys, hidden, uid, uid_column, F.col("field"), F.col("value"))
    delete = F.when(
        uid.isNotNull(),
        F.format_string(DELETE_FORM, _table(), F.lit(uid_column), quote_literal(uid)),
    )
    text = (
        F.when((F.col("action") == INSERT) & keys.isNotNull(), insert)
        .when(F.col("action") == UPDATE, update)
        .when(F.col("action") == DELETE, delete)
    )
    return F.coalesce(text, F.lit(""))
