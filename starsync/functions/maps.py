"""Exact text-map semantics: rows as ``map<string,string>`` where a value may be NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_map(columns, source=None) -> Column:
    """The row as a text map, every column present, NULL kept as a NULL value."""
    pick = (lambda c: source[c]) if source is not None else F.col
    return F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]),
        F.array(*[pick(c).cast("string") for c in columns]),
    )


def drop_keys(m: Column, keys) -> Column:
    """The map without ``keys`` (a Python list or an array column); unknown keys are harmless."""
    if isinstance(keys, Column):
        return F.map_filter(m, lambda k, _: ~F.array_contains(keys, k))
    keys = list(keys)
    return F.map_filter(m, lambda k, _: ~k.isin(keys)) if keys else m


def minus(a: Column, b: Column) -> Column:
    """Pairs of ``a`` that ``b`` does not hold with the same value; NULL equals NULL."""
    return F.map_filter(
        a, lambda k, v: ~(F.map_contains_key(b, k) & v.eqNullSafe(F.element_at(b, k)))
    )


def differs(a: Column, b: Column) -> Column:
    """True when the maps are not the same set of pairs (maps have no ``=`` in Spark)."""
    return ~F.array_sort(F.map_entries(a)).eqNullSafe(F.array_sort(F.map_entries(b)))


def contains(m: Column, part: Column) -> Column:
    """True when every pair of ``part`` is in ``m``."""
    return F.forall(
        F.map_keys(part),
        lambda k: F.map_contains_key(m, k) & F.element_at(m, k).eqNullSafe(F.element_at(part, k)),
    )


def ordered_entries(m: Column) -> Column:
    """Entries as an array in a fixed order: shorter names first, then by name."""
    return F.array_sort(
        F.transform(
            F.map_entries(m),
            lambda e: F.struct(
                F.length(e["key"]).alias("size"), e["key"].alias("key"), e["value"].alias("value")
            ),
        )
    )


def changed_pairs(pairs) -> Column:
    """A text map of the ``(name, differs, value)`` triples whose condition holds.

    Plain conditional expressions on typed columns: unequal values are found before anything
    is turned into text.
    """
    entries = F.array(*[
        F.when(cond, F.struct(F.lit(name).alias("key"), value.cast("string").alias("value")))
        for name, cond, value in pairs
    ])
    return F.map_from_entries(F.array_compact(entries))
