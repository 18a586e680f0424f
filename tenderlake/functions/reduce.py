"""Column functions for "several values -> one value" and for walking nested arrays.

Rules (document order is array order):

* ``concat_values`` (rule C): join every occurrence with ``_``. No separator is written
  while the value so far is empty, so leading empty occurrences vanish while later
  empty ones keep their ``_``. No occurrence -> null; only empty occurrences -> ``''``.
* ``last_present`` (rule L): the last non-null value (used for attributes and links).
* ``first_non_empty`` (rule F): the first non-empty value, ``''`` when only empty ones
  exist, null when none exists.

The reductions are written with ``array_join`` and regular expressions rather than
lambda functions: those are code-generated, while higher-order functions are interpreted.
They join with U+0001 and mark nulls with U+0002 - characters XML 1.0 text can never
contain - so no value can be confused with a separator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "_"
SEP = "\u0001"      # joins occurrences; not allowed in XML 1.0 documents
NUL = "\u0002"      # marks a missing value; not allowed in XML 1.0 documents


def field(st: Column, name: str) -> Column:
    """Array field of a struct, empty when the struct or the field is missing."""
    return F.coalesce(st[name], F.array())


def child(arr: Column, name: str) -> Column:
    """Array field ``name`` of every element of an array of structs, concatenated in order.

    Elements where the field is missing contribute nothing. ``flatten`` alone (code-generated)
    gives null as soon as one element lacks the field; only then is the lambda path taken.
    """
    picked = arr[name]
    return F.coalesce(F.flatten(picked), F.flatten(F.filter(picked, lambda a: a.isNotNull())))


def chained(*arrays: Column) -> Column:
    """Arrays one after the other, null if one is null. In a lambda function, ``concat`` of arrays walks a lazy list for every
    element that it is called for and takes several times as long."""
    return F.flatten(F.array(*arrays))


def walk(arr: Column, *path: str) -> Column:
    """Follow nested array fields, e.g. ``walk(parties, 'PartyName', 'Name')``."""
    out = arr
    for name in path:
        out = child(out, name)
    return out


def values(arr: Column) -> Column:
    """Text of every occurrence of an element read as ``STRUCT<_VALUE, ...>``.

    An occurrence without text has a null ``_VALUE``; the reductions read it as ``''``.
    """
    return arr["_VALUE"]


def attribute(arr: Column, name: str) -> Column:
    """Attribute ``name`` (without prefix) of every occurrence, null where it is missing."""
    return arr["_" + name]


def concat_values(v: Column) -> Column:
    """Rule C on an array of strings (null elements count as empty occurrences)."""
    joined = F.array_join(v, SEP, "")
    stripped = F.regexp_replace(joined, "^" + SEP + "+", "")
    n = F.size(v)
    # One occurrence (the usual case) needs no joining.
    return (F.when(n == 1, F.coalesce(F.try_element_at(v, F.lit(1)), F.lit("")))
             .when(n > 1, F.replace(stripped, F.lit(SEP), F.lit(SEPARATOR))))


def first_non_empty(v: Column) -> Column:
    """Rule F: first non-empty element; ``''`` if only empties exist; null if none."""
    first = F.try_element_at(v, F.lit(1))
    joined = F.concat(F.lit(SEP), F.array_join(v, SEP, ""))
    return (F.when(F.coalesce(first, F.lit("")) != F.lit(""), first)
             .when(F.size(v) > 0, F.regexp_extract(joined, SEP + "([^" + SEP + "]+)", 1)))


def last_present(v: Column) -> Column:
    """Rule L: the last non-null element, or null."""
    joined = F.array_join(v, SEP, NUL)
    only_nulls = joined.rlike("^" + NUL + "(" + SEP + NUL + ")*$")
    last = F.regexp_extract(joined, "(?:^|" + SEP + ")([^" + SEP + NUL + "]*)(?:" + SEP + NUL + ")*$", 1)
    # When the last element is present it is the answer; only otherwise look further back.
    return F.coalesce(F.try_element_at(v, F.lit(-1)), F.when((F.size(v) > 0) & ~only_nulls, last))


def last_non_empty(v: Column) -> Column:
    """The last element with text, or null."""
    last = F.try_element_at(v, F.lit(-1))
    return (F.when(F.coalesce(last, F.lit("")) != F.lit(""), last)
             .when(F.size(v) > 1, F.try_element_at(F.filter(v, lambda x: F.coalesce(x, F.lit("")) != F.lit("")), F.lit(-1))))


def coded(arr: Column) -> tuple[Column, Column]:
    """(concatenated value, last listURI) of a code element array."""
    return concat_values(values(arr)), last_present(attribute(arr, "listURI"))


def amount(arr: Column) -> tuple[Column, Column]:
    """(concatenated amount, last currencyID) of an amount element array."""
    return concat_values(values(arr)), last_present(attribute(arr, "currencyID"))
