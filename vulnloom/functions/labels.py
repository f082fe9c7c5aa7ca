"""Lookups in a parsed label/value list.

Three rules, and they differ on purpose:

* ``value_of`` and ``link_of`` pass over a matching label that lacks what they
  need and go on to the next one: they look in ``with_value`` or ``with_link``;
* ``first_of`` looks in the whole list, and the first matching label decides,
  whatever it holds.

Labels come lower-cased from the parse. A lookup is a position in the list's
label array, so it stays in generated code.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_value(entries: Column) -> Column:
    return F.filter(entries, lambda d: d["has_dd"])


def with_link(entries: Column) -> Column:
    return F.filter(entries, lambda d: d["has_dd"] & (F.size(d["anchors"]) > 0))


def _place(entries: Column, label: str) -> Column:
    """0-based, -1 when the label is not there."""
    return (F.array_position(entries["label"], label.lower()) - 1).cast("int")


def value_of(valued: Column, label: str) -> Column:
    return F.coalesce(F.get(valued["value"], _place(valued, label)), F.lit(""))


def link_of(linked: Column, label: str) -> Column:
    anchors = F.get(linked["anchors"], _place(linked, label))
    return F.coalesce(F.get(anchors, F.lit(0)), F.lit(""))


def first_of(entries: Column, label: str) -> Column:
    return F.get(entries, _place(entries, label))
