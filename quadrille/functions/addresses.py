"""Addresses of tree nodes: arrays of child ids from the root; digits id + 1; the root is 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(ids: Column) -> Column:
    return F.aggregate(ids, F.lit(0).cast("long"), lambda a, i: a * 10 + i + 1)


def from_int(addr: Column) -> Column:
    """Child ids; 0 is the root; a 0 or 9 among the digits gives null."""
    text = addr.cast("string")
    return F.when(addr == 0, F.array().cast("array<int>")).when(text.rlike("^[1-8]+$"), F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: c.cast("int") - 1))


def to_path(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: (i + 1).cast("string")), "/")


def push(ids: Column, child: Column) -> Column:
    return F.concat(ids, F.array(child))


def pop(ids: Column) -> Column:
    return F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0)))


def depth(addr: Column) -> Column:
    return F.when(addr == 0, 0).otherwise(F.length(addr.cast("string")))


def parent(addr: Column) -> Column:
    """null for the root."""
    return F.when(addr > 0, F.floor(addr / 10).cast("long"))
