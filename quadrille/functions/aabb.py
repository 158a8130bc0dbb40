"""Algebra of integer boxes: struct<ori: array<bigint>, shape: array<bigint>>, half open, in nanometres.

n-D functions take such structs. The *3 functions take flat columns (o0..o2, e0..e2 with e = o + s) and stay
inside whole-stage code, so filters on them reach Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<ori:array<bigint>,shape:array<bigint>>"


def make(ori: list, shape: list) -> Column:
    long = lambda xs: F.array(*[F.col(x).cast("long") if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x)).cast("long") for x in xs])
    return F.struct(long(ori).alias("ori"), long(shape).alias("shape"))


def with_parts(box: Column, ori: Column | None = None, shape: Column | None = None) -> Column:
    """box with a new origin or shape; what is not given, or null, stays."""
    return F.struct((F.coalesce(ori, box["ori"]) if ori is not None else box["ori"]).alias("ori"), (F.coalesce(shape, box["shape"]) if shape is not None else box["shape"]).alias("shape"))


def ndim(box: Column) -> Column:
    return F.when(box.isNull(), 0).otherwise(F.coalesce(F.size(box["ori"]), F.lit(0)))


def end(box: Column) -> Column:
    return F.zip_with(box["ori"], box["shape"], lambda o, s: o + s)


def same(a: Column, b: Column) -> Column:
    return F.coalesce((a["ori"] == b["ori"]) & (a["shape"] == b["shape"]), F.lit(False))


def hit(a: Column, b: Column) -> Column:
    """Whether the insides meet: touching boxes and boxes without extent miss, as do null and other dimensions."""
    inner = F.zip_with(F.zip_with(a["ori"], b["ori"], lambda x, y: F.greatest(x, y)), F.zip_with(end(a), end(b), lambda x, y: F.least(x, y)), lambda o, e: e > o)
    return F.coalesce((F.size(a["ori"]) == F.size(b["ori"])) & F.forall(inner, lambda x: x), F.lit(False))


def union(a: Column, b: Column) -> Column:
    """The least box around both; null is the identity; other dimensions raise."""
    ori = F.zip_with(a["ori"], b["ori"], lambda x, y: F.least(x, y))
    both = F.struct(ori.alias("ori"), F.zip_with(F.zip_with(end(a), end(b), lambda x, y: F.greatest(x, y)), ori, lambda e, o: e - o).alias("shape"))
    wrong = F.raise_error(F.lit("boxes of different dimensions")).cast(BOX)
    return F.when(a.isNull(), b).when(b.isNull(), a).when(ndim(a) != ndim(b), wrong).otherwise(both)


def intersect(a: Column, b: Column, compat: bool = False) -> Column:
    """The common box, extents at least 0 (compat: on the first axis alone); null is the identity."""
    ori = F.zip_with(a["ori"], b["ori"], lambda x, y: F.greatest(x, y))
    raw = F.zip_with(F.zip_with(end(a), end(b), lambda x, y: F.least(x, y)), ori, lambda e, o: e - o)
    shape = F.transform(raw, lambda s, i: F.when(i == 0, F.greatest(s, F.lit(0))).otherwise(s) if compat else F.greatest(s, F.lit(0)))
    wrong = F.raise_error(F.lit("boxes of different dimensions")).cast(BOX)
    both = F.struct(ori.alias("ori"), shape.alias("shape"))
    return F.when(a.isNull(), b).when(b.isNull(), a).when(ndim(a) != ndim(b), wrong).otherwise(both)


def volume(box: Column) -> Column:
    return F.aggregate(box["shape"], F.lit(1.0), lambda a, s: a * s)


def child(box: Column, n: int, index: Column) -> Column:
    """Child `index` of n = 2^k: axis d is halved if bit d of n - 1 is set, the upper half has the remainder."""
    if n < 1 or n & (n - 1):
        raise ValueError(f"{n} is not a power of two")
    bit = lambda d: F.call_function("shiftright", F.lit(n - 1), d).bitwiseAND(1) == 1
    up = lambda d: F.call_function("shiftright", index.cast("int"), d).bitwiseAND(1) == 1
    half = lambda s: F.floor(s / 2).cast("long")
    ori = F.zip_with(F.transform(box["shape"], lambda s, d: F.when(bit(d) & up(d), half(s)).otherwise(F.lit(0))), box["ori"], lambda x, o: o + x)
    shape = F.transform(box["shape"], lambda s, d: F.when(bit(d) & up(d), s - half(s)).when(bit(d), half(s)).otherwise(s))
    return F.struct(ori.alias("ori"), shape.alias("shape"))


def subdivide(box: Column, n: int) -> Column:
    """The n children as an array, in the order of their ids."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: child(box, n, i))


def hit3(a: str = "", b: str = "") -> Column:
    """hit for flat columns with prefixes a and b (each may end in a dot)."""
    one = lambda d: F.least(F.col(f"{a}e{d}"), F.col(f"{b}e{d}")) > F.greatest(F.col(f"{a}o{d}"), F.col(f"{b}o{d}"))
    return one(0) & one(1) & one(2)


def hit_literal(ori: list[int], shape: list[int]) -> Column:
    """hit of flat columns with a fixed box: comparisons with literals, which Parquet readers can use to skip."""
    out = F.lit(all(s > 0 for s in shape))
    for d, (o, s) in enumerate(zip(ori, shape)):
        out = out & (F.col(f"o{d}") < o + s) & (F.col(f"e{d}") > o) & (F.col(f"e{d}") > F.col(f"o{d}"))
    return out
