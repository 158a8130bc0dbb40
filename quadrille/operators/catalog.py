"""Operators over a catalogue of tiles (flat columns o, s, e and path)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aabb import hit_literal


def count(tiles: DataFrame) -> DataFrame:
    return tiles.agg(F.count(F.lit(1)).alias("n"))


def bounds(tiles: DataFrame) -> DataFrame:
    """One row: the least box around all tiles; partial aggregates, so one small row per task is moved."""
    low = [F.min(f"o{d}").alias(f"o{d}") for d in range(3)]
    return tiles.agg(*low, *[(F.max(f"e{d}") - F.min(f"o{d}")).alias(f"s{d}") for d in range(3)])


def bounds_nd(boxes: DataFrame, box: str = "box") -> DataFrame:
    """The same for boxes of any one dimension; mixed dimensions raise."""
    b = F.col(box)
    flat = boxes.where(b.isNotNull()).select(F.size(b["ori"]).alias("n"), F.posexplode(F.arrays_zip(b["ori"].alias("o"), b["shape"].alias("s"))).alias("d", "x"))
    per = flat.groupBy("d").agg(F.min("x.o").alias("o"), F.max(F.col("x.o") + F.col("x.s")).alias("e"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    rows = F.array_sort(F.collect_list(F.struct("d", "o", (F.col("e") - F.col("o")).alias("s"))))
    one = per.agg(rows.alias("r"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    ok = F.when(F.col("lo") == F.col("hi"), F.col("r")).otherwise(F.raise_error(F.lit("boxes of different dimensions")).cast("array<struct<d:int,o:bigint,s:bigint>>"))
    return one.select(F.struct(F.transform(ok, lambda x: x["o"]).alias("ori"), F.transform(ok, lambda x: x["s"]).alias("shape")).alias(box))


def fraction(bounds_row, at=(0.0, 0.0, 0.0), extent=(1.0, 1.0, 1.0)) -> tuple[list[int], list[int]]:
    """Origin and shape of a fractional window of a bounds row, truncated to integers, not cut to the bounds."""
    for v in (*at, *extent):
        if not -1e-5 <= v <= 1 + 1e-5:
            raise ValueError(f"{v} is not within 0 and 1")
    ori = [int(float(bounds_row[f"o{d}"]) + at[d] * float(bounds_row[f"s{d}"])) for d in range(3)]
    return ori, [int(extent[d] * float(bounds_row[f"s{d}"])) for d in range(3)]


def box_query(tiles: DataFrame, at=(0.0, 0.0, 0.0), extent=(1.0, 1.0, 1.0)) -> DataFrame:
    """Tiles that a fractional box hits. The bounds are one row; as literals they reach the second scan's filters."""
    row = bounds(tiles).head()
    return tiles.where(F.lit(False)) if row is None or row["o0"] is None else tiles.where(hit_literal(*fraction(row, at, extent)))


def filtered(tiles: DataFrame, test: Column | Callable[[DataFrame], Column]) -> DataFrame:
    return tiles.where(test if isinstance(test, Column) else test(tiles))


def voxel_size(shape: Column, dims: Column) -> Column:
    """nm per pixel, in single precision."""
    return shape.cast("float") / dims.cast("float")


def first_voxel_size(tiles: DataFrame, dims=(754, 1035, 199)) -> DataFrame:
    sizes = [F.min_by(voxel_size(F.col(f"s{d}"), F.lit(dims[d])), "id").alias(f"v{d}") for d in range(3)]
    return tiles.agg(*sizes)


def crop_or_dims(crop: Column, dims: Column) -> Column:
    """An absent or empty crop is the whole shape."""
    return F.when(F.size(crop) > 0, crop).otherwise(dims)


def common_root(tiles: DataFrame, path: str = "path") -> DataFrame:
    """The longest common prefix that ends at a separator; of one tile the whole path, of no separator ''."""
    both = tiles.agg(F.min(path).alias("a"), F.max(path).alias("b"), F.count(path).alias("n"))
    a, b = F.col("a"), F.col("b")
    shared = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), F.lit(0), lambda s, i: F.when((s == i - 1) & (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))), i).otherwise(s))
    root = F.regexp_extract(F.substring(a, F.lit(1), shared), "^(.*/)", 1)
    return both.select(F.when(F.col("n") == 1, a).otherwise(root).alias("root"))


def relative(path: Column, root: Column) -> Column:
    """path without its longest common prefix with root."""
    n = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(root), F.lit(1))), F.lit(0), lambda s, i: F.when((s == i - 1) & (F.substring(path, i, F.lit(1)) == F.substring(root, i, F.lit(1))), i).otherwise(s))
    return F.substring(path, n + 1, F.length(path))


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_k(tiles: DataFrame, by: list[Column], k: int) -> DataFrame:
    return tiles.orderBy(*by).limit(k)
