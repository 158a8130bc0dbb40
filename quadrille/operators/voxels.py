"""Small volumes held as arrays: filters, differences, maxima and masks as row-local expressions, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import point_kernel


def _axis(i: Column, side: int, axis: int) -> Column:
    return F.floor(i / side**axis) % side


def blur_axis(v: Column, kernel: list[float], side: int, axis: int) -> Column:
    """A convolution along one axis of a cube; beyond the edge its value goes on."""
    r = len(kernel) // 2

    def one(_x, i):
        at = _axis(i, side, axis)
        base = i - at * side**axis
        out = F.lit(0.0)
        for k, w in enumerate(kernel):
            to = F.least(F.greatest(at + (k - r), F.lit(0)), F.lit(side - 1))
            out = out + F.get(v, (base + to * side**axis).cast("int")) * w
        return out

    return F.transform(v, one)


def blur(df: DataFrame, kernel: list[float], side: int = 4, column: str = "v", out: str = "v") -> DataFrame:
    """All three axes; each step is a projection of its own, so that no expression is repeated."""
    df = df.withColumn("_b", F.col(column))
    for axis in range(3):
        df = df.withColumn(f"_b{axis}", blur_axis(F.col("_b" if not axis else f"_b{axis - 1}"), kernel, side, axis))
    return df.withColumn(out, F.col("_b2")).drop("_b", "_b0", "_b1", *([] if out == "_b2" else ["_b2"]))


def dog(df: DataFrame, r1: float = 2.0, r2: float = 3.0, side: int = 4) -> DataFrame:
    df = blur(blur(df, point_kernel(r1), side, "v", "_p"), point_kernel(r2), side, "v", "_q")
    return df.withColumn("v", F.zip_with("_p", "_q", lambda a, b: a - b)).drop("_p", "_q")


def maxima(df: DataFrame, threshold: float, side: int = 4) -> DataFrame:
    """vol_id, x, y, z, intensity of voxels over the threshold that no neighbour of 26 exceeds."""
    v = F.col("v")

    def top(i: Column) -> Column:
        x, y, z = (_axis(i, side, d) for d in range(3))
        best = F.lit(float("-inf"))
        for dz in (-1, 0, 1):
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    if dx or dy or dz:
                        ok = (x + dx).between(0, side - 1) & (y + dy).between(0, side - 1) & (z + dz).between(0, side - 1)
                        best = F.greatest(best, F.when(ok, F.get(v, (i + dx + side * dy + side * side * dz).cast("int"))).otherwise(F.lit(float("-inf"))))
        return best

    found = F.filter(F.transform(v, lambda x, i: F.when(x > threshold, F.struct(i.alias("i"), x.alias("v"), top(i).alias("top")))), lambda s: s.isNotNull() & (s["v"] >= s["top"]))
    rows = df.select("vol_id", F.explode_outer(found).alias("p")).where("p is not null")  # as in views.voxels
    at = lambda d: _axis(F.col("p.i"), side, d).cast("int")
    return rows.select("vol_id", at(0).alias("x"), at(1).alias("y"), at(2).alias("z"), F.col("p.v").alias("intensity"))


def mask(v: Column, threshold: float) -> Column:
    return F.transform(v, lambda x: (x > threshold).cast("int"))


#: The bounds of the display range.
LOW, HIGH = -24068.0, -14428.0


def contrast(v: Column, low: float = LOW, high: float = HIGH) -> Column:
    """Values between low and high spread over 0 to 255, cut off beyond, as integers."""
    return F.transform(v, lambda x: F.floor(F.least(F.greatest((x - low) / (high - low) * 255, F.lit(0.0)), F.lit(255.0))).cast("int"))


def view(v: Column, plane: str, side: int = 4) -> Column:
    """A cube's values with its axes turned: xy as they are, yz with x and z exchanged, zx with y and z."""
    to = {"xy": (0, 1, 2), "yz": (2, 1, 0), "zx": (0, 2, 1)}[plane]
    return F.transform(v, lambda _x, i: F.get(v, sum((_axis(i, side, k) * side**d for k, d in enumerate(to)), F.lit(0)).cast("int")))


def decimate(rows: DataFrame, k: int) -> DataFrame:
    """Every k-th voxel of each axis, renumbered."""
    kept = rows.where(" and ".join(f"{c} % {k} = 0" for c in "xyz"))
    return kept.withColumns({c: F.floor(F.col(c) / k).cast("int") for c in "xyz"})


def halve(rows: DataFrame) -> DataFrame:
    """Means over blocks of 2 x 2 x 2: one pyramid level, simplified."""
    half = [F.floor(F.col(c) / 2).cast("int").alias(c) for c in "xyz"]
    return rows.groupBy("vol_id", *half).agg(F.avg("v").alias("v"))
