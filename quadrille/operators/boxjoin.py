"""Box joins: boxes go to the grid cells that they cover, cells join by equality, each pair is kept in one cell.

Joins by cells are hinted to merge: a plan's size of a side does not count the rows that cells add, and a side that it takes for
small would be broadcast through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A box over more cells than these goes to a coarser grid.
MOST_CELLS = 64
LEVELS = 12


def cell_size(boxes: DataFrame) -> tuple[int, ...]:
    """About the median extent on each axis, from one aggregate."""
    row = boxes.agg(*[F.percentile_approx(f"s{d}", 0.5, 1000).alias(f"s{d}") for d in range(3)]).head()
    return tuple(max(1, int(row[f"s{d}"] or 1)) for d in range(3))


def _level(cell: tuple[int, ...]) -> Column:
    """The finest grid (cells of size * 4^level) on which the box covers at most MOST_CELLS cells."""
    out = F.lit(LEVELS)
    for k in range(LEVELS - 1, -1, -1):
        n = F.lit(1).cast("double")
        for d in range(3):
            size = cell[d] * 4**k
            n = n * (F.floor((F.col(f"e{d}") - 1) / size) - F.floor(F.col(f"o{d}") / size) + 1)
        out = F.when(n <= MOST_CELLS, k).otherwise(out)
    return out


def _celled(boxes: DataFrame, cell: tuple[int, ...], levels: list[int], prefix: str, key: str) -> DataFrame:
    """A row for each level and cell of it that the box covers; boxes without extent have none."""
    df = boxes.select(F.col(key).alias(f"{prefix}{key}"), *[F.col(f"{c}{d}").alias(f"{prefix}{c}{d}") for c in "oe" for d in range(3)], "level")
    df = df.where(" and ".join(f"{prefix}e{d} > {prefix}o{d}" for d in range(3)))
    at = F.explode(F.array(*[F.lit(k) for k in levels])) if levels else F.col("level")
    df = df.select("*", at.alias("grid")) if levels else df.withColumn("grid", F.col("level"))
    for d in range(3):
        size = F.lit(cell[d]) * F.pow(F.lit(4), F.col("grid")).cast("long")
        lo, hi = F.floor(F.col(f"{prefix}o{d}") / size), F.floor((F.col(f"{prefix}e{d}") - 1) / size)
        df = df.withColumn(f"c{d}", F.explode(F.sequence(lo, hi)))
    return df.drop("level")


def box_join(left: DataFrame, right: DataFrame, key: str = "id", cell: tuple[int, ...] | None = None, one_grid: bool = False) -> DataFrame:
    """a<key>, b<key> of boxes that hit, without a nested loop.

    Each side is put on its own level's grid and on every coarser level that the other side uses; a pair meets on the
    coarser of its two levels, in the cell of its common corner alone, so no distinct is needed. one_grid: the cell is
    known to be about as large as the largest box, so there is one level.
    """
    cell = cell or cell_size(left)
    level = F.lit(0) if one_grid else _level(cell)
    left, right = left.withColumn("level", level), right.withColumn("level", level)
    used = [0] if one_grid else sorted({r[0] for r in left.select("level").distinct().unionByName(right.select("level").distinct()).collect()})  # LEVELS + 1 values at most
    parts = []
    for k in used:
        a = _celled(left.where(F.col("level") == k), cell, [k], "a", key)
        b = _celled(right.where(F.col("level") <= k), cell, [k], "b", key)
        parts.append((a, b))
        if k != used[0]:
            parts.append((_celled(left.where(F.col("level") < k), cell, [k], "a", key), _celled(right.where(F.col("level") == k), cell, [k], "b", key)))
    out = None
    for a, b in parts:
        met = a.join(b.hint("merge"), ["grid", "c0", "c1", "c2"])
        for d in range(3):
            size = F.lit(cell[d]) * F.pow(F.lit(4), F.col("grid")).cast("long")
            corner = F.greatest(F.col(f"ao{d}"), F.col(f"bo{d}"))
            met = met.where((F.least(F.col(f"ae{d}"), F.col(f"be{d}")) > corner) & (F.floor(corner / size) == F.col(f"c{d}")))
        met = met.select(f"a{key}", f"b{key}")
        out = met if out is None else out.unionByName(met)
    return out


def any_hit(left: DataFrame, right: DataFrame, key: str = "id", cell: tuple[int, ...] | None = None, one_grid: bool = False) -> DataFrame:
    """Rows of left that hit some box of right.

    No pair is made: in each cell the right boxes are cut to the cell and those that become one are kept once, and a left box
    stays in a cell by a semi-join, which ends at its first hit. A left box gives a row for each of its cells at most (see MOST_CELLS).
    """
    cell = cell or cell_size(left)
    level = F.lit(0) if one_grid else _level(cell)
    a, b = left.withColumn("level", level), right.withColumn("level", level)
    used = [0] if one_grid else sorted({r[0] for r in a.select("level").distinct().unionByName(b.select("level").distinct()).collect()})  # LEVELS + 1 values at most
    keys = None
    for k in used:  # a pair is tested on the coarser of its two levels
        parts = [(a.where(F.col("level") == k), b.where(F.col("level") <= k))]
        if k != used[0]:
            parts.append((a.where(F.col("level") < k), b.where(F.col("level") == k)))
        for x, y in parts:
            x, y = _celled(x, cell, [k], "a", key), _cut_to_cells(_celled(y, cell, [k], "b", key), cell)
            same = [x[c] == y[c] for c in ("grid", "c0", "c1", "c2")]
            meets = [(F.col(f"ae{d}") > F.col(f"bo{d}")) & (F.col(f"be{d}") > F.col(f"ao{d}")) for d in range(3)]
            met = x.join(y.hint("merge"), [*same, *meets], "left_semi").select(F.col(f"a{key}").alias(key))
            keys = met if keys is None else keys.unionByName(met)
    return left.join(keys.distinct().hint("merge"), key, "left_semi")


def _cut_to_cells(celled: DataFrame, cell: tuple[int, ...]) -> DataFrame:
    """What the right boxes cover of each cell, once."""
    for d in range(3):
        size = F.lit(cell[d]) * F.pow(F.lit(4), F.col("grid")).cast("long")
        celled = celled.withColumns({f"bo{d}": F.greatest(F.col(f"bo{d}"), F.col(f"c{d}") * size), f"be{d}": F.least(F.col(f"be{d}"), (F.col(f"c{d}") + 1) * size)})
    return celled.select("grid", "c0", "c1", "c2", *[f"b{c}{d}" for c in "oe" for d in range(3)]).distinct()
