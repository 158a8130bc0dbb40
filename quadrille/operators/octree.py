"""Trees of nodes: enumeration level by level, with empty subtrees cut off, targets and schedules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import addresses
from ..sources.tables import written

SCHEMA = "ids array<int>, addr bigint, depth int, o0 bigint, o1 bigint, o2 bigint, s0 bigint, s1 bigint, s2 bigint, e0 bigint, e1 bigint, e2 bigint, is_leaf boolean"

#: Digits of an address, each 8 at most, that fit 64 bits.
DEEPEST = 19
#: Levels of a block: at most 8^6 cells in one array of a task.
BLOCK = 6
#: Parents that one task divides, and tasks of a level at most.
PER_TASK, MOST_TASKS = 1 << 16, 512


def leaf_test(shape: list[int], voxel: tuple[float, float, float], most: int) -> bool:
    n = 1.0
    for s in shape:
        n *= s
    return int(n / (voxel[0] * voxel[1] * voxel[2])) < most


def height(shape: list[int], voxel, most: int, fan: int = 8) -> int:
    """Levels down to where the largest node is a leaf: halves are rounded up for it."""
    h, top = 0, list(shape)
    while not leaf_test(top, voxel, most):
        h += 1
        top = [-(-s // (1 << h)) if (fan - 1) >> d & 1 else s for d, s in enumerate(shape)]
    return h


def _finished(df: DataFrame, voxel, most: int) -> DataFrame:
    return _sized(df.withColumns({"addr": addresses.to_int(F.col("ids")), "depth": F.size("ids")}), voxel, most)


def _sized(df: DataFrame, voxel, most: int) -> DataFrame:
    size = F.col("s0").cast("double") * F.col("s1") * F.col("s2") / float(voxel[0] * voxel[1] * voxel[2])
    df = df.withColumns({f"e{d}": F.col(f"o{d}") + F.col(f"s{d}") for d in range(3)})
    return df.withColumn("is_leaf", F.floor(size) < most).select("ids", "addr", "depth", *[f"{c}{d}" for c in "ose" for d in range(3)], "is_leaf")


def root(spark: SparkSession, ori: list[int], shape: list[int], voxel, most: int) -> DataFrame:
    df = spark.createDataFrame([([], *ori, *shape)], "ids array<int>, o0 bigint, o1 bigint, o2 bigint, s0 bigint, s1 bigint, s2 bigint")
    return _finished(df, voxel, most)


def nodes(spark: SparkSession, ori, shape, voxel, most: int, fan: int = 8, tiles: DataFrame | None = None) -> DataFrame:
    """All nodes; with tiles only those that some tile hits, a node's children only if the node is no leaf and is hit."""
    deep = height(shape, voxel, most, fan)
    if deep > DEEPEST:
        raise ValueError(f"the tree has {deep} levels, and an address holds {DEEPEST} at most: choose larger leaves or voxels")
    if tiles is not None:
        return hit_nodes(tiles, ori, shape, voxel, most, fan)
    out = root(spark, ori, shape, voxel, most)
    for depth in range(1, deep + 1):
        out = out.unionByName(_level(spark, depth, ori, shape, voxel, most, fan))
    return out


def _level(spark: SparkSession, depth: int, ori, shape, voxel, most: int, fan: int) -> DataFrame:
    """The nodes of one depth: their parents are numbers, dealt to tasks by ranges, whose boxes follow in closed form."""
    many, bits = fan ** (depth - 1), fan.bit_length() - 1
    up = depth - 1
    df = spark.range(0, many, 1, max(1, min(many // PER_TASK, MOST_TASKS)))
    df = df.select(*[F.shiftright("id", bits * (up - 1 - j)).bitwiseAND(F.lit(fan - 1).cast("long")).cast("int").alias(f"b{j}") for j in range(up)])
    box = _box_of(up, ori, shape, fan)
    size = box["s0"].cast("double") * box["s1"] * box["s2"] / float(voxel[0] * voxel[1] * voxel[2])
    above = sum(((F.col(f"b{j}") + 1).cast("long") * 10 ** (up - 1 - j) for j in range(up)), F.lit(0).cast("long"))
    ids = F.array(*[F.col(f"b{j}") for j in range(up)]).cast("array<int>")
    df = df.where(F.floor(size) >= most).select(ids.alias("ids"), above.alias("addr"), *[box[f"{c}{d}"].alias(f"{c}{d}") for c in "os" for d in range(3)])
    df = df.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(fan)])))
    half, on = [F.shiftright(f"s{d}", 1) for d in range(3)], [F.shiftright("k", d).bitwiseAND(F.lit(1)) == 1 for d in range(3)]
    split = [bool((fan - 1) >> d & 1) for d in range(3)]
    o = [F.when(on[d], F.col(f"o{d}") + half[d]).otherwise(F.col(f"o{d}")).alias(f"o{d}") if split[d] else F.col(f"o{d}") for d in range(3)]
    s = [F.when(on[d], F.col(f"s{d}") - half[d]).otherwise(half[d]).alias(f"s{d}") if split[d] else F.col(f"s{d}") for d in range(3)]
    df = df.select(addresses.push(F.col("ids"), F.col("k")).alias("ids"), (F.col("addr") * 10 + F.col("k") + 1).alias("addr"), F.lit(depth).alias("depth"), *o, *s)
    return _sized(df, voxel, most)


def hit_nodes(tiles: DataFrame, ori, shape, voxel, most: int, fan: int = 8) -> DataFrame:
    """The nodes that some tile hits: one scan of the tiles and no join.

    On each axis a tile's ends descend by halves to their cells of the finest level, as arithmetic within the scan. The ranges of cells are cut
    by blocks, the subtrees of the last BLOCK levels, and equal ones are kept once; a task paints the cells of a block into one array, and
    each level of the block follows from the one below by halving the array. Above the blocks each level is the distinct parents of the one below.
    What lies below a leaf is left out. A tile gives as many rows as it covers blocks, which are all in the result (or below a leaf that is).
    """
    deep = height(shape, voxel, most, fan)
    if deep > DEEPEST:
        raise ValueError(f"the tree has {deep} levels, and an address holds {DEEPEST} at most: choose larger leaves or voxels")
    split = [bool((fan - 1) >> d & 1) for d in range(3)]
    # first and last unit of the tile within the root; tiles outside or without extent drop out
    df = tiles.where(" and ".join(f"e{d} > o{d}" for d in range(3)))
    lo = {f"lo{d}": F.greatest(F.col(f"o{d}") - F.lit(ori[d]), F.lit(0)) for d in range(3)}
    hi = {f"hi{d}": F.least(F.col(f"e{d}") - F.lit(ori[d]), F.lit(shape[d])) - 1 for d in range(3)}
    df = df.select(*[c.alias(k) for k, c in (lo | hi).items()]).where(" and ".join(f"lo{d} <= hi{d}" for d in range(3)))
    axes = [d for d in range(3) if split[d]]
    state = {f"{x}{w}{d}": F.lit(0 if x == "i" else shape[d]).cast("long") for x in "is" for w in ("lo", "hi") for d in axes}
    df = df.withColumns(state)
    for _ in range(deep):  # the place within the cell, the cell's extent and its number
        ups = {f"u{w}{d}": (F.col(f"{w}{d}") >= F.shiftright(F.col(f"s{w}{d}"), 1)).cast("long") for w in ("lo", "hi") for d in axes}
        df = df.withColumns(ups)
        half = lambda k: F.shiftright(F.col(f"s{k}"), 1)
        ends = [f"{w}{d}" for w in ("lo", "hi") for d in axes]
        df = df.withColumns({k: F.col(k) - F.col(f"u{k}") * half(k) for k in ends} | {f"s{k}": F.shiftright(F.col(f"s{k}") + F.col(f"u{k}"), 1) for k in ends} | {f"i{k}": F.col(f"i{k}") * 2 + F.col(f"u{k}") for k in ends})
    df = df.select(*[f"i{w}{d}" for w in ("lo", "hi") for d in axes]).distinct()  # tiles that cover the same cells are one
    low = min(BLOCK, deep)
    for d in range(3):
        if split[d]:
            df = df.withColumn(f"b{d}", F.explode(F.sequence(F.shiftright(f"ilo{d}", low), F.shiftright(f"ihi{d}", low))))
            first = F.shiftleft(f"b{d}", low)
            df = df.withColumns({f"lo{d}": F.greatest(F.col(f"ilo{d}") - first, F.lit(0)), f"hi{d}": F.least(F.col(f"ihi{d}") - first, F.lit((1 << low) - 1))})
        else:
            df = df.withColumns({c: F.lit(0).cast("long") for c in (f"b{d}", f"lo{d}", f"hi{d}")})
    blocks = written(df.select("b0", "b1", "b2", *[f"{w}{d}" for d in range(3) for w in ("lo", "hi")]).distinct())
    places = fan ** (deep - low)
    dealt = blocks.repartition(max(1, min(places, MOST_TASKS)), "b0", "b1", "b2").sortWithinPartitions("b0", "b1", "b2")
    flat = [f"{c}{d}" for c in "os" for d in range(3)]
    out = dealt.mapInArrow(_painted(deep, low, ori, shape, voxel, most, fan), "addr bigint, depth int, " + ", ".join(f"{c} bigint" for c in flat) + ", is_leaf boolean")
    out = out.select(addresses.from_int(F.col("addr")).alias("ids"), "addr", "depth", *flat, *[(F.col(f"o{d}") + F.col(f"s{d}")).alias(f"e{d}") for d in range(3)], "is_leaf")
    addr = F.lit(0).cast("long")
    for level in range(deep - low - 1, -1, -1):
        digit = F.lit(1).cast("long")
        for d in axes:
            digit = digit + F.shiftright(F.col(f"b{d}"), level).bitwiseAND(F.lit(1).cast("long")) * (1 << d)
        addr = addr * 10 + digit
    cells = blocks.select("b0", "b1", "b2").distinct().select(addr.alias("addr"))
    for depth in range(deep - low - 1, -1, -1):
        cells = cells.select(F.expr("addr div 10").alias("addr")).distinct()
        out = out.unionByName(_kept(cells, depth, ori, shape, voxel, most, fan))
    return out


def _axis(k: int, first: int, many: int, ori: int, extent: int) -> tuple[np.ndarray, np.ndarray]:
    """Origins and extents on one axis of the cells first, first + 1, ... of depth k, as in _box_of."""
    i = np.arange(first, first + many, dtype=np.int64)
    o, turned = np.full(many, ori, np.int64), np.full(many, extent, np.int64)
    for j in range(k):
        up = (i >> (k - 1 - j)) & 1
        o += up * (turned >> (j + 1))
        turned += up << j
    return o, turned >> k


def _painted(deep: int, low: int, ori, shape, voxel, most: int, fan: int):
    """The nodes of blocks, their roots included, from rows of (b0, b1, b2, lo0, hi0, ...), sorted by block."""
    split = [bool((fan - 1) >> d & 1) for d in range(3)]
    whole = float(voxel[0] * voxel[1] * voxel[2])
    names = ["addr", "depth", *[f"{c}{d}" for c in "os" for d in range(3)], "is_leaf"]

    def address(cells, levels: int):
        out = np.zeros(len(cells[0]), np.int64)
        for level in range(levels - 1, -1, -1):
            out = out * 10 + 1 + sum(((c >> level) & 1) << d for d, c in enumerate(cells) if split[d])
        return out

    def nodes_of(block: tuple[int, ...], cells: np.ndarray):
        root = address([np.array([b], np.int64) for b in block], deep - low)[0]
        for k in range(low, -1, -1):  # levels of the block
            depth = deep - low + k
            z, y, x = np.nonzero(cells)
            at = (x, y, z)
            many = [1 << k if split[d] else 1 for d in range(3)]
            axis = [_axis(depth if split[d] else 0, block[d] << k if split[d] else 0, many[d], ori[d], shape[d]) for d in range(3)]
            s = [axis[d][1][at[d]] for d in range(3)]
            on = None
            if depth:  # nothing below a leaf
                above = [_axis(depth - 1, (block[d] << k) >> 1, max(1, many[d] >> 1), ori[d], shape[d])[1] if split[d] else axis[d][1] for d in range(3)]
                p = [above[d][at[d] >> 1] if split[d] else s[d] for d in range(3)]
                on = np.floor(p[0].astype(np.float64) * p[1] * p[2] / whole) >= most
                if not on.all():
                    at, s = tuple(a[on] for a in at), [v[on] for v in s]
            if len(at[0]):
                leaf = np.floor(s[0].astype(np.float64) * s[1] * s[2] / whole) < most
                columns = [root * 10**k + address(at, k), np.full(len(leaf), depth, np.int32), *[axis[d][0][at[d]] for d in range(3)], *s, leaf]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
            if k:
                for d in range(3):
                    if split[d]:
                        pair = [slice(None)] * 3
                        pair[2 - d] = slice(0, None, 2)
                        odd = list(pair)
                        odd[2 - d] = slice(1, None, 2)
                        cells = cells[tuple(pair)] | cells[tuple(odd)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cells = None, None
        for b in batches:
            for b0, b1, b2, *ends in zip(*(c.to_pylist() for c in b.columns)):
                if (b0, b1, b2) != block:
                    if block is not None:
                        yield from nodes_of(block, cells)
                    block, cells = (b0, b1, b2), np.zeros([1 << low if split[d] else 1 for d in (2, 1, 0)], bool)
                cells[ends[4] : ends[5] + 1, ends[2] : ends[3] + 1, ends[0] : ends[1] + 1] = True
        if block is not None:
            yield from nodes_of(block, cells)

    return task


def _kept(cells: DataFrame, depth: int, ori, shape, voxel, most: int, fan: int) -> DataFrame:
    """The nodes with these addresses of one depth, without those below a leaf."""
    digit = lambda j: F.pmod(F.expr(f"addr div {10 ** (depth - 1 - j)}L"), F.lit(10)).cast("int") - 1
    ids = F.array(*[digit(j) for j in range(depth)]) if depth else F.array().cast("array<int>")
    df = cells.select("addr", ids.alias("ids"), *[digit(j).alias(f"b{j}") for j in range(depth)])
    size = lambda box: F.floor(box["s0"].cast("double") * box["s1"] * box["s2"] / float(voxel[0] * voxel[1] * voxel[2]))
    if depth:
        df = df.where(size(_box_of(depth - 1, ori, shape, fan)) >= most)
    box = _box_of(depth, ori, shape, fan)
    df = df.select("ids", "addr", F.lit(depth).alias("depth"), *[box[f"{c}{d}"].alias(f"{c}{d}") for c in "os" for d in range(3)])
    return df.select("*", *[(F.col(f"o{d}") + F.col(f"s{d}")).alias(f"e{d}") for d in range(3)], (size({f"s{d}": F.col(f"s{d}") for d in range(3)}) < most).alias("is_leaf"))


def _box_of(depth: int, ori, shape, fan: int) -> dict[str, Column]:
    """Origin and shape of the node with child ids b0, b1, ..., in closed form: after the halves x0, x1, ... (1 the upper) an extent s
    has become floor((s + x0 + 2 x1 + 4 x2 + ...) / 2^depth), and each upper half begins where the lower ends."""
    out = {}
    for d in range(3):
        o, turned, halves = F.lit(ori[d]).cast("long"), F.lit(shape[d]).cast("long"), depth if (fan - 1) >> d & 1 else 0
        for j in range(halves):
            up = F.shiftright(F.col(f"b{j}"), d).bitwiseAND(1).cast("long")
            o = o + up * F.shiftright(turned, j + 1)
            turned = turned + up * (1 << j)
        out[f"o{d}"], out[f"s{d}"] = o, F.shiftright(turned, halves)
    return out


def post_order(nodes_: DataFrame) -> DataFrame:
    """Children before their parents: by the address, padded behind with a digit above all others."""
    return nodes_.orderBy(F.rpad(F.when(F.col("addr") == 0, "").otherwise(F.col("addr").cast("string")), 24, "9"))


def subtree(nodes_: DataFrame, target: int) -> DataFrame:
    """The target and what lies below it."""
    return nodes_ if target == 0 else nodes_.where(F.col("addr").cast("string").startswith(str(target)))


def target_window(ids: list[int], at: list[float], extent: list[float]) -> tuple[list[float], list[float]]:
    """The fractional window of an address: halved for each digit, shifted by half where the digit's bit is set."""
    at, extent = list(at), list(extent)
    for i in ids:
        for d in range(3):
            extent[d] /= 2
            at[d] += extent[d] if i >> d & 1 else 0
    return at, extent


def schedule(addrs: DataFrame, batch: int = 7) -> DataFrame:
    """addr, depth, parent and the batch of each address within its depth.

    Addresses are sorted by ranges; the rows of each depth in each range are counted, and a row's number is its place in its range
    behind the counts before: no depth is sorted in one task.
    """
    a = F.col("addr")
    ranged = addrs.select("addr", addresses.depth(a).alias("depth")).repartitionByRange("depth", "addr").select("depth", "addr", F.spark_partition_id().alias("part"))
    ranged = written(ranged)
    parts = ranged.groupBy("depth", "part").agg(F.count(F.lit(1)).alias("n"), F.min("addr").alias("least"))
    starts = parts.withColumn("start", F.sum("n").over(Window.partitionBy("depth").orderBy("part")) - F.col("n"))  # a row for each range of a depth
    least = starts.agg(F.min("least")).head()[0]
    place = F.row_number().over(Window.partitionBy("depth", "part").orderBy("addr")) - 1
    df = ranged.withColumn("place", place).join(starts.select("depth", "part", "start"), ["depth", "part"])
    parent = F.when(a != F.lit(least), F.floor(a / 10).cast("long"))
    return df.select("addr", "depth", parent.alias("parent"), F.floor((F.col("start") + F.col("place")) / batch).cast("long").alias("batch"))


def holds(scheduled: DataFrame) -> DataFrame:
    """For each parent the batches that it waits for."""
    return scheduled.where("parent is not null").groupBy("parent").agg(F.sort_array(F.collect_set(F.struct("depth", "batch"))).alias("holds"))
