"""Pyramids: leaves sampled from tiles, parents from their children, one table for each depth."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import addresses, kernels
from ..functions.transforms import box_to_box, compose, parse_size, square_window
from ..sources.tables import written
from . import octree
from .boxjoin import box_join
from .catalog import bounds

NODE = "addr bigint, parent bigint, depth int, ori array<bigint>, shape array<bigint>, dims array<int>, values array<float>"
FILL = 0.0


@dataclass(frozen=True)
class Options:
    """What a render run is told; lengths in um, fractions of the bounds, sizes in voxels."""

    voxel_um: tuple[float, float, float] = (0.5, 0.5, 0.5)
    at: tuple[float, float, float] = (0.0, 0.0, 0.0)
    extent: tuple[float, float, float] = (1.0, 1.0, 1.0)
    children: int = 8
    leaf: str = "64M"
    fov_um: tuple[float, float] = (-1.0, -1.0)
    input_threshold: float = 0.25
    output_threshold: float = 0.25
    output_filter_um: tuple[float, float, float] = (0.0, 0.0, 0.0)
    square: bool = False
    target: int | None = None

    def __post_init__(self):
        if self.children not in (4, 8):
            raise ValueError("children must be 4 or 8")
        if any(not -1e-5 <= x <= 1 + 1e-5 for x in (*self.at, *self.extent)):
            raise ValueError("the window must lie within 0 and 1")
        if min(self.voxel_um) <= 0 or parse_size(self.leaf) < 0:
            raise ValueError("sizes must be positive")
        if self.target is not None and any(c in "09" for c in str(self.target).lstrip("0")):
            raise ValueError(f"{self.target} is no address")

    def voxel_nm(self) -> tuple[float, ...]:
        return tuple(1000 * v for v in self.voxel_um)

    def out_filter(self) -> list:
        return output_filters([1000 * f for f in self.output_filter_um], self.voxel_nm(), self.output_threshold)


def output_filters(filter_nm, voxel_nm, threshold: float = 0.25) -> list[list[float] | None]:
    """A kernel for each axis, or none where the filter is small against the voxel."""
    return [kernels.antialias(f / v, 1.0, threshold) for f, v in zip(filter_nm, voxel_nm)]


def cropped(v: np.ndarray, crop) -> np.ndarray:
    """The front part of a volume (crop x first); a crop of other dimensions leaves it alone."""
    return v[tuple(slice(0, int(n)) for n in list(crop)[::-1])] if crop is not None and len(crop) == v.ndim else v


def run(tiles: DataFrame, load: Callable[[str], np.ndarray], options: Options = Options()) -> DataFrame:
    """The pyramid over a window of the tiles, or the one node that the options name."""
    row = bounds(tiles).head()
    at, extent = options.at, options.extent
    if options.square:
        at, extent = square_window([row[f"s{d}"] for d in range(3)], at, extent, options.voxel_um)
    ori = [int(float(row[f"o{d}"]) + at[d] * float(row[f"s{d}"])) for d in range(3)]
    shape = [int(extent[d] * float(row[f"s{d}"])) for d in range(3)]
    tree = octree.nodes(tiles.sparkSession, ori, shape, options.voxel_nm(), parse_size(options.leaf), options.children, tiles)
    if options.target is not None:
        tree = octree.subtree(tree, options.target)
    done = pyramid(tree, tiles, load, options.voxel_nm(), options.input_threshold, options.out_filter())
    return done if options.target is None else done.where(F.col("addr") == options.target)


def save(nodes: DataFrame, folder: str) -> None:
    """Nodes as a table in folders by depth, each with its path and its transform: origin in nm, nm for each pixel."""
    size = lambda d: F.get("shape", F.lit(d)).cast("double") / F.get("dims", F.lit(d))
    where = [F.get("ori", F.lit(d)).cast("double").alias(f"{c}_nm") for d, c in enumerate(("ox", "oy", "oz"))]
    path = F.when(F.col("addr") == 0, "").otherwise(addresses.to_path(addresses.from_int(F.col("addr"))))
    nodes.select("*", path.alias("path"), *where, *[size(d).alias(f"{c}_nm") for d, c in enumerate(("sx", "sy", "sz"))]).write.partitionBy("depth").parquet(folder)


def stored(spark: SparkSession, folder: str, addr: int | None = None) -> DataFrame:
    """Saved nodes, or the one of an address; only its depth's folder is read."""
    out = spark.read.parquet(folder)
    return out if addr is None else out.where((F.col("depth") == (len(str(addr)) if addr else 0)) & (F.col("addr") == addr))


def node_dims(shape, voxel) -> list[int]:
    return [max(1, int(round(s / v))) for s, v in zip(shape, voxel)]


def leaf(shape, ori, voxel, tiles: list[tuple[np.ndarray, np.ndarray]], threshold: float = 0.25, out_filter: list | None = None) -> np.ndarray | None:
    """A node's volume: every tile (array, transform) low-passed to the target's step, sampled, composed by the maximum."""
    dims = node_dims(shape, voxel)
    size = [s / n for s, n in zip(shape, dims)]
    out, any_ = np.full(dims[::-1], -np.inf), False
    for v, m in tiles:
        step = compose(m, ori, size)
        v = kernels.separable(v.astype(float), [kernels.antialias(step[d, d], 0.5, threshold) for d in range(3)])
        got = kernels.affine(v, step, tuple(dims[::-1]), -np.inf)
        any_ |= bool(np.isfinite(got).any())
        out = np.maximum(out, got)
    out = np.where(np.isfinite(out), out, FILL)
    return (kernels.separable(out, out_filter) if out_filter else out) if any_ else None


def parent(shape, ori, children: list[tuple[list[int], list[int], np.ndarray]], dims: list[int], threshold: float = 0.25) -> np.ndarray:
    """A node's volume from its children's (origin, shape, array)."""
    out = np.full(dims[::-1], -np.inf)
    for o, s, v in children:
        m = box_to_box(o, s, v.shape[::-1], ori, shape, dims)
        # voxel centres: a target voxel takes the middle of the children's voxels that it covers
        m[:3, -1] += (np.diag(m)[:3] - 1) / 2
        low = kernels.separable(v.astype(float), [kernels.antialias(m[d, d], 0.5, threshold) for d in range(3)])
        out = np.maximum(out, kernels.affine(low, m, tuple(dims[::-1]), -np.inf))
    return np.where(np.isfinite(out), out, FILL)


def render_leaves(nodes: DataFrame, tiles: DataFrame, load: Callable[[str], np.ndarray], voxel, threshold: float = 0.25, out_filter: list | None = None) -> DataFrame:
    """Volumes of the leaves among nodes; tiles has id, path, transform and flat boxes; load reads a path on the executor.

    A column `crop` cuts the loaded volumes. Nodes and tiles meet by a grid join; a group is a node and the tiles that hit it, which bounds its memory.
    """
    leaves = nodes.where("is_leaf").withColumn("id", F.col("addr"))
    met = box_join(leaves, tiles).select(F.col("aid").alias("addr"), F.col("bid").alias("id"))
    rows = met.join(tiles.select("id", "path", "transform", *[c for c in ("crop",) if c in tiles.columns]), "id").join(leaves.select("addr", "depth", *[f"{c}{d}" for c in "os" for d in range(3)]), "addr")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        ori, shape = [int(r[f"o{d}"]) for d in range(3)], [int(r[f"s{d}"]) for d in range(3)]
        crops = pdf["crop"] if "crop" in pdf else [None] * len(pdf)
        got = [(cropped(load(p), c), np.array(t, float).reshape(4, 4) if len(t) == 16 else np.array(t, float).reshape(5, 5)[np.ix_([0, 1, 2, 4], [0, 1, 2, 4])]) for p, c, t in zip(pdf["path"], crops, pdf["transform"])]
        v = leaf(shape, ori, voxel, got, threshold, out_filter)
        return _node(int(r["addr"]), int(r["depth"]), ori, shape, v)

    return rows.groupBy("addr").applyInPandas(one, NODE)


def _node(addr: int, depth: int, ori, shape, v: np.ndarray | None) -> pd.DataFrame:
    names = [c.split()[0] for c in NODE.split(", ")]
    rows = [] if v is None else [(addr, addr // 10 if addr else -1, depth, ori, shape, list(v.shape[::-1]), v.astype(np.float32).ravel())]
    return pd.DataFrame(rows, columns=names)


def merge(children: DataFrame, nodes: DataFrame) -> DataFrame:
    """The parents of one depth's volumes: a group has eight children at most."""
    boxes = nodes.select(F.col("addr").alias("parent"), F.array("o0", "o1", "o2").alias("po"), F.array("s0", "s1", "s2").alias("ps"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        kids = [(list(o), list(s), np.array(v, np.float32).reshape(list(d)[::-1])) for o, s, d, v in zip(pdf["ori"], pdf["shape"], pdf["dims"], pdf["values"])]
        dims = [max(k[2].shape[::-1][d] for k in kids) for d in range(3)]
        v = parent(list(r["ps"]), list(r["po"]), kids, dims)
        return _node(int(r["parent"]), int(r["depth"]) - 1, [int(x) for x in r["po"]], [int(x) for x in r["ps"]], v)

    return children.join(boxes, "parent").groupBy("parent").applyInPandas(one, NODE)


def pyramid(nodes: DataFrame, tiles: DataFrame, load, voxel, threshold: float = 0.25, out_filter: list | None = None) -> DataFrame:
    """All volumes, one written table for each depth from the leaves up to the root."""
    deepest = nodes.agg(F.max("depth")).head()[0]
    leaves = written(render_leaves(nodes, tiles, load, voxel, threshold, out_filter))
    level, out = None, leaves
    for d in range(deepest, 0, -1):
        here = leaves.where(F.col("depth") == d)
        here = here if level is None else here.unionByName(level)
        level = written(merge(here, nodes))
        out = out.unionByName(level)
    return out


def target(stored: DataFrame, nodes: DataFrame, addr: int) -> DataFrame:
    """One node from its stored children."""
    return merge(stored.where(F.col("parent") == addr), nodes)


def points(volumes: DataFrame, threshold: float, r1: float = 2.0, r2: float = 3.0, compat: bool = False) -> DataFrame:
    """x, y, z, intensity of local maxima of the difference of Gaussians of each volume (vol_id, dims, values)."""

    def run(batches):
        for b in batches:
            out = []
            for i, d, v in zip(b["vol_id"], b["dims"], b["values"]):
                p = kernels.maxima(kernels.dog(np.array(v, np.float32).reshape(list(d)[::-1]), r1, r2), threshold, compat)
                out.append(pd.DataFrame(p.astype(np.float32), columns=["x", "y", "z", "intensity"]).assign(vol_id=i))
            yield pd.concat(out)[["vol_id", "x", "y", "z", "intensity"]] if out else pd.DataFrame(columns=["vol_id", "x", "y", "z", "intensity"])

    return volumes.select("vol_id", "dims", "values").mapInPandas(run, "vol_id bigint, x float, y float, z float, intensity float")


def correlate(pairs: DataFrame, threshold: float = 0.0, min_overlap: int = 10) -> DataFrame:
    """id, shift on each axis and peak of the masked normalised cross-correlation of the arrays a and b of one shape."""

    def run(batches):
        for b in batches:
            rows = []
            for i, d, p, q in zip(b["id"], b["dims"], b["a"], b["b"]):
                p, q = (np.array(x, float).reshape(list(d)[::-1]) for x in (p, q))
                c = kernels.masked_ncc(p, p > threshold, q, q > threshold, min_overlap)
                at = np.unravel_index(np.argmax(np.round(c, 9)), c.shape)
                z, y, x = (int(k) - (n - 1) for k, n in zip(at, q.shape))
                rows.append((i, x, y, z, float(c[at])))
            yield pd.DataFrame(rows, columns=["id", "dx", "dy", "dz", "peak"])

    return pairs.select("id", "dims", "a", "b").mapInPandas(run, "id bigint, dx int, dy int, dz int, peak double")
