"""Pairs of overlapping tiles: the overlap alone is read from each, and its shift found by masked correlation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..sources.tables import written
from . import chunks as C
from .boxjoin import box_join

_BOX = [f"{c}{d}" for c in "oe" for d in range(3)]


def overlaps(tiles: DataFrame) -> DataFrame:
    """pair, a, b and the common box of every two tiles (id, o, e in voxels of one grid) that hit, met by the grid join; a < b."""
    met = box_join(tiles, tiles).where("aid < bid")
    for side in "ab":
        met = met.join(tiles.select(F.col("id").alias(f"{side}id"), *[F.col(c).alias(f"{side}{c}") for c in _BOX]), f"{side}id")
    low = [F.greatest(f"ao{d}", f"bo{d}") for d in range(3)]
    high = [F.least(f"ae{d}", f"be{d}") for d in range(3)]
    own = lambda side: F.array(*[lo - F.col(f"{side}o{d}") for d, lo in enumerate(low)])
    return met.select(F.monotonically_increasing_id().alias("pair"), F.col("aid").alias("a"), F.col("bid").alias("b"), own("a").alias("a_ori"), own("b").alias("b_ori"), F.array(*[h - lo for lo, h in zip(low, high)]).alias("shape"))


def aligned(tiles: DataFrame, chunks: DataFrame, side: int, threshold: float = 0.0, min_overlap: int = 10) -> DataFrame:
    """a, b, shift of b's overlap against a's on each axis, and the correlation's peak.

    tiles: id, o0..o2, e0..e2 in voxels of one grid; chunks: the volume of each tile under its id. Voxels at or below the threshold are masked. Each
    pair reads the chunks that its overlap meets, from both volumes; a task holds two overlaps, never a volume.
    """
    pairs = written(overlaps(tiles))  # its numbers must not change when a task is run again
    one = lambda role, k: pairs.select((F.col("pair") * 2 + k).alias("request"), F.col(role).alias("vol_id"), F.col(f"{role}_ori").alias("ori"), "shape")
    parts = C.read_boxes(chunks, side, one("a", 0).unionByName(one("b", 1))).withColumn("pair", F.floor(F.col("request") / 2))

    def shift(t: pa.Table) -> pa.Table:
        found = []
        for role in (0, 1):
            own = t.filter(pa.array([r % 2 == role for r in t["request"].to_pylist()], pa.bool_()))
            if not own.num_rows:
                break
            found.append(C.assembled(own))
        columns: dict[str, list] = {n: [] for n in ("pair", "dx", "dy", "dz", "peak")}
        if len(found) == 2:
            a, b = found
            c = kernels.masked_ncc(a, a > threshold, b, b > threshold, min_overlap)
            at = np.unravel_index(np.argmax(np.round(c, 9)), c.shape)
            dz, dy, dx = (int(k) - (n - 1) for k, n in zip(at, b.shape))
            columns = {"pair": [t["pair"][0].as_py()], "dx": [dx], "dy": [dy], "dz": [dz], "peak": [float(c[at])]}
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(columns.items(), kinds)})

    found = parts.groupBy("pair").applyInArrow(shift, "pair bigint, dx int, dy int, dz int, peak double")
    return pairs.select("pair", "a", "b").join(found, "pair").select("a", "b", "dx", "dy", "dz", "peak")
