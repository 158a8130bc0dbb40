"""Volumes of any size as tables of chunks.

A chunk is a cube of `side` voxels, cut off at the volume's end: vol_id, dims of the volume (x first), cx, cy, cz, a Morton key of
these, and data (x fastest). No row holds a volume. A stored table is sorted by volume and key, so a box is
read by ranges of keys that the scan's statistics test.

Everything that needs voxels of other chunks goes through `exchange`: a block hands each chunk the part that lies within reach
of it, one shuffle brings a chunk's parts together, and a task assembles them. A group has the chunk and its neighbours' rims, whatever
the volume's size. Chunks that a table lacks count as `fill`; beyond a volume's end its edge goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels

AXES = ("cx", "cy", "cz")
CHUNK = "vol_id bigint, dims array<int>, cx int, cy int, cz int, key bigint, data array<double>"
BLOCK = "vol_id bigint, dims array<int>, ori array<int>, shape array<int>, data array<double>"
PIECE = "vol_id bigint, dims array<int>, cx int, cy int, cz int, ori array<int>, shape array<int>, data array<double>"
_BITS = 21  # of each coordinate in a key
#: Fixed values: (shift, mask) that spread 21 bits to every third place.
_SPREAD = ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249))


def morton(cx: Column, cy: Column, cz: Column) -> Column:
    """The key of a chunk: the bits of its coordinates in turn, x lowest."""
    out = None
    for d, c in enumerate((cx, cy, cz)):
        c = c.cast("bigint")
        for shift, mask in _SPREAD:
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
        c = F.shiftleft(c, d)
        out = c if out is None else out.bitwiseOR(c)
    return out


def key_ranges(low: tuple[int, ...], high: tuple[int, ...], most: int = 64) -> list[tuple[int, int]]:
    """Ranges of keys (inclusive) that hold all chunks from low to high (inclusive), `most` at most; they may hold others.

    Cubes of the key's own hierarchy are divided, largest first, as long as there is room for their parts.
    """
    bits = max(1, max(high).bit_length())
    whole, todo = [], [(bits, (0, 0, 0), 0)]  # level, corner, first key
    while todo:
        level, at, first = todo.pop(0)
        size = 1 << level
        if any(a > h or a + size - 1 < lo for a, lo, h in zip(at, low, high)):
            continue
        inside = all(lo <= a and a + size - 1 <= h for a, lo, h in zip(at, low, high))
        if inside or not level or len(whole) + len(todo) + 8 > most:
            whole.append((first, first + 8**level - 1))
            continue
        half = size // 2
        todo += [(level - 1, tuple(a + half * ((k >> d) & 1) for d, a in enumerate(at)), first + k * 8 ** (level - 1)) for k in range(8)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(whole):
        if out and out[-1][1] + 1 == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    off = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([a.size for a in arrays], out=off[1:])
    flat = np.concatenate([a.ravel() for a in arrays]) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


def _overlaps(dims, ori, shape, side: int, reach: int) -> Iterator[tuple[tuple[int, ...], list[int], list[int]]]:
    """Chunks whose surroundings a block meets, with the low and high corner of what they share."""
    spans = []
    for d in range(3):
        last = (int(dims[d]) - 1) // side
        spans.append(range(max(0, (int(ori[d]) - reach) // side), min(last, (int(ori[d]) + int(shape[d]) - 1 + reach) // side) + 1))
    for c in product(*spans):
        low = [max(int(ori[d]), c[d] * side - reach) for d in range(3)]
        high = [min(int(ori[d]) + int(shape[d]), (c[d] + 1) * side + reach, int(dims[d])) for d in range(3)]
        if all(a < b for a, b in zip(low, high)):
            yield c, low, high


def _scattered(side: int, reach: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                ids, dims, ori, shape = (b.column(n)[at].as_py() for n in ("vol_id", "dims", "ori", "shape"))
                if not all(n > 0 for n in shape):
                    continue
                v = b.column("data")[at].values.to_numpy(zero_copy_only=False).reshape(shape[::-1])
                found = list(_overlaps(dims, ori, shape, side, reach))
                cut = [v[tuple(slice(a - o, z - o) for a, z, o in zip(low, high, ori))[::-1]] for _, low, high in found]
                n = len(found)
                triple = lambda rows: pa.array(rows, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids] * n, pa.int64()), triple([dims] * n), *[pa.array([c[d] for c, _, _ in found], pa.int32()) for d in range(3)],
                     triple([low for _, low, _ in found]), triple([[z - a for a, z in zip(low, high)] for _, low, high in found]), _lists(cut, pa.float64())],
                    names=["vol_id", "dims", *AXES, "ori", "shape", "data"],
                )

    return task


def _assembled(t: pa.Table, side: int, reach: int, fill: float) -> tuple[dict, np.ndarray, list[int], list[int]]:
    """A chunk's coordinates, its surroundings within the volume, and how many voxels of them lie before and behind the chunk on each axis (x first)."""
    first = {n: t[n][0].as_py() for n in ("vol_id", "dims", *AXES)}
    c, dims = [first[a] for a in AXES], first["dims"]
    low = [max(0, c[d] * side - reach) for d in range(3)]
    high = [min(dims[d], (c[d] + 1) * side + reach) for d in range(3)]
    out = np.full([b - a for a, b in zip(low, high)][::-1], fill)
    for ori, shape, data in zip(t["ori"].to_pylist(), t["shape"].to_pylist(), t["data"]):
        at = tuple(slice(o - a, o - a + n) for o, a, n in zip(ori, low, shape))[::-1]
        out[at] = data.values.to_numpy(zero_copy_only=False).reshape(shape[::-1])
    return first, out, [c[d] * side - low[d] for d in range(3)], [high[d] - min(dims[d], (c[d] + 1) * side) for d in range(3)]


def _chunk_row(first: dict, v: np.ndarray) -> pa.Table:
    key = 0
    for d, a in enumerate(AXES):
        for k in range(_BITS):
            key |= ((first[a] >> k) & 1) << (3 * k + d)
    kinds = {"vol_id": pa.int64(), "dims": pa.list_(pa.int32()), **{a: pa.int32() for a in AXES}}
    return pa.table({**{n: pa.array([first[n]], k) for n, k in kinds.items()}, "key": pa.array([key], pa.int64()), "data": _lists([v], pa.float64())})


def blocks_of(chunks: DataFrame, side: int) -> DataFrame:
    """Chunks as blocks: ori and shape in voxels."""
    ori = F.array(*[F.col(a) * side for a in AXES])
    shape = F.array(*[F.least(F.lit(side), F.get("dims", F.lit(d)) - F.col(a) * side) for d, a in enumerate(AXES)])
    return chunks.select("vol_id", "dims", ori.cast("array<int>").alias("ori"), shape.cast("array<int>").alias("shape"), F.col("data").cast("array<double>").alias("data"))


def exchange(
    blocks: DataFrame, side: int, reach: int, task: Callable[[dict, np.ndarray, list[int], list[int]], pa.Table], schema: str, fill: float = 0.0, first: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None
) -> DataFrame:
    """Runs task(chunk, surroundings, voxels before, voxels behind) for every chunk that some block reaches. first: what is done to the blocks on the way, by the worker that hands
    their parts on (a step of its own would hold a second worker in each task)."""

    def run(t: pa.Table) -> pa.Table:
        return task(*_assembled(t, side, reach, fill))

    dealt = _scattered(side, reach)
    pieces = blocks.select("vol_id", "dims", "ori", "shape", "data").mapInArrow(dealt if first is None else lambda batches: dealt(first(batches)), PIECE)
    return pieces.groupBy("vol_id", *AXES).applyInArrow(run, schema)


def chunked(blocks: DataFrame, side: int, fill: float = 0.0, first: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """Blocks anywhere in their volumes (vol_id, dims, ori, shape, data) as chunks. Voxels that no block has are fill."""
    return exchange(blocks, side, 0, lambda c, v, _a, _b: _chunk_row(c, v), CHUNK, fill, first)


def rechunked(chunks: DataFrame, side: int, to: int, fill: float = 0.0) -> DataFrame:
    return chunked(blocks_of(chunks, side), to, fill)


def dense(chunks: DataFrame, side: int, fill: float = 0.0) -> DataFrame:
    """All chunks of every volume; those that the table lacks are made of fill."""
    every = chunks.groupBy("vol_id").agg(F.first("dims").alias("dims"))
    for d, a in enumerate(AXES):
        every = every.withColumn(a, F.explode(F.sequence(F.lit(0), F.floor((F.get("dims", F.lit(d)) - 1) / side).cast("int"))))
    size = F.lit(1)
    for d, a in enumerate(AXES):
        size = size * F.least(F.lit(side), F.get("dims", F.lit(d)) - F.col(a) * side)
    have = chunks.select("vol_id", *AXES, "data")
    met = every.join(have, ["vol_id", *AXES], "left")
    return met.select("vol_id", "dims", *AXES, morton(*[F.col(a) for a in AXES]).alias("key"), F.coalesce("data", F.array_repeat(F.lit(fill), size.cast("int"))).alias("data"))


def voxels(chunks: DataFrame, side: int) -> DataFrame:
    """vol_id, x, y, z, v."""
    b = blocks_of(chunks, side)
    rows = b.select("vol_id", "ori", "shape", F.posexplode_outer("data").alias("i", "v")).where("i is not null")
    n = lambda d: F.get("shape", F.lit(d))
    at = [F.col("i") % n(0), F.floor(F.col("i") / n(0)) % n(1), F.floor(F.col("i") / (n(0) * n(1)))]
    return rows.select("vol_id", *[(F.get("ori", F.lit(d)) + p).cast("int").alias(c) for d, (c, p) in enumerate(zip("xyz", at))], "v")


# --- storage and box reads ---------------------------------------------------------------------------------


def store(chunks: DataFrame, folder: str) -> None:
    """Writes chunks so that neighbours in space lie in the same files and row groups."""
    chunks.repartitionByRange("vol_id", "key").sortWithinPartitions("vol_id", "key").write.parquet(folder)


def stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(CHUNK).parquet(folder)


def _cropped(side: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of (request, chunk): the part of the chunk that the request's box holds, ori being counted from the box's corner."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, cut = [], []
            for at in range(b.num_rows):
                r = {n: b.column(n)[at].as_py() for n in ("request", "vol_id", "dims", *AXES, "lo", "hi")}
                ori = [r[a] * side for a in AXES]
                shape = [min(side, r["dims"][d] - ori[d]) for d in range(3)]
                low = [max(o, a) for o, a in zip(ori, r["lo"])]
                high = [min(o + n, z) for o, n, z in zip(ori, shape, r["hi"])]
                if all(a < z for a, z in zip(low, high)):
                    v = b.column("data")[at].values.to_numpy(zero_copy_only=False).reshape(shape[::-1])
                    cut.append(v[tuple(slice(a - o, z - o) for a, z, o in zip(low, high, ori))[::-1]])
                    size = [z - max(a, 0) for a, z in zip(r["lo"], (min(h, n) for h, n in zip(r["hi"], r["dims"])))]
                    out.append((r["request"], r["vol_id"], size, [a - max(o, 0) for a, o in zip(low, r["lo"])], [z - a for a, z in zip(low, high)]))
            triple = pa.list_(pa.int32())
            kinds = [pa.int64(), pa.int64(), triple, triple, triple]
            yield pa.RecordBatch.from_arrays([*[pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], _lists(cut, pa.float64())], names=["request", "vol_id", "dims", "ori", "shape", "data"])

    return task


_PART = "request bigint, vol_id bigint, dims array<int>, ori array<int>, shape array<int>, data array<double>"


def read_box(chunks: DataFrame, side: int, ori: list[int], shape: list[int], volumes: Column | None = None) -> DataFrame:
    """The voxels of one box in every volume (or those of a condition on vol_id), as parts: dims is the box's size within the volume, ori counts from its corner.

    The scan gets the volumes, ranges of keys and bounds of coordinates as filters; a chunk outside them is not read.
    """
    hi = [o + n for o, n in zip(ori, shape)]
    low, high = [max(0, o) // side for o in ori], [max(0, h - 1) // side for h in hi]
    found = chunks if volumes is None else chunks.where(volumes)
    near = None
    for a, b in key_ranges(tuple(low), tuple(high)):
        one = F.col("key").between(a, b)
        near = one if near is None else near | one
    found = found.where(near)
    for d, a in enumerate(AXES):
        found = found.where(F.col(a).between(low[d], high[d]))
    ints = lambda xs: F.array(*[F.lit(int(x)) for x in xs])
    return found.select(F.lit(0).cast("bigint").alias("request"), "*", ints(ori).alias("lo"), ints(hi).alias("hi")).mapInArrow(_cropped(side), _PART)


def read_boxes(chunks: DataFrame, side: int, requests: DataFrame) -> DataFrame:
    """The voxels of many boxes (request, vol_id, ori, shape), as parts. Requests meet chunks by volume and key; only chunks that a box meets are joined."""
    r = requests.select("request", F.col("vol_id").alias("_v"), F.col("ori").cast("array<int>").alias("lo"), F.zip_with("ori", "shape", lambda o, n: (o + n).cast("int")).alias("hi"))
    r = r.where(F.forall(F.zip_with("lo", "hi", lambda a, b: (b > a) & (b > 0)), lambda x: x))
    for d in range(3):
        first, last = F.greatest(F.get("lo", F.lit(d)), F.lit(0)), F.get("hi", F.lit(d)) - 1
        r = r.withColumn(f"_{AXES[d]}", F.explode(F.sequence(F.floor(first / side).cast("int"), F.floor(last / side).cast("int"))))
    r = r.withColumn("_key", morton(*[F.col(f"_{a}") for a in AXES])).select("request", "_v", "lo", "hi", "_key")
    met = chunks.join(r, (F.col("vol_id") == F.col("_v")) & (F.col("key") == F.col("_key")))
    return met.select("request", "vol_id", "dims", *AXES, "lo", "hi", "data").mapInArrow(_cropped(side), _PART)


def assembled(parts: dict | pa.Table, fill: float = 0.0) -> np.ndarray:
    """One box from its parts: a task's own array, as large as the box."""
    size = parts["dims"][0].as_py()
    out = np.full(size[::-1], fill)
    for ori, shape, data in zip(parts["ori"].to_pylist(), parts["shape"].to_pylist(), parts["data"]):
        out[tuple(slice(o, o + n) for o, n in zip(ori, shape))[::-1]] = data.values.to_numpy(zero_copy_only=False).reshape(shape[::-1])
    return out


# --- filters, differences, maxima, levels ------------------------------------------------------------------


def _reach(*filters: list[float] | None) -> int:
    return max((len(k) // 2 for k in filters if k), default=0)


def _extended(v: np.ndarray, before: list[int], behind: list[int], reach: int) -> np.ndarray:
    """Surroundings with the volume's edge going on, so that every chunk has `reach` voxels on each side."""
    return np.pad(v, [(reach - a, reach - b) for a, b in zip(before, behind)][::-1], mode="edge")


def _core(v: np.ndarray, reach: int) -> np.ndarray:
    return v[tuple(slice(reach, n - reach) for n in v.shape)]


def filtered(chunks: DataFrame, side: int, filters: list[list[float] | None], fill: float = 0.0) -> DataFrame:
    """Separable filters for x, y, z (None leaves an axis alone), equal to filtering whole volumes."""
    reach = _reach(*filters)

    def task(c: dict, v: np.ndarray, before: list[int], behind: list[int]) -> pa.Table:
        return _chunk_row(c, _core(kernels.separable(_extended(v, before, behind, reach), filters), reach))

    return exchange(blocks_of(chunks, side), side, reach, task, CHUNK, fill)


def dog(chunks: DataFrame, side: int, r1: float = 2.0, r2: float = 3.0, fill: float = 0.0) -> DataFrame:
    """Differences of Gaussians; both filters work on one exchange."""
    reach = _reach(kernels.point_kernel(r1), kernels.point_kernel(r2))

    def task(c: dict, v: np.ndarray, before: list[int], behind: list[int]) -> pa.Table:
        return _chunk_row(c, _core(kernels.dog(_extended(v, before, behind, reach), r1, r2), reach))

    return exchange(blocks_of(chunks, side), side, reach, task, CHUNK, fill)


POINT = "vol_id bigint, x int, y int, z int, intensity double"


def points(chunks: DataFrame, side: int, threshold: float, r1: float = 2.0, r2: float = 3.0, fill: float = 0.0) -> DataFrame:
    """Voxels of the difference of Gaussians over the threshold that no neighbour of 26 exceeds, in voxels of the volume.

    Rims reach one voxel further than the filters, so that the differences of all neighbours are known: one shuffle in all.
    """
    far = _reach(kernels.point_kernel(r1), kernels.point_kernel(r2))

    def task(c: dict, v: np.ndarray, before: list[int], behind: list[int]) -> pa.Table:
        d = _core(kernels.dog(_extended(v, before, behind, far + 1), r1, r2), far)
        for k in range(3):  # beyond the volume's end there is no neighbour
            at = [slice(None)] * 3
            if before[k] == 0:
                at[2 - k] = slice(0, 1)
                d[tuple(at)] = -np.inf
            if behind[k] == 0:
                at[2 - k] = slice(d.shape[2 - k] - 1, None)
                d[tuple(at)] = -np.inf
        p = kernels.maxima(d, threshold)
        inside = np.all((p[:, :3] >= 1) & (p[:, :3] < np.array(d.shape[::-1]) - 1), axis=1)
        p = p[inside]
        where = p[:, :3].astype(np.int64) - 1 + np.array([c[a] for a in AXES]) * side
        names = ["vol_id", "x", "y", "z", "intensity"]
        return pa.table([pa.array([c["vol_id"]] * len(p), pa.int64()), *[pa.array(where[:, k].astype(np.int32)) for k in range(3)], pa.array(p[:, 3])], names=names)

    return exchange(blocks_of(chunks, side), side, far + 1, task, POINT, fill)


def halved(chunks: DataFrame, side: int, fill: float = 0.0) -> DataFrame:
    """The next pyramid level: means over 2 x 2 x 2 voxels (those that exist, at an odd end). Chunks shrink where they are; the shuffle moves an eighth of the voxels."""
    if side % 2:
        raise ValueError("a side must be even to be halved")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, cut = [], []
            for at in range(b.num_rows):
                r = {n: b.column(n)[at].as_py() for n in ("vol_id", "dims", "ori", "shape")}
                v = b.column("data")[at].values.to_numpy(zero_copy_only=False).reshape(r["shape"][::-1])
                pad = [(0, n % 2) for n in v.shape]
                total, n = np.pad(v, pad), np.pad(np.ones(v.shape), pad)
                for k in range(3):
                    total, n = (np.add.reduceat(x, np.arange(0, x.shape[k], 2), axis=k) for x in (total, n))
                cut.append(total / n)
                rows.append((r["vol_id"], [-(-n // 2) for n in r["dims"]], [o // 2 for o in r["ori"]], list(cut[-1].shape[::-1])))
            triple = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*[pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int64(), triple, triple, triple])], _lists(cut, pa.float64())], names=["vol_id", "dims", "ori", "shape", "data"])

    return chunked(blocks_of(chunks, side), side, fill, task)
