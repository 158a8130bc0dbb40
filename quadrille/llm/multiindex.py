"""Approximate nearest neighbours by multi-index hashing.

Vectors become codes of 64 bits: the signs of centred vectors after a rotation that is learned (principal axes, then
the rotation that brings signs and values together) on a bounded sample. A code is eight substrings of eight bits, each of which has
an index of its own from value to rows. If two codes differ in at most R = 8 r + e bits, then one of the first e + 1 substrings
differs in at most r bits or one of the others in at most r - 1; so probing the values within these distances retrieves
every code within R. The codes retrieved are tested on all bits, and the distance of the original vectors orders what stays.

The index is kept in segments of about SEGMENT rows, dealt by a hash, so that no bucket of equal codes can be large, however
many copies a vector has; every query goes to every segment and leaves with its first few there. No bucket is capped. R is the least
radius that holds COVER of the ten nearest neighbours within the sample (neighbours in the whole table are nearer still).
Where a segment holds fewer codes within R than neighbours are asked for, R grows for that query there, up to all rows.

Vectors that are null, zero or hold a null or non-finite component take no part, nor do rows without id. A row is not a neighbour
of itself; rows that repeat are neighbours of each other. Shorter vectors count as filled up with zeros. Ties go to the
smaller id. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, stage
from .hardneg import finite

BITS, PART = 64, 8
SEGMENT = 4096
SAMPLE_ROWS, SAMPLE_NUMBERS = 20_000, 4_000_000  # rows of the sample, and components in all
SAMPLE_QUERIES, COVER = 512, 0.99
ROUNDS = 30

_POP = np.bitwise_count(np.arange(256, dtype=np.uint8))
_MASKS = [np.flatnonzero(r >= _POP).astype(np.uint8) for r in range(PART + 1)]
_FOUND = "query bigint, query_id bigint, uid bigint, id bigint, score double"


@dataclass
class Coder:
    """Mean, the 64 learned directions (columns), and the radius."""

    mean: np.ndarray
    turn: np.ndarray
    radius: int = BITS

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The eight substrings of each row's code."""
        return np.packbits((x - self.mean) @ self.turn > 0, axis=1)


def rotation(x: np.ndarray, seed: int) -> np.ndarray:
    """Directions of centred rows: principal axes, turned so that values lie near their signs (alternating between signs and the best rotation)."""
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :BITS]
    v = x @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((v.shape[1],) * 2))[0]
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
        turn = (left @ right).T
    return axes @ turn


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to one vector, in double precision."""
    with np.errstate(over="ignore"):
        return np.sqrt(np.square(x - q).sum(axis=1))


def fit(sample: np.ndarray, top: int) -> Coder:
    """Directions and radius from a sample of vectors."""
    sample = np.clip(sample, -1e100, 1e100)
    n, dims = sample.shape
    if n < 2 or not dims:
        return Coder(np.zeros(dims), np.zeros((dims, BITS)))
    mean = sample.mean(axis=0)
    coder = Coder(mean, np.hstack([rotation(sample - mean, s) for s in range(-(-BITS // dims))])[:, :BITS])
    codes = coder.codes(sample).view(np.uint64).ravel()
    far = []
    for q in range(min(n, SAMPLE_QUERIES)):
        d = distances(sample, sample[q])
        d[q] = np.inf
        near = np.argpartition(d, min(top, n - 1) - 1)[: min(top, n - 1)]
        far.append(np.bitwise_count(codes[near] ^ codes[q]))
    coder.radius = int(np.quantile(np.concatenate(far), COVER, method="higher"))
    return coder


class Segment:
    """Some rows, and for each substring an index from its value to the rows that have it."""

    def __init__(self, coder: Coder, uid: np.ndarray, ids: np.ndarray, x: np.ndarray):
        self.uid, self.ids, self.x = uid, ids, x
        parts = coder.codes(x)
        self.codes = parts.view(np.uint64).ravel()
        self.order = [np.argsort(parts[:, k], kind="stable") for k in range(PART)]
        self.count = [np.bincount(parts[:, k], minlength=256) for k in range(PART)]
        self.start = [np.cumsum(c) - c for c in self.count]

    def within(self, parts: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code differs from this one in at most so many bits."""
        r, extra = divmod(min(radius, BITS), PART)
        hit = np.zeros(len(self.uid), bool)
        for k in range(PART):
            reach = r if k <= extra else r - 1
            if reach < 0:
                continue
            probe = parts[k] ^ _MASKS[min(reach, PART)]
            n = self.count[k][probe]
            at = np.repeat(self.start[k][probe] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            hit[self.order[k][at]] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.codes[rows] ^ parts.view(np.uint64)[0]) <= radius]

    def nearest(self, uid: int, q: np.ndarray, parts: np.ndarray, radius: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest rows retrieved and their distances. The radius grows until it holds enough rows."""
        while True:
            rows = self.within(parts, radius)
            rows = rows[self.uid[rows] != uid]
            if len(rows) >= top or radius >= BITS:
                break
            radius += PART // 2
        d = distances(self.x[rows], q)
        if len(d) > 4 * top:
            near = d <= np.partition(d, top - 1)[top - 1]
            rows, d = rows[near], d[near]
        order = np.lexsort((self.uid[rows], self.ids[rows], d))[:top]
        return rows[order], d[order]


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    values, size = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(lists.offsets.to_numpy())
    if (size == dims).all():
        return values.reshape(len(size), dims)
    out = np.zeros((len(size), dims))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def _searched(coder: Coder, dims: int, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come sorted by segment, the indexed ones before the queries: a segment is built once and queries stream through it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, segment = None, [], None
        for batch in batches:
            i, kind = batch.column("i").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(i) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(i)]):
                if a == b:
                    continue
                if i[a] != now:
                    now, held, segment = i[a], [], None
                uid, ids = batch.column("uid").to_numpy()[a:b], batch.column("id").to_numpy()[a:b]
                x = _matrix(batch.column("v").slice(a, b - a), dims)
                if kind[a] == 0:
                    held.append((uid, ids, x))
                    continue
                if segment is None and held:
                    segment, held = Segment(coder, *(np.concatenate(c) for c in zip(*held))), []
                if segment is None:
                    continue
                parts = coder.codes(x)
                out = [segment.nearest(u, q, p, coder.radius, top) for u, q, p in zip(uid, x, parts)]
                n = np.array([len(r) for r, _ in out])
                rows = np.concatenate([r for r, _ in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(uid, n)), pa.array(np.repeat(ids, n)), pa.array(segment.uid[rows]), pa.array(segment.ids[rows]), pa.array(np.concatenate([d for _, d in out]))],
                    names=["query", "query_id", "uid", "id", "score"],
                )

    return task


def search(vectors: DataFrame, queries: Column, top: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for each query row. vectors: vec_id, embedding; queries is said on them."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("v"), queries.alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & finite("v")).where(F.exists("v", lambda x: x != 0))
    rows = stage(rows.withColumn("uid", F.monotonically_increasing_id()))
    n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).head()
    segments = max(1, -(-n // SEGMENT))
    # a sample of bounded size, the same whatever the partitions
    sample = rows.select("id", "v").orderBy(F.xxhash64("id", "v"), "id").limit(min(SAMPLE_ROWS, max(1, SAMPLE_NUMBERS // max(dims, 1)))).select("v").toArrow()["v"].combine_chunks()
    coder = fit(_matrix(sample, dims), top)
    index = rows.select(F.pmod(F.xxhash64("uid"), F.lit(segments)).cast("int").alias("i"), F.lit(0).alias("kind"), "uid", "id", "v")
    asked = rows.where("asked").select(F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("i"), F.lit(1).alias("kind"), "uid", "id", "v")
    met = index.unionByName(asked).repartition(segments, "i").sortWithinPartitions("i", "kind", "uid").mapInArrow(_searched(coder, dims, top), _FOUND)
    w = Window.partitionBy("query").orderBy("score", "id", "uid")
    best = met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    out = stage(best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"))
    drop(rows)
    return out
