"""Hard negatives by a two-dimensional block matrix multiply.

Rows and anchors are dealt into blocks and their components into chunks. The task of (row block, anchor block, chunk)
multiplies two small matrices; the partial tiles of whole numbers are shuffled by (row block, anchor block), added, and
reduced where they meet: each tile keeps, per anchor or per anchor and positive, no more rows than are asked for. Windows
with a limit then pick the first among the tiles' own first.

Two products are made. The first one meets only blocks whose labels fall into one bucket, and yields the positives; the second one
meets all blocks, and yields what lies in the window of each positive.

Rows stand for themselves: rows that repeat are several candidates, and several anchors; ties that the id leaves go in any
fixed order. Rows without id, label or vector, or with a null or non-finite component, take no part; an empty vector
scores 0, a shorter one counts as filled up with zeros. Scores whose hundredfold might pass 64 bits raise an error. Other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, stage

BLOCK, ANCHORS = 1024, 256  # rows and anchors of a block: a tile has 2 MB at most
CHUNK, CHUNKS = 32, 16  # components of a chunk at least, chunks at most
BUCKETS = 64  # of labels
_LOW = -(1 << 62)  # below every score

_TILE = "i int, j int, k int, tile binary, row_meta binary, anchor_meta binary, positives binary"
_POSITIVE = "anchor bigint, anchor_id bigint, uid bigint, id bigint, score bigint"
_NEGATIVE = "anchor bigint, anchor_id bigint, positive bigint, positive_id bigint, positive_score bigint, uid bigint, id bigint, score bigint"


def finite(vector: str | Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    v = F.col(vector) if isinstance(vector, str) else vector
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & good, F.lit(False))


def quantised(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component, as a whole number."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix, filled up with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values, size = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    if (size == width).all():
        return values.reshape(len(size), width)
    out = np.zeros((len(size), width), values.dtype)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exactly: in doubles where every sum fits, else in 64-bit whole numbers."""
    most = max(1, a.shape[1]) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _partial(width: int, dims: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The tile of one chunk; the first chunk also carries who the rows and the anchors are."""

    def task(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        columns: dict[str, list] = {n: [] for n in ("i", "j", "k", "tile", "row_meta", "anchor_meta", "positives")}
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by([("id", "ascending"), ("uid", "ascending")])
            anchors = anchors.sort_by("uid")
            a, b = _matrix(anchors["q"], width), _matrix(rows["q"], width)
            if max(1, dims) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * 100 >= 1 << 63:
                raise OverflowError("hard negatives: components are too large for scores of 64 bits")
            k = rows["k"][0].as_py()
            meta = lambda t: np.stack([t[c].to_numpy() for c in ("uid", "id", "label")]).astype(np.int64).tobytes()
            columns = {
                "i": [rows["i"][0].as_py()], "j": [rows["j"][0].as_py()], "k": [k], "tile": [product(a, b).tobytes()],
                "row_meta": [meta(rows) if k == 0 else None], "anchor_meta": [meta(anchors) if k == 0 else None],
                "positives": [_positive_block(anchors["positives"]) if k == 0 else None],
            }
        kinds = dict(zip(columns, [pa.int32()] * 3 + [pa.binary()] * 4))
        return pa.table({n: pa.array(v, kinds[n]) for n, v in columns.items()})

    return task


def _positive_block(column: pa.ChunkedArray) -> bytes:
    """(anchor number, uid, id, score) of every positive of a block's anchors."""
    out = [(n, p["uid"], p["id"], p["score"]) for n, found in enumerate(column.to_pylist()) for p in found or ()]
    return np.array(out, np.int64).reshape(-1, 4).tobytes()


def _added(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sum of a tile's parts (anchors by rows), and the meta columns of rows, anchors and positives."""
    first = t["k"].to_pylist().index(0)
    of = lambda name: np.frombuffer(t[name][first].as_py(), np.int64)
    rows, anchors = of("row_meta").reshape(3, -1), of("anchor_meta").reshape(3, -1)
    total = np.zeros((anchors.shape[1], rows.shape[1]), np.int64)
    for part in t["tile"]:
        total += np.frombuffer(part.as_buffer(), np.int64).reshape(total.shape)
    return total, rows, anchors, of("positives").reshape(-1, 4)


def _columns(schema: str, values: list[np.ndarray]) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.table({n: pa.array(v.astype(np.int64)) for n, v in zip(names, values)})


def _best_positives(most: int) -> Callable[[pa.Table], pa.Table]:
    """Per anchor the first rows of its label, itself left out. Rows are sorted by id, so a stable sort settles ties."""

    def task(t: pa.Table) -> pa.Table:
        s, rows, anchors, _ = _added(t)
        s[(rows[2][None, :] != anchors[2][:, None]) | (rows[0][None, :] == anchors[0][:, None])] = _LOW
        order = np.argsort(-s, axis=1, kind="stable")[:, :most]
        score = np.take_along_axis(s, order, 1)
        a, c = np.nonzero(score > _LOW)
        r = order[a, c]
        return _columns(_POSITIVE, [anchors[0][a], anchors[1][a], rows[0][r], rows[1][r], score[a, c]])

    return task


def _best_negatives(most: int, low: int, high: int) -> Callable[[pa.Table], pa.Table]:
    """Per anchor and positive the first rows of other labels with low * p <= 100 * n <= high * p."""

    def task(t: pa.Table) -> pa.Table:
        s, rows, anchors, positives = _added(t)
        s[rows[2][None, :] == anchors[2][:, None]] = _LOW
        order = np.argsort(-s, axis=1, kind="stable")
        s = np.take_along_axis(s, order, 1)
        n, p = positives[:, 0], positives[:, 3]
        # scores fall along a row: those above the window come first
        began = np.array([np.searchsorted(-s[a], -((high * v) // 100), "left") for a, v in zip(n.tolist(), p.tolist())], np.int64)
        at = began[:, None] + np.arange(most)
        inside = at < s.shape[1]
        at = np.minimum(at, s.shape[1] - 1)
        score = s[n[:, None], at]
        inside &= score > _LOW
        inside[inside] = (100 * score >= low * p[:, None])[inside]
        w, c = np.nonzero(inside)
        r = order[n[w], at[w, c]]
        return _columns(_NEGATIVE, [anchors[0][n[w]], anchors[1][n[w]], positives[w, 1], positives[w, 2], p[w], rows[0][r], rows[1][r], score[w, c]])

    return task


def _first(df: DataFrame, by: list[str], most: int, rank: str = "rank") -> DataFrame:
    """The first rows by score, then id. A window with a limit: each task passes on no more than the limit per key."""
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "uid")
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= most)


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors: vec_id, label, q (whole numbers). anchors: which rows are anchors, said on those columns.
    An anchor's positives are its first other rows of the same label; its negatives for a positive of score p are the first rows of
    other labels whose score n has low * p <= 100 * n <= high * p.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), F.col("q").cast("array<bigint>").alias("q"), anchors.alias("is_anchor"))
    rows = rows.where("id is not null and label is not null and q is not null")
    rows = stage(rows.select("*", F.monotonically_increasing_id().alias("uid"), F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int").alias("h")))
    # at most BUCKETS rows
    sizes = {r["h"]: r for r in rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("a"), F.max(F.size("q")).alias("d")).collect()}
    of = lambda h, f: sizes[h][f] if h in sizes else 0
    blocks = [-(-of(h, "n") // BLOCK) for h in range(BUCKETS)]
    own = [-(-of(h, "a") // ANCHORS) for h in range(BUCKETS)]
    dims = max([of(h, "d") for h in range(BUCKETS)])
    width = max(CHUNK, -(-dims // CHUNKS))
    chunks, groups = max(1, -(-dims // width)), max(1, -(-sum(of(h, "a") for h in range(BUCKETS)) // ANCHORS))
    first = lambda counts: [sum(counts[:h]) for h in range(BUCKETS)]
    at = lambda values: F.element_at(F.lit(values), F.col("h") + 1)
    dealt = lambda counts, seed: (at(first(counts)) + F.pmod(F.xxhash64("uid", F.lit(seed)), F.greatest(at(counts), F.lit(1)))).cast("int")
    span = lambda low, n: F.explode(F.sequence(low.cast("int"), (low + n - 1).cast("int")))

    def cut(df: DataFrame) -> DataFrame:
        """A row per chunk of components."""
        df = df.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        return df.withColumn("q", F.slice("q", F.col("k") * width + 1, width))

    def tiles(left: DataFrame, right: DataFrame) -> DataFrame:
        key = ["i", "j", "k"]
        left = cut(left.select("i", "j", "uid", "id", "label", "q"))
        right = cut(right.select("i", "j", "uid", "id", "label", "q", "positives"))
        right = right.select(*[F.col(c).alias(c) for c in right.columns])  # both sides come from one table: columns of their own
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_partial(width, dims), _TILE)

    none = F.lit(None).cast("array<struct<uid:bigint,id:bigint,score:bigint>>")
    asked = rows.where("is_anchor")
    block = rows.withColumn("i", dealt(blocks, 0))
    same = tiles(
        block.where(at(own) > 0).withColumn("j", span(at(first(own)), at(own))),
        asked.withColumn("j", dealt(own, 1)).withColumn("i", span(at(first(blocks)), at(blocks))).withColumn("positives", none),
    )
    best = _first(same.groupBy("i", "j").applyInArrow(_best_positives(positives), _POSITIVE), ["anchor"], positives)
    lists = stage(best.groupBy("anchor").agg(F.collect_list(F.struct("uid", "id", "score")).alias("positives")))  # as many as asked for, at most
    have = asked.join(lists.withColumnRenamed("anchor", "uid"), "uid")
    every = tiles(
        block.withColumn("j", span(F.lit(0), F.lit(groups))),
        have.withColumn("j", F.pmod(F.xxhash64("uid", F.lit(2)), F.lit(groups)).cast("int")).withColumn("i", span(F.lit(0), F.lit(max(1, sum(blocks))))),
    )
    found = _first(every.groupBy("i", "j").applyInArrow(_best_negatives(negatives, low, high), _NEGATIVE), ["anchor", "positive"], negatives)
    out = stage(found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    drop(rows)
    drop(lists)
    return out
