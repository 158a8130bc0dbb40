"""Chunked volumes against whole arrays."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quadrille.functions import kernels
from quadrille.operators import align, chunks
from quadrille.sources import tables

SHAPES = [(17, 9, 12), (5, 3, 2), (8, 8, 8), (1, 20, 7)]  # x first


def arrays(seed=1):
    rnd = np.random.default_rng(seed)
    return {k: rnd.normal(size=s[::-1]) for k, s in enumerate(SHAPES)}


def as_blocks(spark, found, cut=4):
    rows = []
    for k, v in found.items():
        dims = list(v.shape[::-1])
        for z in range(0, dims[2], cut):
            for y in range(0, dims[1], cut):
                for x in range(0, dims[0], cut):
                    b = v[z : z + cut, y : y + cut, x : x + cut]
                    rows.append((k, dims, [x, y, z], list(b.shape[::-1]), b.ravel().tolist()))
    return spark.createDataFrame(rows, chunks.BLOCK)


def whole(df, side, found, fill=np.nan):
    out = {k: np.full(v.shape, fill) for k, v in found.items()}
    for r in chunks.voxels(df, side).collect():
        out[r.vol_id][r.z, r.y, r.x] = r.v
    return out


@pytest.fixture(scope="module")
def made(spark):
    return arrays()


@pytest.mark.parametrize("side", [3, 5, 8, 32])
def test_chunks_hold_the_volumes(spark, made, side):
    c = chunks.chunked(as_blocks(spark, made), side)
    assert all((whole(c, side, made)[k] == v).all() for k, v in made.items())
    if side < 32:
        assert max(r[0] for r in c.select(F.size("data")).collect()) <= side**3
    again = chunks.rechunked(c, side, 4)
    assert all((whole(again, 4, made)[k] == v).all() for k, v in made.items())


@pytest.mark.parametrize("side,sigma", [(8, 1.0), (4, 1.5), (2, 1.5), (32, 1.0)])
def test_filters_equal_those_of_whole_volumes(spark, made, side, sigma):
    """Also where a filter reaches over several chunks."""
    c = chunks.chunked(as_blocks(spark, made), side)
    k = kernels.gauss(sigma)
    for filters in ([k, k, k], [None, k, None], [k, None, kernels.gauss(0.7)]):
        got = whole(chunks.filtered(c, side, filters), side, made)
        assert all(np.allclose(got[n], kernels.separable(v, filters), atol=1e-12) for n, v in made.items())


@pytest.mark.parametrize("side", [4, 8, 32])
def test_points_equal_those_of_whole_volumes(spark, made, side):
    c = chunks.chunked(as_blocks(spark, made), side)
    got = sorted((r.vol_id, r.x, r.y, r.z, round(r.intensity, 9)) for r in chunks.points(c, side, 0.02).collect())
    want = sorted((n, *[int(i) for i in p[:3]], round(float(p[3]), 9)) for n, v in made.items() for p in kernels.maxima(kernels.dog(v), 0.02))
    assert got == want and len(want) > 10
    assert all(np.allclose(whole(chunks.dog(c, side), side, made)[n], kernels.dog(v)) for n, v in made.items())


def test_missing_chunks_and_halving(spark, made):
    c = chunks.chunked(as_blocks(spark, made), 4).where("not (cx = 1 and cy = 0)")
    have = {k: v.copy() for k, v in made.items()}
    for v in have.values():
        v[:, 0:4, 4:8] = 7.0
    full = chunks.dense(c, 4, 7.0)
    assert all((whole(full, 4, made)[k] == v).all() for k, v in have.items())
    g = kernels.gauss(1.0)
    got = whole(chunks.filtered(full, 4, [g] * 3), 4, made)
    assert all(np.allclose(got[n], kernels.separable(v, [g] * 3)) for n, v in have.items())
    half = {k: np.array([[[v[2 * z : 2 * z + 2, 2 * y : 2 * y + 2, 2 * x : 2 * x + 2].mean() for x in range(-(-v.shape[2] // 2))] for y in range(-(-v.shape[1] // 2))] for z in range(-(-v.shape[0] // 2))]) for k, v in have.items()}
    got = whole(chunks.halved(full, 4), 4, half)
    assert all(np.allclose(got[k], v) for k, v in half.items())
    with pytest.raises(ValueError):
        chunks.halved(full, 5)
    assert chunks.points(c.limit(0), 4, 0.0).count() == 0


def test_keys():
    rnd = np.random.default_rng(4)
    code = lambda c: sum(((c[d] >> k) & 1) << (3 * k + d) for d in range(3) for k in range(21))
    for _ in range(40):
        low = rnd.integers(0, 40, 3)
        high = low + rnd.integers(0, 9, 3)
        for most in (1, 9, 64, 4096):
            found = chunks.key_ranges(tuple(low.tolist()), tuple(high.tolist()), most)
            assert len(found) <= max(most, 8) and all(a <= b for a, b in found) and all(x[1] < y[0] for x, y in zip(found, found[1:]))
            inside = [code((x, y, z)) for x in range(low[0], high[0] + 1) for y in range(low[1], high[1] + 1) for z in range(low[2], high[2] + 1)]
            assert all(any(a <= k <= b for a, b in found) for k in inside)
            if most == 4096:
                assert sum(b - a + 1 for a, b in found) == len(inside)


def test_column_key(spark):
    rows = [(0, 0, 0), (1, 2, 3), (2**21 - 1, 2**20, 12345), (5, 0, 7)]
    df = spark.createDataFrame(rows, "x int, y int, z int")
    code = lambda c: sum(((c[d] >> k) & 1) << (3 * k + d) for d in range(3) for k in range(21))
    assert [r[0] for r in df.select(chunks.morton(F.col("x"), F.col("y"), F.col("z"))).collect()] == [code(r) for r in rows]


def test_boxes_read_their_chunks(spark, made, tmp_path):
    folder = str(tmp_path / "stored")
    chunks.store(chunks.chunked(as_blocks(spark, made), 4), folder)
    stored = chunks.stored(spark, folder)
    for ori, shape in (([3, 2, 1], [6, 5, 9]), ([-2, 6, 4], [9, 30, 3]), ([0, 0, 0], [1, 1, 1])):
        parts = chunks.read_box(stored, 4, ori, shape)
        got = {}
        for r in parts.toPandas().groupby("vol_id"):
            got[r[0]] = r[1]
        for k, v in made.items():
            cut = tuple(slice(max(o, 0), max(o + n, 0)) for o, n in zip(ori, shape))[::-1]
            want = v[cut]
            if not want.size:
                assert k not in got
                continue
            out = np.full(got[k]["dims"].iloc[0][::-1], np.nan)
            for p in got[k].itertuples():
                out[tuple(slice(o, o + n) for o, n in zip(p.ori, p.shape))[::-1]] = np.array(p.data).reshape(p.shape[::-1])
            assert out.shape == want.shape and (out == want).all()
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = chunks.read_box(stored, 4, [3, 2, 1], [6, 5, 9], F.col("vol_id") == 1)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(vol_id,1)" in plan and "GreaterThanOrEqual(key," in plan and "LessThanOrEqual(cx," in plan


def test_requests(spark, made):
    c = chunks.chunked(as_blocks(spark, made), 4)
    asked = [(1, 0, [3, 2, 1], [6, 5, 9]), (2, 0, [3, 2, 1], [6, 5, 9]), (3, 3, [-1, 5, 2], [9, 9, 2]), (4, 1, [50, 0, 0], [2, 2, 2]), (5, 9, [0, 0, 0], [2, 2, 2]), (6, 2, [0, 0, 0], [0, 2, 2]), (7, 2, [-5, 0, 0], [5, 2, 2])]
    rows = chunks.read_boxes(c, 4, spark.createDataFrame(asked, "request long, vol_id long, ori array<int>, shape array<int>"))
    got = rows.groupBy("request").applyInArrow(lambda t: __import__("pyarrow").table({"request": t["request"][:1], "v": [chunks.assembled(t).ravel().tolist()]}), "request bigint, v array<double>").collect()
    cut = lambda v, o, n: v[tuple(slice(max(a, 0), a + b) for a, b in zip(o, n))[::-1]]
    assert {r.request: r.v for r in got} == {q: cut(made[k], o, n).ravel().tolist() for q, k, o, n in asked if q in (1, 2, 3)}


def test_planted_shifts(spark):
    """Tiles of a scene with masked voxels, cut beside their places."""
    rnd = np.random.default_rng(7)
    scene = rnd.normal(size=(18, 20, 60))
    scene[rnd.random(scene.shape) < 0.1] = -5.0  # below the threshold: masked
    moved = {0: (0, 0, 0), 1: (1, -1, 0), 2: (-1, 0, 2), 3: (0, 1, -1)}
    found, boxes = {}, []
    for k, (dx, dy, dz) in moved.items():
        x, y, z = 3 + 12 * k + dx, 3 + dy, 3 + dz
        found[k] = scene[z : z + 12, y : y + 14, x : x + 20]
        boxes.append((k, 12 * k, 0, 0, 20, 14, 12, 12 * k + 20, 14, 12))
    tiles = spark.createDataFrame(boxes, "id long, " + ", ".join(f"{c}{d} long" for c in "ose" for d in range(3)))
    got = align.aligned(tiles, chunks.chunked(as_blocks(spark, found), 8), 8, -4.0, 100).collect()
    assert {(r.a, r.b): (r.dx, r.dy, r.dz) for r in got} == {(k, k + 1): tuple(b - a for a, b in zip(moved[k], moved[k + 1])) for k in range(3)}
    assert all(r.peak > 0.99 for r in got)


def test_python_workers_are_few_and_small(spark):
    """Halving needs one worker in a task of the map side; workers under written() get a bounded number of bytes at a time."""
    plan = chunks.halved(spark.createDataFrame([], chunks.CHUNK), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["size", "rows"])

    rows = spark.range(4000).coalesce(1).select(F.array_repeat(F.col("id").cast("double"), 512).alias("v"))  # 16 MB
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    got = tables.written(rows.mapInArrow(sizes, "size long, rows long")).collect()
    assert sum(r.rows for r in got) == 4000 and max(r.size for r in got) < 6 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
