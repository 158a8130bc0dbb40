"""Entries that no query calls: a render run and one target, stored nodes, sub-arrays of files, copies, built catalogues, compaction, the depth limit, existence."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.functions import aabb
from quadrille.operators import boxindex, boxjoin, catalog, octree, render
from quadrille.sources import tiletree, volumes, yamlcache
from quadrille.streaming import ingest


def tiles(spark, folder, n=3):
    """Tiles of 4 x 4 x 4 voxels of 1000 nm in a row, with their files."""
    rnd, rows, found = np.random.default_rng(5), [], []
    for k in range(n):
        v = rnd.normal(size=(4, 4, 4))
        path = f"{folder}/{k}.npy"
        np.save(path, v)
        found.append(v)
        m = [float(x) for x in (1000, 0, 0, 4000 * k, 0, 1000, 0, 0, 0, 0, 1000, 0, 0, 0, 0, 1)]
        rows.append((k, path, 4000 * k, 0, 0, 4000, 4000, 4000, 4000 * k + 4000, 4000, 4000, m))
    schema = "id long, path string, " + ", ".join(f"{c}{d} long" for c in "ose" for d in range(3)) + ", transform array<double>"
    return spark.createDataFrame(rows, schema), found


def test_a_render_run_and_one_target(spark, tmp_path):
    t, found = tiles(spark, str(tmp_path))
    options = render.Options(voxel_um=(1.0, 1.0, 1.0), leaf="100", input_threshold=9.0)
    every = {r.addr: r for r in render.run(t, np.load, options).collect()}
    whole = np.concatenate(found, axis=2)
    assert every[0].depth == 0 and list(every[0].shape) == [12000, 4000, 4000] and max(r.depth for r in every.values()) >= 1
    for r in every.values():
        if r.depth == max(x.depth for x in every.values()):
            at = [round(o / 1000) for o in r.ori]
            size = list(r.dims)
            want = whole[at[2] : at[2] + size[2], at[1] : at[1] + size[1], at[0] : at[0] + size[0]]
            assert np.allclose(np.array(r["values"]).reshape(size[::-1]), want, atol=1e-5)
    target = next(a for a, r in every.items() if r.depth == 1)
    one = render.run(t, np.load, render.Options(voxel_um=(1.0, 1.0, 1.0), leaf="100", input_threshold=9.0, target=target)).collect()
    assert [r.addr for r in one] == [target] and np.allclose(one[0]["values"], every[target]["values"])
    tree = octree.nodes(spark, [0, 0, 0], [12000, 4000, 4000], (1000.0,) * 3, 100, 8, t)
    kids = spark.createDataFrame([tuple(r) for r in every.values()], render.NODE)
    assert np.allclose(render.target(kids, tree, 0).collect()[0]["values"], every[0]["values"])
    render.save(kids, str(tmp_path / "nodes"))
    assert np.allclose(render.stored(spark, str(tmp_path / "nodes"), target).head()["values"], every[target]["values"])
    assert render.cropped(found[0], [2, 3, 4]).shape == (4, 3, 2) and render.cropped(found[0], [2, 3]) is found[0]
    for wrong in ({"children": 3}, {"at": (2.0, 0, 0)}, {"voxel_um": (0, 1, 1)}, {"target": 190}):
        with pytest.raises(ValueError):
            render.Options(**wrong)


def test_boxes_of_volume_files(tmp_path):
    v = np.random.default_rng(1).integers(0, 999, (6, 5, 7)).astype(np.uint16)
    np.save(tmp_path / "a.npy", v)
    (tmp_path / "a.tif").write_bytes(volumes.encode_tiff(v))
    (tmp_path / "a.raw").write_bytes(v.tobytes())
    for name in ("a.npy", "a.tif", "a.raw"):
        got = volumes.read_box(str(tmp_path / name), [2, 1, 3], [4, 3, 2], [7, 5, 6])
        assert (got == v[3:5, 1:4, 2:6]).all()


def test_copies_and_catalogues(spark, tmp_path):
    from test_files import tile

    root = str(tmp_path / "root")
    for k in range(3):
        tile(f"{root}/x/{k:05d}", k + 1)
    assert tiletree.build(spark, root, str(tmp_path / "cat")) == 3
    texts = spark.read.text(str(tmp_path / "cat"), wholetext=True).collect()
    assert sorted(p[0] for t in texts for p in yamlcache.parse(t.value)) == [f"{root}/x/{k:05d}" for k in range(3)]
    done = tiletree.copy(spark, root, str(tmp_path / "copy")).collect()
    assert len(done) == 9
    for r in done:
        assert open(r.copy, "rb").read() == open(r.file.removeprefix("file:") if hasattr(r, "file") else r.path, "rb").read() and os.path.getsize(r.copy) == r.bytes
    assert tiletree.scan(spark, str(tmp_path / "copy")).where("error is null").count() == 3


def test_rows_and_boxes(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "path string, seq long")
    assert sorted(r.path for r in catalog.union_all(rows, rows.where("seq = 1"), rows.limit(0)).collect()) == ["a", "a", "b"]
    assert [r.path for r in catalog.top_k(rows, [F.desc("seq")], 1).collect()] == ["b"]
    for k, seq in enumerate((1, 3)):
        rows.withColumn("seq", F.col("seq") + seq).write.parquet(str(tmp_path / f"cat/epoch={k}"))
    assert sorted((r.path, r.seq) for r in ingest.compact(spark, str(tmp_path / "cat")).collect()) == [("a", 4), ("b", 5)]
    box = spark.createDataFrame([(([10, 20, 30], [100, 200, 300]), ([-11, 21, -13], [50, 60, 70])), (([38, 81, 56], [100, 200, 300]), ([-11, 21, -13], [50, 60, 70]))], f"a {aabb.BOX}, b {aabb.BOX}")
    assert [r[0] for r in box.select(aabb.hit(F.col("a"), F.col("b"))).collect()] == [True, False]


def test_depth_limit(spark):
    t = spark.createDataFrame([(0, 0, 0, 0, 1, 1, 1)], "id long, o0 long, o1 long, o2 long, e0 long, e1 long, e2 long")
    for given in (t, None):
        with pytest.raises(ValueError, match="an address"):
            octree.nodes(spark, [0, 0, 0], [1 << 21] * 3, (1, 1, 1), 2, 8, given)
    assert {r.depth for r in octree.nodes(spark, [0, 0, 0], [1 << 18] * 3, (1, 1, 1), 2, 8, t).collect()} == set(range(19))


@pytest.mark.parametrize("seed", [1, 2])
def test_existence_and_index(spark, tmp_path, seed):
    """Boxes of very different sizes, without extent, negative and repeated ones, against all pairs."""
    rnd = random.Random(seed)
    def boxes(n, far):
        out = []
        for k in range(n):
            o = [rnd.randrange(-far, far) for _ in range(3)]
            s = [rnd.choice((0, 1, 5, 20, 20, 300 if rnd.random() < 0.1 else 7)) for _ in range(3)]
            out.append((k, *o, *s, *[a + b for a, b in zip(o, s)]))
        return out
    schema = "id long, " + ", ".join(f"{c}{d} long" for c in "ose" for d in range(3))
    left, right = boxes(150, 200), boxes(60, 260)
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    hit = lambda x, y: all(x[4 + d] > 0 and y[4 + d] > 0 and min(x[7 + d], y[7 + d]) > max(x[1 + d], y[1 + d]) for d in range(3))
    want = sorted((y[0], x[0]) for x in left for y in right if hit(x, y))
    assert sorted(r.id for r in boxjoin.any_hit(a, b).collect()) == sorted({x for _, x in want})
    folder = str(tmp_path / "index")
    boxindex.build(a, folder, 8)
    assert sorted((r.query, r.id) for r in boxindex.hits(spark, folder, b.withColumnRenamed("id", "query")).collect()) == want
    for y in right[:4]:
        for most in (1000, 1):
            assert sorted(r.id for r in boxindex.in_box(spark, folder, list(y[1:4]), list(y[4:7]), most).collect()) == sorted(x for q, x in want if q == y[0])
    empty = str(tmp_path / "empty")
    boxindex.build(a.limit(0), empty, 8)
    assert boxindex.hits(spark, empty, b.withColumnRenamed("id", "query")).count() == 0 and boxindex.in_box(spark, empty, [0, 0, 0], [9, 9, 9]).count() == 0
