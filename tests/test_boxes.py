import random

import pytest
from pyspark.sql import functions as F

from quadrille.functions import aabb, addresses
from quadrille.operators import boxjoin, catalog, octree, search

A, B, C = ([10, 20, 30], [100, 200, 300]), ([1, 2], [1000, 2000]), ([-11, 21, -13], [50, 60, 70])
LIT = lambda b: aabb.make(*b) if b else F.lit(None).cast(aabb.BOX)


def one(spark, col):
    return spark.range(1).select(col.alias("x")).head().x


def test_goldens(spark):
    four = one(spark, aabb.subdivide(LIT(A), 4))
    assert [(r.ori, r.shape) for r in four] == [(o, [50, 100, 300]) for o in ([10, 20, 30], [60, 20, 30], [10, 120, 30], [60, 120, 30])]
    u, i = one(spark, aabb.union(LIT(A), LIT(C))), one(spark, aabb.intersect(LIT(A), LIT(C)))
    assert (u.ori, u.shape) == ([-11, 20, -13], [121, 200, 343]) and (i.ori, i.shape) == ([10, 21, 30], [29, 60, 27])
    assert one(spark, aabb.hit(LIT(A), LIT(C))) and one(spark, aabb.hit(LIT(C), LIT(A))) and not one(spark, aabb.hit(LIT(A), LIT(B)))
    assert not one(spark, aabb.hit(LIT(([38, 81, 56], A[1])), LIT(C)))


def test_nulls_and_ends(spark):
    assert one(spark, aabb.hit(LIT(A), LIT(None))) is False and one(spark, aabb.ndim(LIT(None))) == 0 and one(spark, aabb.ndim(LIT(B))) == 2
    assert one(spark, aabb.union(LIT(None), LIT(C))).ori == C[0] and one(spark, aabb.intersect(LIT(A), LIT(None))).shape == A[1]
    assert one(spark, aabb.hit(LIT(([0], [0])), LIT(([-1], [5])))) is False
    far = ([500, 500, 500], [10, 10, 10])
    assert one(spark, aabb.intersect(LIT(A), LIT(far))).shape == [0, 0, 0]
    assert one(spark, aabb.intersect(LIT(A), LIT(far), compat=True)).shape == [0, -280, -170]
    assert one(spark, aabb.volume(LIT(A))) == 6e6 and one(spark, aabb.same(LIT(A), LIT(A))) and not one(spark, aabb.same(LIT(A), LIT(None)))
    with pytest.raises(Exception):
        one(spark, aabb.union(LIT(A), LIT(B)))
    with pytest.raises(ValueError):
        aabb.child(F.lit(None), 6, F.lit(0))


def test_children_tile_the_parent(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.randrange(-50, 50) for _ in range(3)], [rnd.randrange(1, 40) for _ in range(3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, ori array<bigint>, shape array<bigint>").select("id", F.struct("ori", "shape").alias("b"))
    out = df.select("b", aabb.subdivide(F.col("b"), 8).alias("k")).collect()
    for r in out:
        vol = lambda s: s[0] * s[1] * s[2]
        assert sum(vol(k.shape) for k in r.k) == vol(r.b.shape)
        assert all(k.ori[d] + k.shape[d] <= r.b.ori[d] + r.b.shape[d] for k in r.k for d in range(3))


def flat(spark, rows):
    df = spark.createDataFrame([(i, *o, *s) for i, (o, s) in enumerate(rows)], "id bigint, " + ", ".join(f"{c}{d} bigint" for c in "os" for d in range(3)))
    return df.withColumns({f"e{d}": F.col(f"o{d}") + F.col(f"s{d}") for d in range(3)})


def test_box_join_is_brute_force(spark):
    rnd = random.Random(2)
    size = lambda: rnd.choice([0, 1, 5, 9, 2000])
    rows = [([rnd.randrange(-60, 60) for _ in range(3)], [size() for _ in range(3)]) for _ in range(150)]
    t = flat(spark, rows)
    hit = lambda a, b: all(min(a[0][d] + a[1][d], b[0][d] + b[1][d]) > max(a[0][d], b[0][d]) for d in range(3))
    want = sorted((i, j) for i, a in enumerate(rows) for j, b in enumerate(rows) if hit(a, b))
    assert sorted((r.aid, r.bid) for r in boxjoin.box_join(t, t).collect()) == want
    assert "Cartesian" not in boxjoin.box_join(t, t)._jdf.queryExecution().toString()


def test_addresses(spark):
    rnd = random.Random(3)
    rows = [([rnd.randrange(8) for _ in range(rnd.randrange(7))],) for _ in range(50)]
    df = spark.createDataFrame(rows, "ids array<int>").select("ids", addresses.to_int(F.col("ids")).alias("a"))
    for r in df.select("ids", "a", addresses.from_int(F.col("a")).alias("b"), addresses.to_path(F.col("ids")).alias("p"), addresses.parent(F.col("a")).alias("q")).collect():
        assert r.b == r.ids and r.p == "/".join(str(i + 1) for i in r.ids) and r.q == (r.a // 10 if r.a else None)
    assert one(spark, addresses.from_int(F.lit(109))) is None


def test_tree(spark):
    t = flat(spark, [([0, 0, 0], [10, 10, 10]), ([70, 70, 70], [10, 10, 10])])
    n = octree.nodes(spark, [0, 0, 0], [80, 80, 80], (1, 1, 1), 2000, 8, t)
    got = [r.addr for r in octree.post_order(n).collect()]
    assert got[-1] == 0 and got.index(1) > got.index(11) and set(got) == {0, 1, 8, 11, 88} | {a for a in got if a > 100}
    assert {r.addr for r in octree.subtree(n, 8).collect()} == {a for a in got if str(a).startswith("8")}
    assert octree.target_window([7], [0, 0, 0], [1, 1, 1]) == ([0.5] * 3, [0.5] * 3)


def test_names(spark):
    df = spark.createDataFrame([(0, "/a/red bolt"), (1, "/a/rad bolt"), (2, "/b/x"), (3, None)], "id int, path string")
    cost = lambda p, **k: [r.c for r in df.select("id", search.name_cost(F.col("path"), p, **k).alias("c")).orderBy("id").collect()]
    assert cost("red b") == [0, None, None, None]
    assert cost("red bolt", ins=1, delete=1, subst=1, most=2) == [0, 1, None, None]
    with pytest.raises(LookupError):
        search.find_one(df, "nothing here")


def test_roots_and_bounds(spark):
    df = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    root = lambda *p: catalog.common_root(df(*p)).head().root
    assert root("/a/b/c") == "/a/b/c" and root("/a/b/c", "/a/b/d") == "/a/b/" and root("x", "y") == "" and root("/a/b", "/a/b") == "/a/"
    two = spark.createDataFrame([(A,), (C,)], "box " + aabb.BOX)
    b = catalog.bounds_nd(two).head().box
    assert (b.ori, b.shape) == ([-11, 20, -13], [121, 200, 343])
    with pytest.raises(Exception):
        catalog.bounds_nd(spark.createDataFrame([(A,), (B,)], "box " + aabb.BOX)).collect()


def test_any_tiles_of_the_whole_table(spark):
    """No tile of the table is left out as a box to hit; a tile without extent hits nothing."""
    from quadrille.plans import catalogue, views

    d = "/root/testdata/sf0.001"
    t = views.tiles(spark, d).collect()
    box = [[(r[f"o{k}"], r[f"e{k}"]) for k in range(3)] for r in t]
    hit = lambda a, b: all(x[0] < y[1] and y[0] < x[1] for x, y in zip(a, b))
    assert sorted(r.id for r in catalogue.QUERIES["any_tiles_whole"](spark, d).collect()) == sorted(r.id for r, a in zip(t, box) if any(hit(a, b) for b in box))


def test_cells_are_not_broadcast(spark):
    """The rows that cells add are not in a plan's sizes: small tables, too, join by a merge."""
    t = spark.range(50).selectExpr("id", *[f"id * 10 as o{d}" for d in range(3)], *[f"15L as s{d}" for d in range(3)], *[f"id * 10 + 15 as e{d}" for d in range(3)])
    for df, n in ((boxjoin.any_hit(t, t), 50), (boxjoin.box_join(t, t), 148)):
        assert "Broadcast" not in df._jdf.queryExecution().sparkPlan().toString() and df.count() == n


def test_levels_are_dealt_to_tasks(spark):
    """A level of the whole tree is made by many tasks, and a level that tiles hit needs no row for each finest cell that a tile covers."""
    level = octree._level(spark, 8, [0, 0, 0], [1 << 12] * 3, (1.0, 1.0, 1.0), 8, 8)
    assert level.rdd.getNumPartitions() == 8**7 // octree.PER_TASK
    one = spark.range(40).selectExpr(*[f"0L as o{d}" for d in range(3)], *[f"1024L as e{d}" for d in range(3)])
    hit = octree.hit_nodes(one, [0] * 3, [1024] * 3, (1.0, 1.0, 1.0), (1 << 9) + 1)
    assert [(r.depth, r["count"]) for r in hit.groupBy("depth").count().orderBy("depth").collect()] == [(k, 8**k) for k in range(8)]
