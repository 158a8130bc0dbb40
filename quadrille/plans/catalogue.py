"""The engine's queries over the synthetic tables, each with the SQL that states the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import aabb, addresses, kernels, transforms
from ..operators import boxjoin, catalog, octree, render, search, voxels
from ..sources import textproto, tiletree, yamlcache
from ..sources.tables import spread
from ..streaming import ingest
from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TILES = """tiles as (
    select *, o0 + s0 as e0, o1 + s1 as e1, o2 + s2 as e2 from (
        select o_orderkey as id, '/data/' || strftime(o_orderdate, '%Y-%m-%d') || '/' || lpad(cast(o_orderkey as varchar), 6, '0') as path,
               (o_orderkey % 25) * 317200 + (o_custkey % 7) * 100 as o0, ((o_orderkey // 25) % 25) * 487500 as o1, (o_orderkey // 625) * 300000 as o2,
               377200 + (o_custkey % 3) * 1000 as s0, cast(517500 as bigint) as s1, cast(398000 as bigint) as s2 from orders))"""
LATTICE = TILES.replace(" + (o_custkey % 7) * 100", "").replace("377200 + (o_custkey % 3) * 1000 as s0", "cast(377200 as bigint) as s0")
VOXELS = """voxels as (
    select vol_id, cast(i % 4 as integer) as x, cast((i // 4) % 4 as integer) as y, cast(i // 16 as integer) as z, v from (
        select vec_id as vol_id, unnest(range(64)) as i, cast(unnest(embedding) as double) as v from embeddings))"""


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


# --- boxes ---------------------------------------------------------------------------------------

QUERY_AT, QUERY_EXTENT = (0.1, 0.2, 0.3), (0.25, 0.3, 0.35)


@query(f"with {TILES} select cast(count(*) as bigint) as n from tiles")
def tile_count(spark, d):
    return catalog.count(views.tiles(spark, d))


@query(f"with {TILES} select min(o0) as o0, min(o1) as o1, min(o2) as o2, max(e0) - min(o0) as s0, max(e1) - min(o1) as s1, max(e2) - min(o2) as s2 from tiles")
def global_bounds(spark, d):
    return catalog.bounds(views.tiles(spark, d))


@query(f"""with {TILES}, b as (select min(o0) as o0, min(o1) as o1, min(o2) as o2, max(e0) - min(o0) as s0, max(e1) - min(o1) as s1, max(e2) - min(o2) as s2 from tiles),
    q as (select cast(trunc(o0 + 0.1::double * s0) as bigint) as q0, cast(trunc(o1 + 0.2::double * s1) as bigint) as q1, cast(trunc(o2 + 0.3::double * s2) as bigint) as q2,
                 cast(trunc(0.25::double * s0) as bigint) as l0, cast(trunc(0.3::double * s1) as bigint) as l1, cast(trunc(0.35::double * s2) as bigint) as l2 from b)
    select id, path from tiles, q where least(e0, q0 + l0) > greatest(o0, q0) and least(e1, q1 + l1) > greatest(o1, q1) and least(e2, q2 + l2) > greatest(o2, q2)""")
def aabb_box_query(spark, d):
    return catalog.box_query(views.tiles(spark, d), QUERY_AT, QUERY_EXTENT).select("id", "path")


@query(f"with {TILES} select id, cast(s0 as double) * s1 * s2 as volume from tiles")
def aabb_volume(spark, d):
    return views.boxed(views.tiles(spark, d)).select("id", aabb.volume(F.col("box")).alias("volume"))


def _pairs(spark, d):
    t = views.boxed(views.tiles(spark, d)).select("id", "box")
    return t.alias("a").join(t.alias("b"), F.col("b.id") == F.col("a.id") + 1).select(F.col("a.id").alias("id"), F.col("a.box").alias("a"), F.col("b.box").alias("b"))


def _flat(box, names="os"):
    return [F.get(box["ori" if c == "o" else "shape"], F.lit(i)).alias(f"{c}{i}") for c in names for i in range(3)]


@query(f"""with {TILES} select a.id, least(a.o0, b.o0) as o0, least(a.o1, b.o1) as o1, least(a.o2, b.o2) as o2, greatest(a.e0, b.e0) - least(a.o0, b.o0) as s0,
    greatest(a.e1, b.e1) - least(a.o1, b.o1) as s1, greatest(a.e2, b.e2) - least(a.o2, b.o2) as s2 from tiles a join tiles b on b.id = a.id + 1""")
def aabb_union_pair(spark, d):
    df = _pairs(spark, d).withColumn("u", aabb.union(F.col("a"), F.col("b")))
    return df.select("id", *_flat(F.col("u")))


@query(f"""with {TILES} select a.id, greatest(a.o0, b.o0) as o0, greatest(a.o1, b.o1) as o1, greatest(a.o2, b.o2) as o2, least(a.e0, b.e0) - greatest(a.o0, b.o0) as s0,
    least(a.e1, b.e1) - greatest(a.o1, b.o1) as s1, least(a.e2, b.e2) - greatest(a.o2, b.o2) as s2 from tiles a join tiles b on b.id = a.id + 1
    where least(a.e0, b.e0) > greatest(a.o0, b.o0) and least(a.e1, b.e1) > greatest(a.o1, b.o1) and least(a.e2, b.e2) > greatest(a.o2, b.o2)""")
def aabb_intersect_pair(spark, d):
    df = _pairs(spark, d).where(aabb.hit(F.col("a"), F.col("b"))).withColumn("u", aabb.intersect(F.col("a"), F.col("b")))
    return df.select("id", *_flat(F.col("u")))


@query(f"""with {TILES} select a.id, a.o0 = b.o0 and a.o1 = b.o1 and a.o2 = b.o2 and a.s0 = b.s0 and a.s1 = b.s1 and a.s2 = b.s2 as same,
    least(a.e0, b.e0) > greatest(a.o0, b.o0) and least(a.e1, b.e1) > greatest(a.o1, b.o1) and least(a.e2, b.e2) > greatest(a.o2, b.o2) as hit
    from tiles a join tiles b on b.id = a.id + 1""")
def aabb_same(spark, d):
    return _pairs(spark, d).select("id", aabb.same(F.col("a"), F.col("b")).alias("same"), aabb.hit(F.col("a"), F.col("b")).alias("hit"))


def _subdivided(n):
    axes = [k for k in range(3) if (n - 1) >> k & 1]
    ori = ", ".join(f"o{k}" + (f" + case when (i >> {k}) & 1 = 1 then s{k} // 2 else 0 end" if k in axes else "") + f" as o{k}" for k in range(3))
    shape = ", ".join((f"case when (i >> {k}) & 1 = 1 then s{k} - s{k} // 2 else s{k} // 2 end" if k in axes else f"s{k}") + f" as s{k}" for k in range(3))
    return f"with {TILES}, r as (select cast(unnest(range({n})) as integer) as i) select id, i as child, {ori}, {shape} from tiles, r"


def _children(spark, d, n):
    rows = views.boxed(views.tiles(spark, d)).select("id", F.posexplode(aabb.subdivide(F.col("box"), n)).alias("child", "b"))
    return rows.select("id", "child", *_flat(F.col("b")))


@query(_subdivided(4))
def aabb_subdivide4(spark, d):
    return _children(spark, d, 4)


@query(_subdivided(8))
def aabb_subdivide8(spark, d):
    return _children(spark, d, 8)


def _far(spark, d):
    t = views.boxed(views.tiles(spark, d)).select("id", "box")
    return t.alias("a").join(t.alias("b"), F.col("b.id") == F.col("a.id") - F.pmod(F.col("a.id"), F.lit(4))).select(F.col("a.id").alias("id"), F.col("a.box").alias("a"), F.col("b.box").alias("b"))


_FAR = f"{TILES}, far as (select a.id, {', '.join(f'a.{c}{k} as a{c}{k}, b.{c}{k} as b{c}{k}' for c in 'ose' for k in range(3))} from tiles a join tiles b on b.id = a.id - a.id % 4)"


@query(f"""with {_FAR} select id, {' and '.join(f'a{c}{k} = b{c}{k}' for c in 'os' for k in range(3))} as same, {' and '.join(f'least(ae{k}, be{k}) > greatest(ao{k}, bo{k})' for k in range(3))} as hit,
    {', '.join(f'greatest(ao{k}, bo{k}) as o{k}, greatest(least(ae{k}, be{k}) - greatest(ao{k}, bo{k}), 0) as s{k}, least(ae{k}, be{k}) - greatest(ao{k}, bo{k}) as raw{k}' for k in range(3))} from far""".replace("as raw0", "as x0").replace("least(ae0, be0) - greatest(ao0, bo0) as x0", "greatest(least(ae0, be0) - greatest(ao0, bo0), 0) as raw0"))
def aabb_clamp(spark, d):
    """Pairs of tiles that are one, meet, touch or lie apart: whether they are the same, whether they hit, and their common box, cut
    off at 0 on all axes (s) or on the first alone (raw)."""
    a, b = F.col("a"), F.col("b")
    df = _far(spark, d).select("id", aabb.same(a, b).alias("same"), aabb.hit(a, b).alias("hit"), aabb.intersect(a, b).alias("c"), aabb.intersect(a, b, compat=True).alias("raw"))
    return df.select("id", "same", "hit", *_flat(F.col("c")), *[F.get("raw.shape", F.lit(k)).alias(f"raw{k}") for k in range(3)])


@query(f"""with {TILES} select id, cast(case when id % 4 = 3 then 0 else 3 end as integer) as ndim, case when id % 4 = 1 then 7 when id % 4 <> 3 then o0 end as o0, case when id % 4 = 2 then 9 when id % 4 <> 3 then s0 end as s0 from tiles""")
def aabb_parts(spark, d):
    """Boxes made of columns; some get a new origin, some a new shape, some are null."""
    box = aabb.make(["o0", "o1", "o2"], ["s0", "s1", "s2"])
    k = F.pmod(F.col("id"), F.lit(4))
    three = lambda n: F.array(*[F.lit(n).cast("long")] * 3)
    box = F.when(k != 3, aabb.with_parts(box, F.when(k == 1, three(7)), F.when(k == 2, three(9))))
    return views.tiles(spark, d).select("id", box.alias("b")).select("id", aabb.ndim(F.col("b")).alias("ndim"), F.get("b.ori", F.lit(0)).alias("o0"), F.get("b.shape", F.lit(0)).alias("s0"))


@query(f"with {TILES} select o0, o1, o2, s0, s1, s2 from (select min(o0) as o0, min(o1) as o1, min(o2) as o2, max(e0) - min(o0) as s0, max(e1) - min(o1) as s1, max(e2) - min(o2) as s2 from tiles)")
def bounds_nd(spark, d):
    """The bounds of boxes of any dimension."""
    return catalog.bounds_nd(views.boxed(views.tiles(spark, d)).select("box")).select(*_flat(F.col("box")))


# --- catalogue and filters -------------------------------------------------------------------------


@query(f"with {TILES} select id, round(cast(cast(s0 as float) / cast(754 as float) as double), 3) as v0, round(cast(cast(s1 as float) / cast(1035 as float) as double), 3) as v1, round(cast(cast(s2 as float) / cast(199 as float) as double), 3) as v2 from tiles")
def voxel_size(spark, d):
    return views.tiles(spark, d).select("id", *[F.round(catalog.voxel_size(F.col(f"s{k}"), F.lit(views.DIMS[k])).cast("double"), 3).alias(f"v{k}") for k in range(3)])


@query(f"with {TILES} select round(cast(cast(arg_min(s0, id) as float) / cast(754 as float) as double), 3) as v0, round(cast(cast(arg_min(s1, id) as float) / cast(1035 as float) as double), 3) as v1, round(cast(cast(arg_min(s2, id) as float) / cast(199 as float) as double), 3) as v2 from tiles")
def voxel_size_first(spark, d):
    return catalog.first_voxel_size(views.tiles(spark, d)).select(*[F.round(F.col(f"v{k}").cast("double"), 3).alias(f"v{k}") for k in range(3)])


@query(f"with {TILES} select id, path from tiles where o2 >= 600000 and s0 > 377200")
def tiles_filter(spark, d):
    return catalog.filtered(views.tiles(spark, d), (F.col("o2") >= 600000) & (F.col("s0") > 377200)).select("id", "path")


@query(f"with {TILES} select id, case when id % 3 = 0 then '100,200,50,2' else '754,1035,199,2' end as crop from tiles")
def crop_default(spark, d):
    dims = F.array(*[F.lit(x).cast("long") for x in views.DIMS])
    crop = F.when(F.col("id") % 3 == 0, F.array(*[F.lit(x).cast("long") for x in (100, 200, 50, 2)])).when(F.col("id") % 3 == 1, F.array().cast("array<bigint>"))
    return views.tiles(spark, d).select("id", F.array_join(catalog.crop_or_dims(crop, dims).cast("array<string>"), ",").alias("crop"))


@query(f"with {TILES} select id, cast(380000 as bigint) as s0, s1, round(-380000.0::double / 754, 6) as t0, round(-cast(s1 as double) / 1035, 6) as t1 from tiles")
def fix_fov(spark, d):
    t = views.tiles(spark, d)
    dims = [F.lit(x) for x in views.DIMS[:2]]
    shape = [F.col("s0"), F.col("s1")]
    diag = [-s.cast("double") / n for s, n in zip(shape, dims)]
    s, g = transforms.fix_fov(dims, shape, diag, 380000, -1)
    return t.select("id", s[0].alias("s0"), s[1].alias("s1"), F.round(g[0], 6).alias("t0"), F.round(g[1], 6).alias("t1"))


@query(f"""with {TILES}, a as (select min(path) as a, max(path) as b, count(path) as n from tiles),
    k as (select a, b, n, max(i) as i from a left join (select unnest(range(1, 1024)) as i) r on i <= length(a) and substr(a, 1, i) = substr(b, 1, i) group by 1, 2, 3)
    select case when n = 1 then a else regexp_extract(substr(a, 1, coalesce(i, 0)), '^(.*/)', 1) end as root from k""")
def common_root(spark, d):
    return catalog.common_root(views.tiles(spark, d))


@query(f"with {TILES} select id, substr(path, 7) as relative from tiles")
def relative_path(spark, d):
    return views.tiles(spark, d).select("id", catalog.relative(F.col("path"), F.lit("/data/")).alias("relative"))


# --- names and neighbours ---------------------------------------------------------------------------


@query("select p_partkey as id, p_name as path from part where regexp_matches(p_name, 'r.*d bo')")
def name_exact(spark, d):
    names = views.read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("path"))
    return names.where(search.name_cost(F.col("path"), "r.*d bo") == 0)


@query("select p_partkey as id, p_name as path, 0 as cost from part where regexp_matches(p_name, '^(red|.*) bolt$')")
def name_best_match(spark, d):
    names = views.read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("path"))
    return search.best_matches(names, r"^\(red\|.*\) bolt$").select("id", "path", "cost")


@query("select p_partkey as id, cast(levenshtein(p_name, 'red bolt') as integer) as cost from part")
def name_edit_cost(spark, d):
    return views.read(spark, d, "part").select(F.col("p_partkey").alias("id"), search.edit_distance(F.col("p_name"), "red bolt").alias("cost"))


#: The least edit distance of a string to any part of a name.
_PARTS = """parts as (select p_partkey as id, p_name as path, unnest(flatten(list_transform(range(1, len(p_name) + 2), lambda i: list_transform(range(0, 13), lambda n: substr(p_name, i, n))))) as part from part)"""


@query(f"with {_PARTS}, d as (select id, path, min(levenshtein(part, 'rde bolt')) as cost from parts group by id, path) select id, cast(case when cost <= 2 then cost end as integer) as cost from d")
def name_fuzzy(spark, d):
    """Weighted approximate matches anywhere in the name."""
    names = views.read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("path"))
    return names.select("id", search.name_cost(F.col("path"), "rde bolt", 1, 1, 1, 2).alias("cost"))


@query(f"""with {_PARTS}, w as (select unnest(['steal bult', 'steel bult']) as word), c as (select id, path, min(levenshtein(part, word)) as cost from parts, w group by id, path)
    select id, path, cast(cost as integer) as cost from c where cost <= 4 qualify cost = min(cost) over ()""")
def name_best_ties(spark, d):
    """All names at the least cost of either word, which is above 0."""
    names = views.read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("path"))
    return search.best_matches(names, r"ste[ae]l bult", ins=1, delete=1, subst=1, most=4).select("id", "path", "cost")


NEAR = """r as (select * from tiles where id = 313), n as (
    select t.*, r.o0 as r0, r.o1 as r1, r.o2 as r2 from tiles t, r where least(t.e0, r.e0) > greatest(t.o0, r.o0) and least(t.e1, r.e1) > greatest(t.o1, r.o1) and least(t.e2, r.e2) > greatest(t.o2, r.o2))"""
_SIGN = " || ".join(f"case when r{k} > o{k} then ' -' when r{k} < o{k} then ' +' else '  ' end" for k in range(3))


def _reference(lattice):
    return search.find_one(lattice, "/000313$")


@query(f"with {LATTICE}, {NEAR} select id, path from n")
def neighbors_of(spark, d):
    t = views.tiles(spark, d, jitter=False)
    return search.neighbours(t, _reference(t)).select("id", "path")


@query(f"with {LATTICE}, {NEAR} select id, path from n where (case when o0 <> r0 then 1 else 0 end) + (case when o1 <> r1 then 1 else 0 end) + (case when o2 <> r2 then 1 else 0 end) <= 1")
def neighbors_face(spark, d):
    t = views.tiles(spark, d, jitter=False)
    return search.neighbours(t, _reference(t), corners=False).select("id", "path")


@query(f"with {LATTICE}, {NEAR} select '[' || {_SIGN} || ']' as signs, path from n")
def neighbor_signs(spark, d):
    return search.neighbours_by_name(views.tiles(spark, d, jitter=False), "/000313$")


@query(f"""with {TILES} select a.id as aid, b.id as bid from tiles a join tiles b on a.o0 < b.e0 and b.o0 < a.e0 and a.o1 < b.e1 and b.o1 < a.e1 and a.o2 < b.e2 and b.o2 < a.e2 where a.id < b.id""")
def box_self_join(spark, d):
    t = views.tiles(spark, d)
    return boxjoin.box_join(t, t).where("aid < bid")


PLACES = """places as (
    select *, o0 + s0 as e0, o1 + s1 as e1, o2 + s2 as e2 from (
        select p_partkey as id, (p_partkey * 7919) % 8000000 as o0, (p_partkey * 104729) % 12000000 as o1, (p_partkey * 1299709) % 8000000 as o2,
               cast((p_size % 5) * 40000 as bigint) as s0, cast(60000 as bigint) as s1, cast((p_size % 7) * 30000 as bigint) as s2 from part))"""


def _places(spark, d):
    """A box for every part, some without extent, spread over the tiles' space."""
    k, n = F.col("p_partkey"), F.col("p_size")
    o = [F.pmod(k * m, F.lit(top)) for m, top in ((7919, 8_000_000), (104_729, 12_000_000), (1_299_709, 8_000_000))]
    s = [F.pmod(n, F.lit(5)) * 40_000, F.lit(60_000), F.pmod(n, F.lit(7)) * 30_000]
    out = views.read(spark, d, "part").select(k.alias("id"), *[c.cast("long").alias(f"{x}{i}") for x, cs in (("o", o), ("s", s)) for i, c in enumerate(cs)])
    return out.withColumns({f"e{i}": F.col(f"o{i}") + F.col(f"s{i}") for i in range(3)})


@query(f"""with {TILES}, {PLACES} select id from tiles a where exists (
    select 1 from places b where least(a.e0, b.e0) > greatest(a.o0, b.o0) and least(a.e1, b.e1) > greatest(a.o1, b.o1) and least(a.e2, b.e2) > greatest(a.o2, b.o2))""")
def any_tiles_semi(spark, d):
    """Tiles that hit any of the parts' boxes."""
    return boxjoin.any_hit(views.tiles(spark, d), _places(spark, d)).select("id")


@query()
def any_tiles_whole(spark, d):
    """The same against every tile of the table; tests hold it against brute force."""
    t = views.tiles(spark, d)
    return boxjoin.any_hit(t, t).select("id")


# --- addresses and trees -----------------------------------------------------------------------------

ADDR = "a as (select o_orderkey as id, cast(list_aggregate(list_transform(range(1 + o_orderkey % 7), lambda k: cast(1 + (o_orderkey // (k + 1) + k) % 8 as varchar)), 'string_agg', '') as bigint) as addr from orders)"


def _addresses(spark, d):
    k = F.col("o_orderkey")
    ids = F.transform(F.sequence(F.lit(0).cast("long"), k % 7), lambda j: F.pmod(F.floor(k / (j + 1)) + j, F.lit(8)).cast("int"))
    return views.read(spark, d, "orders").select(k.alias("id"), ids.alias("ids"), addresses.to_int(ids).alias("addr"))


@query(f"with {ADDR} select id, addr, addr as back from a")
def addr_roundtrip(spark, d):
    return _addresses(spark, d).select("id", "addr", addresses.to_int(addresses.from_int(F.col("addr"))).alias("back"))


@query(f"with {ADDR} select id, array_to_string(string_split(cast(addr as varchar), ''), '/') as path from a")
def addr_path(spark, d):
    return _addresses(spark, d).select("id", addresses.to_path(F.col("ids")).alias("path"))


@query(f"with {ADDR} select id, cast(length(cast(addr as varchar)) as integer) as depth, addr // 10 as parent from a")
def addr_parent_depth(spark, d):
    a = F.col("addr")
    return _addresses(spark, d).select("id", addresses.depth(a).alias("depth"), addresses.parent(a).alias("parent"))


@query(f"""with {ADDR}, u as (select distinct addr from a)
    select addr, cast(length(cast(addr as varchar)) as integer) as depth, case when addr <> (select min(addr) from u) then addr // 10 end as parent,
           cast((row_number() over (partition by length(cast(addr as varchar)) order by addr) - 1) // 7 as bigint) as batch from u""")
def addr_batches(spark, d):
    return octree.schedule(_addresses(spark, d).select("addr").distinct())


VOXEL, LEAF = (5000.0, 5000.0, 5000.0), 40_000
TREE = """t as (select min(o0) as o0, min(o1) as o1, min(o2) as o2, max(e0) - min(o0) as s0, max(e1) - min(o1) as s1, max(e2) - min(o2) as s2 from tiles),
    recursive_nodes as (
        select cast(0 as bigint) as addr, o0, o1, o2, s0, s1, s2 from t
        union all
        select addr * 10 + i + 1, o0 + case when i & 1 = 1 then s0 // 2 else 0 end, o1 + case when (i >> 1) & 1 = 1 then s1 // 2 else 0 end, o2 + case when (i >> 2) & 1 = 1 then s2 // 2 else 0 end,
               case when i & 1 = 1 then s0 - s0 // 2 else s0 // 2 end, case when (i >> 1) & 1 = 1 then s1 - s1 // 2 else s1 // 2 end, case when (i >> 2) & 1 = 1 then s2 - s2 // 2 else s2 // 2 end
        from recursive_nodes, (select unnest(range(8)) as i) r where floor(cast(s0 as double) * s1 * s2 / 125000000000.0) >= LEAF),
    nodes as (select *, cast(case when addr = 0 then 0 else length(cast(addr as varchar)) end as integer) as depth, floor(cast(s0 as double) * s1 * s2 / 125000000000.0) < LEAF as is_leaf from recursive_nodes)"""
TREE = TREE.replace("LEAF", str(LEAF))
CULLED = f"""culled as (select * from nodes n where exists (select 1 from tiles b where n.o0 < b.e0 and b.o0 < n.o0 + n.s0 and n.o1 < b.e1 and b.o1 < n.o1 + n.s1 and n.o2 < b.e2 and b.o2 < n.o2 + n.s2))"""
_NODE = ["addr", "depth", *[f"{c}{k}" for c in "os" for k in range(3)], "is_leaf"]


def _tree(spark, d, cull: bool):
    t = views.tiles(spark, d, jitter=False)
    b = catalog.bounds(t).head()
    return octree.nodes(spark, [b[f"o{k}"] for k in range(3)], [b[f"s{k}"] for k in range(3)], VOXEL, LEAF, 8, t if cull else None)


@query(f"with recursive {LATTICE}, {TREE} select {', '.join(_NODE)} from nodes")
def octree_nodes(spark, d):
    return _tree(spark, d, False).select(*_NODE)


@query(f"with recursive {LATTICE}, {TREE}, {CULLED} select {', '.join(_NODE)} from culled")
def octree_culled(spark, d):
    return _tree(spark, d, True).select(*_NODE)


@query(f"with recursive {LATTICE}, {TREE}, {CULLED} select {', '.join(_NODE)} from culled where starts_with(cast(addr as varchar), '1')")
def octree_target(spark, d):
    return octree.subtree(_tree(spark, d, True), 1).select(*_NODE)


@query(f"with {ADDR} select id, addr * 10 + 4 as pushed, cast(case when addr < 10 then 0 else addr // 10 end as bigint) as popped from a")
def addr_push_pop(spark, d):
    ids = F.col("ids")
    return _addresses(spark, d).select("id", addresses.to_int(addresses.push(ids, F.lit(3))).alias("pushed"), addresses.to_int(addresses.pop(ids)).alias("popped"))


@query(f"""with {ADDR}, u as (select distinct addr from a), n as (
        select addr, length(cast(addr as varchar)) as depth, addr // 10 as parent, (row_number() over (partition by length(cast(addr as varchar)) order by addr) - 1) // 7 as batch from u where addr <> (select min(addr) from u))
    select parent, string_agg(batch, ',' order by batch) as holds from (
        select distinct n.parent, (w.k - 1) // 7 as batch from n join (select addr, row_number() over (partition by length(cast(addr as varchar)) order by addr) as k from u) w on w.addr = n.addr) group by parent""")
def addr_holds(spark, d):
    """For each parent the batches of its children's depth that it waits for."""
    held = octree.holds(octree.schedule(_addresses(spark, d).select("addr").distinct()))
    return held.select("parent", F.array_join(F.transform("holds", lambda x: x["batch"].cast("string")), ",").alias("holds"))


SPARSE = """tiles as (
    select id, path, o0, o1, o2, s0, s1, s2, o0 + s0 as e0, o1 + s1 as e1, o2 + s2 as e2 from (
        select o_orderkey as id, '/data/' || o_orderkey as path, (o_orderkey % 97) * 100000 as o0, (o_orderkey % 97) * 100000 + (o_custkey % 5) * 70000 as o1, ((o_orderkey % 97) // 10) * 900000 as o2,
               cast(90000 as bigint) as s0, cast(60000 as bigint) as s1, cast((o_custkey % 3) * 50000 as bigint) as s2 from orders))"""


#: As CULLED; boxes without extent hit nothing.
CULLED_SPARSE = CULLED.replace("from tiles b where", "from tiles b where b.s2 > 0 and")


def _sparse(spark, d):
    """Small tiles along a diagonal, some without extent: most nodes of the tree hold none."""
    k, own = F.pmod(F.col("o_orderkey"), F.lit(97)), F.col("o_custkey")
    o, s = [k * 100_000, k * 100_000 + F.pmod(own, F.lit(5)) * 70_000, F.floor(k / 10) * 900_000], [F.lit(90_000), F.lit(60_000), F.pmod(own, F.lit(3)) * 50_000]
    out = views.read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), *[c.cast("long").alias(f"{n}{i}") for n, cs in (("o", o), ("s", s)) for i, c in enumerate(cs)])
    return out.withColumns({f"e{i}": F.col(f"o{i}") + F.col(f"s{i}") for i in range(3)})


def _sparse_tree(spark, d, fan):
    t = _sparse(spark, d)
    b = catalog.bounds(t).head()
    return octree.nodes(spark, [b[f"o{k}"] for k in range(3)], [b[f"s{k}"] for k in range(3)], VOXEL, 100_000, fan, t).select(*_NODE)


@query(f"with recursive {SPARSE}, {TREE.replace(str(LEAF), '100000')}, {CULLED_SPARSE} select {', '.join(_NODE)} from culled")
def octree_sparse(spark, d):
    return _sparse_tree(spark, d, 8)


@query(f"with recursive {SPARSE}, {TREE.replace(str(LEAF), '100000').replace('unnest(range(8))', 'unnest(range(4))').replace('case when (i >> 2) & 1 = 1 then s2 - s2 // 2 else s2 // 2 end', 's2').replace('o2 + case when (i >> 2) & 1 = 1 then s2 // 2 else 0 end', 'o2')}, {CULLED_SPARSE} select {', '.join(_NODE)} from culled")
def quadtree_sparse(spark, d):
    return _sparse_tree(spark, d, 4)


@query("""with a as (select unnest(range(1, 9)) as x), b as (select unnest(range(0, 9)) as y), t as (select x * 10 + y as addr, x - 1 as i, y - 1 as j from a, b where y > 0 union all select x, x - 1, null from a)
    select cast(addr as bigint) as addr, """ + ", ".join(f"0.5 * ((i >> {k}) & 1) + case when j is null then 0 else 0.25 * ((j >> {k}) & 1) end as a{k}, case when j is null then 0.5 else 0.25 end as e{k}" for k in range(3)).replace("0.5 *", "0.5::double *").replace("0.25 *", "0.25::double *").replace("then 0.5 else 0.25", "then 0.5::double else 0.25::double") + " from t")
def target_windows(spark, d):
    """The fractional windows of all addresses of one or two digits."""
    rows = []
    for ids in [[i] for i in range(8)] + [[i, j] for i in range(8) for j in range(8)]:
        at, extent = octree.target_window(ids, [0.0] * 3, [1.0] * 3)
        rows.append((int("".join(str(i + 1) for i in ids)), *[float(x) for k in range(3) for x in (at[k], extent[k])]))
    return spark.createDataFrame(rows, "addr bigint, a0 double, e0 double, a1 double, e1 double, a2 double, e2 double")


@query("with t as (select unnest(range(1, 2000)) as v) select cast(v as bigint) as v, cast(power(2, ceil(round(log2(v), 12))) as bigint) as up, v * 1000 as size from t")
def scalars(spark, d):
    """The next power of two, and sizes with a suffix."""
    return spark.createDataFrame([(v, transforms.next_pow2(v), transforms.parse_size(f"{v}k")) for v in range(1, 2000)], "v bigint, up bigint, size bigint")


@query(f"""with {TILES}, w as (select id, s0 / 1000.0::double / 0.5 as p0, s1 / 1000.0::double / 0.5 as p1 from tiles), v as (select *, power(2, ceil(round(log2(trunc(greatest(p0, p1))), 12))) as v from w)
    select id, round(0.5 * (1 - v / p0), 9) as a0, round(0.5 * (1 - v / p1), 9) as a1, round(v / p0, 9) as e0, round(v / p1, 9) as e1 from v""")
def square_windows(spark, d):
    """Every tile's box, made square and a power of two of half-micron pixels."""

    def run(batches):
        import pandas as pd

        for b in batches:
            got = [transforms.square_window(s, (0.0, 0.0, 0.0), (1.0, 1.0, 1.0), (0.5, 0.5, 0.5)) for s in b[["s0", "s1", "s2"]].to_numpy().tolist()]
            yield pd.DataFrame({"id": b["id"], **{f"{n}{k}": [round(g[x][k], 9) for g in got] for x, n in enumerate("ae") for k in (0, 1)}})

    return views.tiles(spark, d).select("id", "s0", "s1", "s2").mapInPandas(run, "id bigint, a0 double, a1 double, e0 double, e1 double")


@query("""with f as (select o_orderkey as id, '/data/' || (o_orderkey % 50) || case when o_orderkey % 3 = 0 then '' else '/' || (o_orderkey % 7) end || case when o_orderkey % 11 = 0 then '/.old' else '' end as dir from orders),
    dirs as (select distinct dir from f where dir not like '%/.%') select dir from dirs d where not exists (select 1 from dirs e where starts_with(e.dir, d.dir || '/'))""")
def leaf_folders(spark, d):
    """Folders of files that hold no other folder; hidden ones do not count."""
    k = F.col("o_orderkey")
    name = F.concat(F.lit("/data/"), F.pmod(k, F.lit(50)), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("/"), F.pmod(k, F.lit(7)))), F.when(k % 11 == 0, "/.old").otherwise(""), F.lit("/x.tif"))
    return tiletree.leaves(views.read(spark, d, "orders").select(name.alias("path"))).select("dir")


# --- transforms --------------------------------------------------------------------------------------


def _tile_columns():
    return [F.col(f"o{k}") for k in range(3)], [F.col(f"s{k}") for k in range(3)], [F.lit(n) for n in views.DIMS[:3]]


@query(f"""with {TILES} select id, round(-cast(s0 as double) / 754, 6) as m00, round(-cast(s1 as double) / 1035, 6) as m11, round(cast(s2 as double) / 199 / 1035, 6) as m21, round(cast(s2 as double) / 199, 6) as m22,
    cast(o0 + s0 as double) as t0, cast(o1 + s1 as double) as t1, cast(o2 as double) as t2 from tiles""")
def tile_transform(spark, d):
    m = transforms.tile_transform_columns(*_tile_columns())
    return views.tiles(spark, d).select("id", *[F.round(c, 6).alias(n) for n, c in m.items()])


@query(f"""with {TILES} select id, round((o0 + s0 - (o0 + 500.0 * 10)) / (cast(s0 as double) / 754), 6) as p0, round((o1 + s1 - (o1 + 500.0 * 20)) / (cast(s1 as double) / 1035), 6) as p1,
    round((500.0 * 30) / (cast(s2 as double) / 199) - ((o1 + s1 - (o1 + 500.0 * 20)) / (cast(s1 as double) / 1035)) / 1035, 6) as p2 from tiles""")
def compose_leaf(spark, d):
    """Pixel (10, 20, 30) of a target at the tile's corner with 500 nm voxels, in pixels of the tile."""
    import numpy as np

    def run(batches):
        for b in batches:
            ori = b[["o0", "o1", "o2"]].to_numpy(float)
            src = np.stack([transforms.tile_transform(o, s, views.DIMS[:3]) for o, s in zip(ori, b[["s0", "s1", "s2"]].to_numpy(float))]) if len(b) else np.zeros((0, 4, 4))
            got = transforms.compose(src, ori, np.full((len(b), 3), 500.0)) @ np.array([10.0, 20.0, 30.0, 1.0])
            yield b[["id"]].assign(**{f"p{k}": np.round(got[:, k], 6) for k in range(3)})

    columns = [f"{c}{k}" for c in "os" for k in range(3)]
    return views.tiles(spark, d).select("id", *columns).mapInPandas(run, "id bigint, p0 double, p1 double, p2 double")


@query(f"""with {TILES} select id, {', '.join(f'round((cast(s{k} // 2 as double) / {100 + k}) / (cast(s{k} as double) / {n}), 6) as m{k}{k}, round(1000 / (cast(s{k} as double) / {n}), 6) as t{k}' for k, n in enumerate((754, 1035, 199)))} from tiles""")
def box2box(spark, d):
    o, s, n = _tile_columns()
    dst = ([c + 1000 for c in o], [F.floor(c / 2) for c in s], [F.lit(100 + k) for k in range(3)])
    return views.tiles(spark, d).select("id", *[F.round(c, 6).alias(k) for k, c in transforms.box_to_box_columns((o, s, n), dst).items()])


_FIRST = {k: f"greatest(floor(round({(100000, -50000, 100000)[k]} / (cast(s{k} as double) / {n}), 6)), 0)" for k, n in enumerate((754, 1035, 199))}
_LAST = {k: f"least(ceil(round({(250000, 250000, 900000)[k]} / (cast(s{k} as double) / {n}), 6)), {n})" for k, n in enumerate((754, 1035, 199))}


@query(f"""with {TILES} select id, {', '.join(f'cast({_FIRST[k]} as bigint) as p{k}, cast({_LAST[k]} - {_FIRST[k]} as bigint) as n{k}' for k in range(3))}, cast(2 as bigint) as channels from tiles""")
def world_to_pixel(spark, d):
    """The pixel box of a world box that begins before the tile on one axis and ends behind it on another, for an unflipped transform."""
    import numpy as np

    def run(batches):
        for b in batches:
            out = []
            for i, o, s in zip(b["id"], b[["o0", "o1", "o2"]].to_numpy(), b[["s0", "s1", "s2"]].to_numpy()):
                m = np.diag([*(s / np.array(views.DIMS[:3])), 1.0])
                m[:3, 3] = o
                ori, shape = transforms.world_to_pixel(m, [o[0] + 100000, o[1] - 50000, o[2] + 100000], [150000, 300000, 800000], views.DIMS)
                out.append((i, *[x for k in range(3) for x in (ori[k], shape[k])], shape[3]))
            yield pd.DataFrame(out, columns=["id", "p0", "n0", "p1", "n1", "p2", "n2", "channels"])

    import pandas as pd

    columns = [f"{c}{k}" for c in "os" for k in range(3)]
    return views.tiles(spark, d).select("id", *columns).mapInPandas(run, "id bigint, p0 bigint, n0 bigint, p1 bigint, n1 bigint, p2 bigint, n2 bigint, channels bigint")


@query(f"""with {TILES} select id, round(cast(o0 as double), 3) as w0, round(cast(o1 as double), 3) as w1, round(o2 + cast(s2 as double) / 199 / 1035 * 1035 + s2, 3) as w2 from tiles""")
def apply_affine_corner(spark, d):
    """Where the far pixel corner of each tile lies."""
    m = transforms.tile_transform_columns(*_tile_columns())
    z = F.lit(0.0)
    rows = [[m["m00"], z, z, m["t0"]], [z, m["m11"], z, m["t1"]], [z, m["m21"], m["m22"], m["t2"]]]
    w = transforms.apply(rows, [F.lit(float(n)) for n in views.DIMS[:3]])
    return views.tiles(spark, d).select("id", *[F.round(c, 3).alias(f"w{k}") for k, c in enumerate(w)])


# --- kernels and voxels --------------------------------------------------------------------------------


def _kernel_sql(name: str, r: float) -> str:
    s = abs(r) / 2
    return f"""{name}0 as (select cast(ceil(sqrt(-2 * {s}::double * {s} * ln(0.01 * {s}::double * sqrt(2 * pi())))) as integer) as r),
        {name}1 as (select unnest(range(-r, r + 1)) as k from {name}0), {name} as (select cast(k as integer) as k, exp(-0.5 * (k / {s}::double) * (k / {s}::double)) / sum(exp(-0.5 * (k / {s}::double) * (k / {s}::double))) over () as w from {name}1)"""


def _blur_sql(name: str, kernel: str, ends: tuple[int, int, int] = (3, 3, 3)) -> str:
    out, last = [], "voxels"
    for axis, end in zip("xyz", ends):
        rest = [c for c in "xyz" if c != axis]
        now = f"{name}_{axis}"
        out.append(f"{now} as (select o.vol_id, o.x, o.y, o.z, sum(s.v * w) as v from {last} o, {kernel} join {last} s on s.vol_id = o.vol_id and s.{axis} = least(greatest(o.{axis} + k, 0), {end}) and " + " and ".join(f"s.{c} = o.{c}" for c in rest) + " group by 1, 2, 3, 4)")
        last = now
    return ", ".join(out)


@query(f"with {_kernel_sql('g', 3.0)} select k, round(w, 9) as w from g")
def gauss_kernel(spark, d):
    w = kernels.point_kernel(3.0)
    return spark.createDataFrame([(k - len(w) // 2, x) for k, x in enumerate(w)], "k int, w double").withColumn("w", F.round("w", 9))


@query(f"with {VOXELS}, {_kernel_sql('g', 2.0)}, {_blur_sql('b', 'g')} select vol_id, x, y, z, round(v, 6) as v from b_z")
def gauss_blur3d(spark, d):
    return views.voxels(voxels.blur(views.volumes(spark, d), kernels.point_kernel(2.0))).withColumn("v", F.round("v", 6))


DOG = f"{VOXELS}, {_kernel_sql('g', 2.0)}, {_kernel_sql('h', 3.0)}, {_blur_sql('b', 'g')}, {_blur_sql('c', 'h')}, dog as (select vol_id, x, y, z, p.v - q.v as v from b_z p join c_z q using (vol_id, x, y, z))"


@query(f"with {DOG} select vol_id, x, y, z, round(v, 6) as v from dog")
def dog(spark, d):
    return views.voxels(voxels.dog(views.volumes(spark, d))).withColumn("v", F.round("v", 6))


@query(f"""with {DOG} select vol_id, x, y, z, round(v, 6) as intensity from dog a where v > 0.01 and not exists (
    select 1 from dog b where b.vol_id = a.vol_id and abs(b.x - a.x) <= 1 and abs(b.y - a.y) <= 1 and abs(b.z - a.z) <= 1 and b.v > a.v)""")
def dog_points(spark, d):
    return voxels.maxima(voxels.dog(views.volumes(spark, d)), 0.01).withColumn("intensity", F.round("intensity", 6))


@query(f"with {VOXELS} select vol_id, x, y, z, cast(case when v > 0.05 then 1 else 0 end as integer) as v from voxels")
def threshold_mask(spark, d):
    return views.voxels(views.volumes(spark, d).withColumn("v", voxels.mask(F.col("v"), 0.05)))


@query(f"with {VOXELS} select vol_id, x // 2 as x, y // 2 as y, z // 2 as z, v from voxels where x % 2 = 0 and y % 2 = 0 and z % 2 = 0")
def decimate(spark, d):
    return voxels.decimate(views.voxels(views.volumes(spark, d)), 2)


@query(f"with {VOXELS} select vol_id, x // 2 as x, y // 2 as y, z // 2 as z, round(avg(v), 6) as v from voxels group by 1, 2, 3, 4")
def pyramid_level(spark, d):
    return voxels.halve(views.voxels(views.volumes(spark, d))).withColumn("v", F.round("v", 6))


@query(f"with {VOXELS}, {_kernel_sql('g', 2.0)}, {_blur_sql('b', 'g')} select vol_id, x // 2 as x, y // 2 as y, z // 2 as z, round(avg(v), 5) as v from b_z group by 1, 2, 3, 4")
def pyramid_merge(spark, d):
    """A parent of one child each: low-passed for twice the step, then sampled between the child's voxels."""
    import numpy as np

    def run(batches):
        import pandas as pd

        for b in batches:
            out = []
            for i, v in zip(b["vol_id"], b["v"]):
                got = render.parent([4000] * 3, [0] * 3, [([0] * 3, [4000] * 3, np.array(v, float).reshape(4, 4, 4))], [2, 2, 2])
                out += [(i, x, y, z, round(float(got[z, y, x]), 5)) for z in range(2) for y in range(2) for x in range(2)]
            yield pd.DataFrame(out, columns=["vol_id", "x", "y", "z", "v"])

    return views.volumes(spark, d).mapInPandas(run, "vol_id bigint, x int, y int, z int, v double")


@query(f"with {VOXELS} select vol_id, x, y, z, cast(floor(least(greatest((v + 1) / 2 * 255, 0), 255)) as integer) as v from voxels")
def contrast(spark, d):
    return views.voxels(views.volumes(spark, d).withColumn("v", voxels.contrast(F.col("v"), -1.0, 1.0)))


@query(f"with {VOXELS} select vol_id, z as x, y, x as z, v as yz, null::double as zx from voxels union all select vol_id, x, z as y, y as z, null, v from voxels")
def ortho_views(spark, d):
    """Volumes with two axes exchanged, as each of the two orthogonal views shows them."""
    v = views.volumes(spark, d)
    turned = lambda plane: views.voxels(v.withColumn("v", voxels.view(F.col("v"), plane)))
    return turned("yz").select("vol_id", "x", "y", "z", F.col("v").alias("yz"), F.lit(None).cast("double").alias("zx")).unionByName(turned("zx").select("vol_id", "x", "y", "z", F.lit(None).cast("double").alias("yz"), F.col("v").alias("zx")))


@query("""with s as (select unnest([0.2, 0.25, 0.6, 1.0, 2.5, 5.0, 12.0]) as size), k as (select size, 0.5::double * size as sg from s where 0.5 * size > 0.25),
    r as (select size, sg, cast(ceil(sqrt(-2 * sg * sg * ln(0.01 * sg * sqrt(2 * pi())))) as integer) as r from k), t as (select size, sg, unnest(range(-r, r + 1)) as k from r)
    select cast(size as double) as size, cast(k as integer) as k, round(exp(-0.5 * (k / sg) * (k / sg)) / sum(exp(-0.5 * (k / sg) * (k / sg))) over (partition by size), 9) as w from t""")
def antialias_kernels(spark, d):
    """Kernels of input filters by the step's size; none at or under the threshold."""
    rows = [(size, k - len(w) // 2, round(x, 9)) for size in (0.2, 0.25, 0.6, 1.0, 2.5, 5.0, 12.0) if (w := kernels.antialias(size, 0.5, 0.25)) for k, x in enumerate(w)]
    return spark.createDataFrame(rows, "size double, k int, w double")


@query("""with f as (select * from (values (0, 1000.0::double / 500), (2, 250.0::double / 500)) t(axis, sg)), r as (select axis, sg, cast(ceil(sqrt(-2 * sg * sg * ln(0.01 * sg * sqrt(2 * pi())))) as integer) as r from f),
    t as (select axis, sg, unnest(range(-r, r + 1)) as k from r)
    select cast(axis as integer) as axis, cast(k as integer) as k, round(exp(-0.5 * (k / sg) * (k / sg)) / sum(exp(-0.5 * (k / sg) * (k / sg))) over (partition by axis), 9) as w from t""")
def output_kernels(spark, d):
    """Kernels of a render run's output filters of 1, 0.1 and 0.25 um at half-micron voxels."""
    found = render.Options(output_filter_um=(1.0, 0.1, 0.25)).out_filter()
    return spark.createDataFrame([(axis, k - len(w) // 2, round(x, 9)) for axis, w in enumerate(found) if w for k, x in enumerate(w)], "axis int, k int, w double")


# --- volumes, trees and files: no SQL form; tests compare with numpy and round trips ----------------------


@query()
def points_numpy(spark, d):
    """Detected points by the Arrow path, for volumes that are too large for row-local expressions."""
    vols = views.volumes(spark, d).select("vol_id", F.array(*[F.lit(4)] * 3).alias("dims"), F.col("v").alias("values"))
    return render.points(vols, 0.01)


@query()
def xcorr_pair(spark, d):
    """The best shift between each volume and the next."""
    v = views.volumes(spark, d)
    pairs = v.alias("a").join(v.alias("b"), F.col("b.vol_id") == F.col("a.vol_id") + 1)
    pairs = pairs.select(F.col("a.vol_id").alias("id"), F.array(*[F.lit(4)] * 3).alias("dims"), F.col("a.v").alias("a"), F.col("b.v").alias("b"))
    return render.correlate(pairs, -9.0).withColumn("peak", F.round("peak", 6))


def _pyramid_parts(spark, d):
    """Every volume as a tile of 4 x 4 x 4 voxels of 1000 nm, on a 16-wide grid, and the tree over them."""
    k = F.col("vol_id")
    ori = [F.pmod(k, F.lit(16)) * 4000, F.pmod(F.floor(k / 16), F.lit(16)) * 4000, F.floor(k / 256) * 4000]
    t = views.volumes(spark, d).select(k.alias("id"), *[o.cast("long").alias(f"o{i}") for i, o in enumerate(ori)], *[F.lit(4000).cast("long").alias(f"s{i}") for i in range(3)], "v")
    t = t.withColumns({f"e{i}": F.col(f"o{i}") + F.col(f"s{i}") for i in range(3)})
    matrix = [F.lit(1000.0 if r == c else 0.0) if c < 3 else (F.col(f"o{r}").cast("double") if r < 3 else F.lit(1.0)) for r in range(4) for c in range(4)]
    t = t.withColumn("transform", F.array(*matrix))
    # the path carries the values, so that a loader needs no file
    t = t.withColumn("path", F.array_join(F.transform("v", lambda x: x.cast("string")), ","))
    b = catalog.bounds(t).head()
    voxel, most = (2000.0, 2000.0, 2000.0), 4096
    n = octree.nodes(spark, [b[f"o{i}"] for i in range(3)], [b[f"s{i}"] for i in range(3)], voxel, most, 8, t)
    return t, n, voxel


def _load(path: str):
    import numpy as np

    return np.array(path.split(","), float).reshape(4, 4, 4)


def _summary(nodes):
    v = F.transform("values", lambda x: x.cast("double"))
    return nodes.select("addr", "depth", F.array_join(F.col("dims").cast("array<string>"), "x").alias("dims"), F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 3).alias("total"), F.round(F.array_max(v), 4).alias("top"))


@query()
def render_leaf(spark, d):
    t, n, voxel = _pyramid_parts(spark, d)
    return _summary(render.render_leaves(n, t, _load, voxel))


@query()
def render_pyramid(spark, d):
    t, n, voxel = _pyramid_parts(spark, d)
    return _summary(render.pyramid(n, t, _load, voxel))


def _records(spark, d):
    dims = F.array(*[F.lit(x).cast("long") for x in views.DIMS])
    t = views.boxed(views.tiles(spark, d))
    matrix = F.array(*[F.lit(float(i)).cast("float") for i in range(25)])
    return t.select("path", F.col("box.ori").alias("ori"), F.col("box.shape").alias("shape"), F.lit("u16").alias("dtype"), dims.alias("dims"), F.lit(None).cast("array<bigint>").alias("crop"), matrix.alias("transform"))


@query(f"with {TILES} select path, array_to_string([o0, o1, o2, s0, s1, s2], ',') as box, '754,1035,199,2' as dims from tiles")
def yaml_cache_roundtrip(spark, d):
    """The tiles, written as YAML catalogues and read again."""
    rows = spread(_records(spark, d))

    def back(batches):
        import pandas as pd

        for b in batches:
            docs = [yamlcache.parse(t) for t in b["value"]]
            out = [(r[0], ",".join(map(str, [*r[2], *r[3]])), ",".join(map(str, r[5]))) for rs in docs for r in rs]
            yield pd.DataFrame(out, columns=["path", "box", "dims"])

    def text(batches):
        import pandas as pd

        for b in batches:
            rows = [{k: list(v) if hasattr(v, "__len__") and not isinstance(v, str) else v for k, v in r.items()} for r in b.to_dict("records")]
            yield pd.DataFrame({"value": [yamlcache.dump(rows, "/data/")]})

    return rows.mapInPandas(text, "value string").mapInPandas(back, "path string, box string, dims string")


@query(f"with {TILES} select path, 'v6' as format, o0, s0 from (select path, cast(trunc(cast(cast(cast(o0 as double) / 1e6 as float) * cast(1e6 as float) as double)) as bigint) as o0, cast(trunc(cast(cast(cast(s0 as double) / 1e3 as float) * cast(1e3 as float) as double)) as bigint) as s0 from tiles)")
def catalog_ingest(spark, d):
    """Metadata texts made from the tiles, detected and parsed back; units go through single precision."""

    def run(batches):
        import pandas as pd

        for b in batches:
            out = []
            for r in b.itertuples():
                scope = f'fov {{ x_size_um: {r.s0 / 1e3!r} y_size_um: 517.5 z_size_um: 398 rotation_radians: 0 }} file_prefix: "vol" stack_extension: ".tif" autotile {{ }} surface_scan {{ }} pockels {{ laser: Chameleon }} trip_detect {{ ichan: 0 }}'
                stack = f"x_mm: {r.o0 / 1e6!r}\ny_mm: {r.o1 / 1e6!r}\nz_mm: {r.o2 / 1e6!r}\n"
                m = textproto.tile(scope, stack, r.path)
                out.append((m["path"], m["format"], m["ori"][0], m["shape"][0]))
            yield pd.DataFrame(out, columns=["path", "format", "o0", "s0"])

    return spread(views.tiles(spark, d).select("path", "o0", "o1", "o2", "s0")).mapInPandas(run, "path string, format string, o0 bigint, s0 bigint")


#: What a scope's text has that only one version accepts, or that one first.
_SCOPES = (
    "zpiezo { nidaq { um_max: 50 } } resonant_wrap { }", "zpiezo { um_max: 50 } resonant_wrap { } autotile { }", "daq { nidaq { flyback_scans: 4 } } autotile { }", "autotile { } surface_scan { } surface_probe { }",
    "autotile { } surface_scan { } pockels { laser: A } surface_find { response: 2 }", "autotile { } surface_scan { } pockels { laser: A } surface_find { offset_um: 2 }", "autotile { } surface_scan { } pockels { laser: A } trip_detect { ichan: 0 }",
    "autotile { use_explore: false } surface_scan { } pockels { laser: A } trip_detect { ichan: 0 }", "autotile { use_explore: false } surface_scan { } pockels { laser: A } trip_detect { threshold { ichan: 0 } }",
    "autotile { } surface_scan { } pockels { laser: A } pmt { }",
)


@query(f"with {TILES} select path, 'v' || (id % 10) as format, path || '/' || lpad(cast(id as varchar), 6, '0') || '-vol.%.tif' as volume, case when id % 10 < 2 then -s1 else 0 end as flip, id % 10 in (4, 5) as by_name from tiles")
def metadata_versions(spark, d):
    """Metadata texts of all ten versions, detected; their volumes' paths; whether the file passes as one of version 5 or 4 by name."""

    def run(batches):
        import pandas as pd

        for b in batches:
            out = []
            for r in b.itertuples():
                n = r.id % 10
                scope = f'fov {{ x_size_um: 10 y_size_um: {r.s1 / 1e3!r} z_size_um: 3 rotation_radians: 0 }} file_prefix: "vol" stack_extension: ".tif" {_SCOPES[n]}'
                stack = "x_mm: 1 y_mm: 2 z_mm: 3"
                m = textproto.tile(scope, stack, r.path)
                try:
                    fits = textproto.tile(scope, stack, r.path, "v5" if n == 5 else "v4")["format"] in ("v4", "v5")
                except ValueError:
                    fits = False
                flip = transforms.FLIPS[m["format"]][0] == 1
                out.append((m["path"], m["format"], m["volume"], -m["shape"][1] if flip else 0, fits))
            yield pd.DataFrame(out, columns=["path", "format", "volume", "flip", "by_name"])

    return spread(views.tiles(spark, d).select("id", "path", "s1")).mapInPandas(run, "path string, format string, volume string, flip bigint, by_name boolean")


@query(f"""with {TILES}, m as (select path, cast(cast(o0 + 1000000 as double) / 1e6 as float) * cast(1e6 as float) as o0, cast(cast(s0 * 2 as double) / 1e3 as float) * cast(1e3 as float) as s0 from tiles)
    select path, cast(trunc(cast(o0 as double)) as bigint) as o0, cast(trunc(cast(s0 as double)) as bigint) as s0 from m""")
def metadata_moved(spark, d):
    """Metadata texts written anew with another origin and shape, and read again."""

    def run(batches):
        import pandas as pd

        scope = f'fov {{ x_size_um: 10 y_size_um: 20 z_size_um: 3 }} file_prefix: "vol" stack_extension: ".tif" {_SCOPES[2]}'
        for b in batches:
            out = []
            for r in b.itertuples():
                stack, new = textproto.moved("x_mm: 1 y_mm: 2 z_mm: 3", scope, [r.o0 + 1_000_000, r.o1, r.o2], [2 * r.s0, 1000, 1000])
                m = textproto.tile(new, stack, r.path)
                out.append((m["path"], m["ori"][0], m["shape"][0]))
            yield pd.DataFrame(out, columns=["path", "o0", "s0"])

    return spread(views.tiles(spark, d).select("path", "o0", "o1", "o2", "s0")).mapInPandas(run, "path string, o0 bigint, s0 bigint")


@query(f"with {TILES} select path, case when id % 5 = 0 then 'unknown keys: odd' end as error from tiles")
def yaml_errors(spark, d):
    """Records with a key that is not known are kept and say so."""

    def run(batches):
        import pandas as pd

        for b in batches:
            out = []
            for r in b.itertuples():
                odd = "  odd: 1\n" if r.id % 5 == 0 else ""
                text = f"---\npath: /data/\ntiles:\n- path: {r.path[6:]}\n  aabb:\n    ori: [1, 2, 3]\n    shape: [4, 5, 6]\n{odd}...\n"
                out += [(x[0], x[-1]) for x in yamlcache.parse(text)]
            yield pd.DataFrame(out, columns=["path", "error"])

    return spread(views.tiles(spark, d).select("id", "path")).mapInPandas(run, "path string, error string")


@query(f"with {TILES}, p as (select case when id % 3 = 0 then 'a' else path end as path, id, o0 from tiles) select path, max(id) as id, arg_max(o0, id) as o0 from p group by path")
def newest_tiles(spark, d):
    """Of rows that share a path the newest."""
    t = views.tiles(spark, d).select(F.when(F.col("id") % 3 == 0, "a").otherwise(F.col("path")).alias("path"), F.col("id"), "o0")
    return ingest.newest(t, "id")


@query(f"with recursive {SPARSE}, {TREE.replace(str(LEAF), '100000')}, {CULLED_SPARSE} select cast(addr as bigint) as addr, depth, array_to_string(list_transform(string_split(case when addr = 0 then '' else cast(addr as varchar) end, ''), lambda c: c), '/') as path, cast(o0 as double) as ox_nm, cast(s0 as double) / 2 as sx_nm from culled")
def stored_nodes(spark, d):
    """Nodes saved by depth with their paths and transforms, and read again."""
    import uuid

    from ..sources.tables import work_dir

    shape = F.array("s0", "s1", "s2")
    nodes = _sparse_tree(spark, d, 8).select("addr", "depth", F.array("o0", "o1", "o2").alias("ori"), shape.alias("shape"), F.array(*[F.lit(2)] * 3).alias("dims"))
    folder = f"{work_dir(spark)}/nodes-{uuid.uuid4().hex}"
    render.save(nodes, folder)
    return render.stored(spark, folder).select("addr", "depth", "path", "ox_nm", "sx_nm")
