"""Queries over volumes of many chunks, each with its SQL.

60 vectors make a volume of 20 x 16 x 12 voxels, in cubes of 4; what the last volume lacks is 0. Chunks have 8 voxels, so those at the ends
of x and z are cut.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..operators import align, chunks, levels
from ..sources.tables import work_dir, written
from . import views
from .catalogue import _blur_sql, _kernel_sql, query

CUBES, SIDE = (5, 4, 3), 8
DIMS = tuple(4 * n for n in CUBES)
VOXELS = f"""cubes as (select vec_id // 60 as vol_id, vec_id % 60 as j, unnest(range(64)) as i, cast(unnest(embedding) as double) as v from embeddings),
    have as (select vol_id, cast(j % 5 * 4 + i % 4 as integer) as x, cast(j // 5 % 4 * 4 + i // 4 % 4 as integer) as y, cast(j // 20 * 4 + i // 16 as integer) as z, v from cubes),
    grid as (select vol_id, cast(x as integer) as x, cast(y as integer) as y, cast(z as integer) as z from (select distinct vol_id from have), range({DIMS[0]}) a(x), range({DIMS[1]}) b(y), range({DIMS[2]}) c(z)),
    voxels as (select g.vol_id, g.x, g.y, g.z, coalesce(h.v, 0.0::double) as v from grid g left join have h on h.vol_id = g.vol_id and h.x = g.x and h.y = g.y and h.z = g.z)"""
_ENDS = tuple(n - 1 for n in DIMS)
_DOG = f"{VOXELS}, {_kernel_sql('g', 2.0)}, {_kernel_sql('h', 3.0)}, {_blur_sql('b', 'g', _ENDS)}, {_blur_sql('c', 'h', _ENDS)}, dog as (select vol_id, x, y, z, p.v - q.v as v from b_z p join c_z q using (vol_id, x, y, z))"


def _cubes(spark, d, each: int) -> DataFrame:
    """Vectors as cubes of 4 voxels, `each` of them to a volume."""
    k = F.col("vol_id")
    j = k % each
    ori = F.array(j % CUBES[0] * 4, F.floor(j / CUBES[0]) % CUBES[1] * 4, F.floor(j / (CUBES[0] * CUBES[1])) * 4)
    return views.volumes(spark, d).select(F.floor(k / each).alias("vol_id"), ori.cast("array<int>").alias("ori"), F.array(*[F.lit(4)] * 3).alias("shape"), F.col("v").alias("data"))


def volumes(spark, d) -> DataFrame:
    """The table of chunks."""
    cubes = _cubes(spark, d, CUBES[0] * CUBES[1] * CUBES[2]).withColumn("dims", F.array(*[F.lit(n) for n in DIMS]))
    return chunks.dense(written(chunks.chunked(cubes, SIDE)), SIDE)


def _rounded(df: DataFrame, column: str = "v") -> DataFrame:
    return df.withColumn(column, F.round(column, 6) + F.lit(0.0))  # no negative zero


@query(f"with {VOXELS} select vol_id, x, y, z, v from voxels")
def volume_voxels(spark, d):
    """Cubes of 4 put together to chunks of 8, these cut anew to chunks of 5."""
    return chunks.voxels(chunks.rechunked(volumes(spark, d), SIDE, 5), 5)


@query(f"""with {VOXELS}, c as (select vol_id, x // 8 as cx, y // 8 as cy, z // 8 as cz, v from voxels)
    select vol_id, cast(cx as integer) as cx, cast(cy as integer) as cy, cast(cz as integer) as cz,
           cast((cx & 1) + (cy & 1) * 2 + (cz & 1) * 4 + (cx >> 1) * 8 + (cy >> 1) * 16 + (cz >> 1) * 32 as bigint) as key, count(*) as n, min(v) as low, max(v) as top
    from c group by vol_id, cx, cy, cz""")
def volume_chunks(spark, d):
    v = volumes(spark, d)
    return v.select("vol_id", *chunks.AXES, "key", F.size("data").cast("bigint").alias("n"), F.array_min("data").alias("low"), F.array_max("data").alias("top"))


BOX_AT, BOX_SIZE = (6, 3, 2), (9, 20, 7)


@query(f"with {VOXELS} select vol_id, x - 6 as x, y - 3 as y, z - 2 as z, v from voxels where x >= 6 and x < 15 and y >= 3 and z >= 2 and z < 9")
def volume_box(spark, d):
    """One box of every volume, which ends beyond them on y, from a stored table by ranges of keys."""
    folder = f"{work_dir(spark)}/volumes-{uuid.uuid4().hex}"
    chunks.store(volumes(spark, d), folder)
    return _part_voxels(chunks.read_box(chunks.stored(spark, folder), SIDE, list(BOX_AT), list(BOX_SIZE))).drop("request")


def _part_voxels(parts: DataFrame) -> DataFrame:
    rows = parts.select("request", "vol_id", "ori", "shape", F.posexplode_outer("data").alias("i", "v")).where("i is not null")
    n = lambda k: F.get("shape", F.lit(k))
    at = [F.col("i") % n(0), F.floor(F.col("i") / n(0)) % n(1), F.floor(F.col("i") / (n(0) * n(1)))]
    return rows.select("request", "vol_id", *[(F.get("ori", F.lit(k)) + p).cast("int").alias(c) for k, (c, p) in enumerate(zip("xyz", at))], "v")


@query(f"""with {VOXELS}, r as (select vec_id as request, vec_id // 60 as vol_id, vec_id % 17 as a, vec_id % 13 as b, vec_id % 9 as c, 3 + vec_id % 5 as n from embeddings)
    select r.request, r.vol_id, cast(v.x - r.a as integer) as x, cast(v.y - r.b as integer) as y, cast(v.z - r.c as integer) as z, v.v
    from r join voxels v on v.vol_id = r.vol_id and v.x >= r.a and v.x < r.a + r.n and v.y >= r.b and v.y < r.b + 3 and v.z >= r.c and v.z < r.c + 4""")
def volume_requests(spark, d):
    """A small box for every vector, read from its volume's chunks."""
    k = F.col("vol_id")
    asked = views.volumes(spark, d).select(k.alias("request"), F.floor(k / 60).alias("vol_id"), F.array(k % 17, k % 13, k % 9).alias("ori"), F.array(3 + k % 5, F.lit(3), F.lit(4)).alias("shape"))
    return _part_voxels(chunks.read_boxes(volumes(spark, d), SIDE, asked))


@query(f"with {VOXELS}, {_kernel_sql('g', 3.0)}, {_blur_sql('b', 'g', _ENDS)} select vol_id, x, y, z, round(v, 6) + 0.0::double as v from b_z")
def volume_blur(spark, d):
    """A filter over whole volumes, by chunks and their neighbours' rims."""
    return _rounded(chunks.voxels(chunks.filtered(volumes(spark, d), SIDE, [kernels.point_kernel(3.0)] * 3), SIDE))


@query(f"with {_DOG} select vol_id, x, y, z, round(v, 6) + 0.0::double as v from dog")
def volume_dog(spark, d):
    return _rounded(chunks.voxels(chunks.dog(volumes(spark, d), SIDE), SIDE))


@query(f"""with {_DOG} select vol_id, x, y, z, round(v, 6) + 0.0::double as intensity from dog a where v > 0.01 and not exists (
    select 1 from dog b where b.vol_id = a.vol_id and abs(b.x - a.x) <= 1 and abs(b.y - a.y) <= 1 and abs(b.z - a.z) <= 1 and b.v > a.v)""")
def volume_points(spark, d):
    """Maxima that no neighbour exceeds, those in other chunks included."""
    return _rounded(chunks.points(volumes(spark, d), SIDE, 0.01), "intensity")


@query(f"with {VOXELS} select vol_id, x // 2 as x, y // 2 as y, z // 2 as z, round(avg(v), 6) + 0.0::double as v from voxels group by 1, 2, 3, 4")
def volume_level(spark, d):
    """A pyramid level of whole volumes."""
    return _rounded(chunks.voxels(chunks.halved(volumes(spark, d), SIDE), SIDE))


# --- pairs: tiles cut from one scene at places other than stated ---------------------------------------------

STEP, TILE = 12, (14, 12, 20)


def _scene(spark, d) -> tuple[DataFrame, int]:
    """All vectors as one volume that grows along z, and its length."""
    each = CUBES[0] * CUBES[1]
    last = views.read(spark, d, "embeddings").agg(F.max("vec_id")).head()[0]
    length = 4 * (last // each + 1)
    cubes = _cubes(spark, d, 1 << 62).withColumn("dims", F.array(*[F.lit(n) for n in (*DIMS[:2], length)]))
    return chunks.dense(written(chunks.chunked(cubes, SIDE)), SIDE), length


def _moved(k):
    """How far tile k lies from where it says, on each axis."""
    return [k * m % 3 - 1 for m in (1, 2, 5)]


@query("""with n as (select 4 * (max(vec_id) // 20 + 1) as length from embeddings), t as (select unnest(range((length - 22) // 12 + 1)) as k from n),
    m as (select k, k % 3 - 1 as jx, k * 2 % 3 - 1 as jy, k * 5 % 3 - 1 as jz from t)
    select a.k as a, b.k as b, cast(b.jx - a.jx as integer) as dx, cast(b.jy - a.jy as integer) as dy, cast(b.jz - a.jz as integer) as dz, 1.0::double as peak from m a join m b on b.k = a.k + 1""")
def pair_shifts(spark, d):
    """Tiles along a scene, each cut out up to one voxel beside its stated place; the correlation of the stated overlaps finds the differences."""
    scene, length = _scene(spark, d)
    k = F.col("id")
    tiles = spark.range(0, (length - 22) // STEP + 1)
    jitter = _moved(k)
    at = [3 + jitter[0], 2 + jitter[1], 1 + k * STEP + jitter[2]]
    asked = tiles.select(k.alias("request"), F.lit(0).cast("bigint").alias("vol_id"), F.array(*[a.cast("int") for a in at]).alias("ori"), F.array(*[F.lit(n) for n in TILE]).alias("shape"))
    parts = chunks.read_boxes(scene, SIDE, asked).select(F.col("request").alias("vol_id"), "dims", "ori", "shape", "data")
    own = written(chunks.chunked(parts, SIDE))
    stated = [F.lit(0), F.lit(0), k * STEP]
    boxes = tiles.select("id", *[c.cast("bigint").alias(f"o{i}") for i, c in enumerate(stated)], *[F.lit(n).cast("bigint").alias(f"s{i}") for i, n in enumerate(TILE)])
    boxes = boxes.withColumns({f"e{i}": F.col(f"o{i}") + F.col(f"s{i}") for i in range(3)})
    return align.aligned(boxes, own, SIDE, -9.0).withColumn("peak", F.round("peak", 6))


# --- a pyramid that is kept up to date -------------------------------------------------------------------------

_CUBE = "cast(vec_id % 60 % 5 as integer) as x, cast(vec_id % 60 // 5 % 4 as integer) as y, cast(vec_id % 60 // 20 as integer) as z"


def _updated(spark, d) -> str:
    """A pyramid of all volumes, and an update after one cube of each has changed."""
    folder = f"{work_dir(spark)}/pyramid-{uuid.uuid4().hex}"
    first = written(volumes(spark, d))
    levels.update(spark, folder, first, SIDE)
    # the cube of each volume's eighth vector: voxels (8..11, 4..7, 0..3)
    part = chunks.voxels(first.where("cx = 1 and cy = 0 and cz = 0"), SIDE)
    raised = F.when((F.col("x") < 12) & (F.col("y") >= 4) & (F.col("z") < 4), F.col("v") + 1).otherwise(F.col("v"))
    rows = part.withColumn("v", raised).groupBy("vol_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("z", "y", "x", "v"))), lambda s: s["v"]).alias("new"))  # the voxels of one chunk
    second = first.join(rows, "vol_id").withColumn("data", F.when(F.expr("cx = 1 and cy = 0 and cz = 0"), F.col("new")).otherwise(F.col("data"))).drop("new")
    levels.update(spark, folder, second, SIDE)
    return folder


@query(f"""with grid as (select vol_id, cast(x as integer) as x, cast(y as integer) as y, cast(z as integer) as z from (select distinct vec_id // 60 as vol_id from embeddings), range(5) a(x), range(4) b(y), range(3) c(z)),
    means as (select vec_id // 60 as vol_id, {_CUBE}, list_avg(list_transform(embedding, lambda v: cast(v as double))) as v from embeddings)
    select g.vol_id, g.x, g.y, g.z, round(coalesce(v, 0) + case when g.x = 2 and g.y = 1 and g.z = 0 then 1 else 0 end, 6) + 0.0::double as v from grid g left join means m on m.vol_id = g.vol_id and m.x = g.x and m.y = g.y and m.z = g.z""")
def pyramid_updated(spark, d):
    """The top of each volume's pyramid after an update: a voxel for each cube."""
    folder = _updated(spark, d)
    return _rounded(chunks.voxels(levels.stored(spark, folder, 2), SIDE))


@query("select vec_id // 60 as vol_id, cast(level as integer) as level, cast(case when level = 0 then 1 else 0 end as integer) as cx, 0 as cy, 0 as cz from (select distinct vec_id // 60 * 60 as vec_id from embeddings), range(3) l(level)")
def pyramid_rendered(spark, d):
    """What the update made: the changed chunk and its ancestors, of each volume."""
    return levels.versions(spark, _updated(spark, d)).where("version = 2").select("vol_id", "level", *chunks.AXES)
