"""Queries on a stored index of the tiles' boxes, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import boxindex
from ..sources.tables import work_dir
from . import views
from .catalogue import PLACES, TILES, _places, query

FAN = 16
BOX_AT, BOX_SIZE = (1_000_000, 2_000_000, 600_000), (3_000_000, 4_000_000, 900_000)


def _index(spark, d) -> str:
    folder = f"{work_dir(spark)}/index-{uuid.uuid4().hex}"
    boxindex.build(views.tiles(spark, d), folder, FAN)
    return folder


@query(f"with {TILES} select id, o0, o1, o2 from tiles where e0 > 1000000 and o0 < 4000000 and e1 > 2000000 and o1 < 6000000 and e2 > 600000 and o2 < 1500000")
def index_box(spark, d):
    """Tiles in one box: its leaves are found by descent and read by ranges."""
    return boxindex.in_box(spark, _index(spark, d), list(BOX_AT), list(BOX_SIZE)).select("id", "o0", "o1", "o2")


@query(f"""with {TILES}, {PLACES} select b.id as query, count(*) as n, min(a.id) as first from places b join tiles a
    on least(a.e0, b.e0) > greatest(a.o0, b.o0) and least(a.e1, b.e1) > greatest(a.o1, b.o1) and least(a.e2, b.e2) > greatest(a.o2, b.o2) group by b.id""")
def index_hits(spark, d):
    """How many tiles each part's box hits."""
    q = _places(spark, d).withColumnRenamed("id", "query")
    return boxindex.hits(spark, _index(spark, d), q).groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))


@query(f"""with recursive {TILES}, l(level, n) as (select 0, cast(ceil(count(*) / 16.0) as bigint) from tiles union all select level + 1, cast(ceil(n / 16.0) as bigint) from l where n > 1)
    select cast(level as integer) as level, n, (select min(o0) from tiles) as o0, (select max(e0) from tiles) as e0, (select min(o2) from tiles) as o2, (select max(e2) from tiles) as e2 from l""")
def index_levels(spark, d):
    """Nodes of each level, and what they cover."""
    tree = boxindex.levels(spark, _index(spark, d))
    return tree.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.min("o0").alias("o0"), F.max("e0").alias("e0"), F.min("o2").alias("o2"), F.max("e2").alias("e2"))
