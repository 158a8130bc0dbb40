"""Queries over real files: trees and catalogues that tasks write from the tables to the shared folder, and that Spark then reads. Each has its SQL."""

from __future__ import annotations

import io
import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import folders, tilesource, yamlcache
from ..sources.tables import spread, work_dir, written
from . import views
from .catalogue import _SCOPES, TILES, query

#: Tiles of the customers: a folder for each below its segment and nation. Nations divisible by five have a catalogue instead, over folders with broken metadata.
PLACED = """placed as (
    select c_custkey as id, c_nationkey % 5 = 0 as cached, '/' || replace(lower(c_mktsegment), ' ', '-') || '/' || lpad(cast(c_nationkey as varchar), 2, '0') as parent, lpad(cast(c_custkey as varchar), 9, '0') as name,
           c_custkey * 317251 % 90000007 as o0, c_custkey * 487517 % 80000023 as o1, c_custkey * 99991 % 9000011 as o2, 377203 + c_custkey % 91 as s0, 517500 + c_custkey % 7 as s1, 100000 + c_custkey % 5 as s2
    from customer)"""
_NM = lambda c, scale: f"case when cached then {c} else cast(trunc(cast(cast(cast({c} as double) / {scale} as float) * cast({scale} as float) as double)) as bigint) end as {c}"
_READ = f"""{PLACED}, tiles as (select parent || '/' || name as path, case when not cached then 'v' || (id % 10) end as format, {", ".join(_NM(f"o{d}", "1e6") for d in range(3))}, {", ".join(_NM(f"s{d}", "1e3") for d in range(3))},
    '6,5,' || (2 + id % 3) as dims, 'u16' as dtype from placed)"""


def placed(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    parent = F.concat(F.lit("/"), F.replace(F.lower("c_mktsegment"), F.lit(" "), F.lit("-")), F.lit("/"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))
    ori = [k * 317251 % 90000007, k * 487517 % 80000023, k * 99991 % 9000011]
    size = [377203 + k % 91, 517500 + k % 7, 100000 + k % 5]
    flat = [c.cast("bigint").alias(f"{n}{i}") for n, cs in (("o", ori), ("s", size)) for i, c in enumerate(cs)]
    return views.read(spark, d, "customer").select(k.alias("id"), (F.col("c_nationkey") % 5 == 0).alias("cached"), parent.alias("parent"), F.lpad(k.cast("string"), 9, "0").alias("name"), *flat)


def _put(path: str, data: bytes) -> None:
    store, at = folders.store_of(path)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(at) as f:
        f.write(data)


def _links(store):
    """Writes files by store. One that is equal to an earlier file of the same task is a link to it where the file system has links, so it takes no inode and no block."""
    from pyarrow import fs

    first: dict[bytes, str] = {}

    def put(at: str, data: bytes) -> None:
        if data in first:
            try:
                return os.link(first[data], at)
            except OSError:  # a file has links enough, or a task that ran before wrote this one
                pass
        with store.open_output_stream(at) as f:
            f.write(data)
        if isinstance(store, fs.LocalFileSystem):
            first[data] = at

    return put


def tree(spark, d) -> str:
    """Writes the tree by tasks; gives its root. Stacks and volumes of tiles are of few kinds, so a tile takes little more than the inodes of its folder and its position."""
    import numpy as np
    import pandas as pd

    root = folders.plain(f"{work_dir(spark)}/tree-{uuid.uuid4().hex}")

    def tiles(batches):
        store, base = folders.store_of(root)
        put, volumes = _links(store), []
        for n in range(2, 5):
            volume = io.BytesIO()
            np.save(volume, np.zeros((n, 5, 6), np.uint16))
            volumes.append(volume.getvalue())
        for b in batches:
            for r in b.itertuples():
                at = f"{base}{r.parent}/{r.name}"
                stack = f"x_mm: {r.o0 / 1e6!r}\ny_mm: {r.o1 / 1e6!r}\nz_mm: {r.o2 / 1e6!r}\n"
                fov = f"fov {{ x_size_um: {r.s0 / 1e3!r} y_size_um: {r.s1 / 1e3!r} z_size_um: {r.s2 / 1e3!r} rotation_radians: 0 }}"
                store.create_dir(at, recursive=True)
                with store.open_output_stream(f"{at}/a.acquisition") as f:
                    f.write(stack.encode())
                put(f"{at}/a.microscope", b"fov {" if r.cached else f'{fov} file_prefix: "vol" stack_extension: ".npy" {_SCOPES[r.id % 10]}'.encode())
                put(f"{at}/{r.name}-vol.0.npy", volumes[r.id % 3])
            yield pd.DataFrame({"n": [len(b)]})

    def catalogue(pdf: pd.DataFrame) -> pd.DataFrame:
        parent = pdf["parent"].iloc[0]
        rows = [{"path": f"{root}{parent}/{r.name}", "ori": [r.o0, r.o1, r.o2], "shape": [r.s0, r.s1, r.s2], "dtype": "u16", "dims": [6, 5, 2 + r.id % 3], "crop": None, "transform": [1.0] * 16} for r in pdf.itertuples()]
        _put(f"{root}{parent}/all.cache.yml", yamlcache.dump(rows, f"{root}{parent}/").encode())
        return pd.DataFrame({"n": [len(rows)]})

    own = placed(spark, d)
    written(spread(own).mapInPandas(tiles, "n bigint"))
    written(own.where("cached").groupBy("parent").applyInPandas(catalogue, "n bigint"))
    return root


def _relative(df: DataFrame, root: str, column: str = "path") -> DataFrame:
    return df.withColumn(column, F.substr(F.col(column), F.lit(len(root) + 1)))


def _shown(df: DataFrame, root: str) -> DataFrame:
    flat = [f"{c}{i}" for c in "os" for i in range(3)]
    return _relative(df.where("error is null"), root).select("path", "format", *flat, F.array_join(F.transform("dims", lambda n: n.cast("string")), ",").alias("dims"), "dtype")


@query(f"""with {PLACED}, shown as (select parent, name, cached from placed), dirs as (
        select '' as dir, 'inner' as kind, count(distinct split_part(parent, '/', 2)) as children, 0 as files from shown
        union all select '/' || split_part(parent, '/', 2), 'inner', count(distinct parent), 0 from shown group by 1
        union all select parent, case when cached then 'cache' else 'inner' end, case when cached then 0 else count(*) end, cast(cached as int) from shown group by parent, cached
        union all select parent || '/' || name, 'leaf', 0, 3 from shown where not cached)
    select dir, kind, cast(children as integer) as children, cast(files as integer) as files from dirs""")
def tree_walk(spark, d):
    """Every folder that is listed: none below a catalogue."""
    root = tree(spark, d)
    return _relative(folders.walk(spark, root), root, "dir").select("dir", "kind", F.size("children").alias("children"), F.size("files").alias("files"))


@query(f"with {_READ} select * from tiles")
def tree_open(spark, d):
    """Tiles of a tree by its walk, level by level."""
    root = tree(spark, d)
    return _shown(tilesource.opened(spark, root), root)


@query(f"with {_READ} select * from tiles where starts_with(path, '/m') and o0 >= 20000000 and o0 + s0 <= 60000000 and o1 < 50000000")
def tree_source(spark, d):
    """Tiles of some segments in a box, from the data source: prefix and box are pushed down to it."""
    root = tree(spark, d)
    tilesource.register(spark)
    found = spark.read.format("tiles").option("tasks", "8").load(root)
    return _shown(found.where(F.col("path").startswith(f"{root}/m")).where("o0 >= 20000000 and e0 <= 60000000 and o1 < 50000000"), root)


@query(f"with {_READ} select path, cast(null as varchar) as format, o0, o1, o2, s0, s1, s2, dims, dtype from tiles")
def tree_saved(spark, d):
    """Opening a tree writes its catalogue, from which it is read again."""
    root = tree(spark, d)
    return _shown(tilesource.opened(spark, root, save=True), root)


@query(f"with {TILES} select path, o0, o1, o2, s0, s1, s2 from tiles where o0 + s0 > 3000000 and o0 < 4000000 and o2 >= 300000")
def catalogue_written(spark, d):
    """All tiles written as a catalogue with a commit, and a box read back: files whose bounds lie outside are not opened."""
    tilesource.register(spark)
    dims = F.array(*[F.lit(x).cast("long") for x in views.DIMS])
    t = views.tiles(spark, d).repartitionByRange(8, "o2", "o1").sortWithinPartitions("o0")  # a task's files are slices along the first axis
    rows = t.select("path", F.array("o0", "o1", "o2").alias("ori"), F.array("s0", "s1", "s2").alias("shape"), F.lit("u16").alias("dtype"), dims.alias("dims"), F.array(*[F.lit(0.5).cast("float")] * 25).alias("transform"))
    folder = f"{work_dir(spark)}/catalogue-{uuid.uuid4().hex}"
    rows.write.format("tiles").mode("append").save(folder)
    return spark.read.format("tiles").load(folder).where("e0 > 3000000 and o0 < 4000000 and o2 >= 300000").select("path", *[f"{c}{i}" for c in "os" for i in range(3)])


@query(f"""with {PLACED}, f as (select parent, min(id) % 4 = 0 as broken from placed group by parent)
    select case when f.broken then '' else p.parent || '/' || name end as path, case when f.broken or id % 3 = 0 then null else o0 end as o0, f.broken or id % 3 <> 1 as failed,
           case when f.broken then 'file' when id % 3 = 0 then 'ori' when id % 3 = 2 then 'unknown keys' end as what
    from placed p join f using (parent) where not f.broken or id in (select min(id) from placed group by parent)""")
def yaml_permissive(spark, d):
    """Catalogue files of which some are no YAML and some have records with a broken origin or a key that is not known: all other tiles are read."""
    import pandas as pd

    root = folders.plain(f"{work_dir(spark)}/yaml-{uuid.uuid4().hex}")

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        parent, body = pdf["parent"].iloc[0], []
        for r in pdf.itertuples():
            ori = "[x]" if r.id % 3 == 0 else f"[{r.o0}, {r.o1}, {r.o2}]"
            body.append(f"- path: /{r.name}\n  aabb: {{ori: {ori}, shape: [{r.s0}, {r.s1}, {r.s2}]}}\n" + ("  odd: 1\n" if r.id % 3 == 2 else ""))
        text = f"---\npath: {parent}\ntiles:\n{''.join(body)}" + ("  x: [1, 2\n}: {\n" if pdf["id"].min() % 4 == 0 else "")
        _put(f"{root}{parent}/one.cache.yml", text.encode())
        return pd.DataFrame({"n": [len(pdf)]})

    written(placed(spark, d).groupBy("parent").applyInPandas(put, "n bigint"))
    found = yamlcache.read(spark, root)
    what = F.when(F.col("path").isNull(), "file").when(F.col("error").startswith("ori"), "ori").when(F.col("error").startswith("unknown keys"), "unknown keys")
    return found.select(F.coalesce("path", F.lit("")).alias("path"), F.get("ori", F.lit(0)).alias("o0"), F.col("error").isNotNull().alias("failed"), what.alias("what"))
