"""A folder tree as a catalogue: leaf folders with a metadata pair are tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textproto, tilesource, volumes, yamlcache
from .tables import written

SCHEMA = "path string, format string, ndim int, ori array<bigint>, shape array<bigint>, dtype string, dims array<bigint>, crop array<bigint>, transform array<float>, volume string, error string"


def folder(path) -> F.Column:
    return F.regexp_extract(F.regexp_replace(path, "^file:/+", "/"), "^(.*)/[^/]*$", 1)


def leaves(files: DataFrame) -> DataFrame:
    """Folders that hold files and no folder; hidden ones do not count."""
    dirs = files.select(folder(F.col("path")).alias("dir")).where(~F.col("dir").rlike(r"/\.")).distinct()
    above = dirs.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("dir", "/")) - 1), lambda k: F.array_join(F.slice(F.split("dir", "/"), 1, k), "/"))).alias("dir")).distinct()
    return dirs.join(above, "dir", "left_anti")


def scan(spark: SparkSession, path: str, version: str | None = None, dims: list[int] | None = None, dtype: str | None = None) -> DataFrame:
    """One row per leaf folder with metadata; rows that cannot be read say why.

    Metadata files are small and parsed by Arrow-batched tasks; a volume's pixel shape comes from its file unless given.
    """
    import pandas as pd

    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    small = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{microscope,acquisition}").load(path)
    ends = small.select(folder(F.col("path")).alias("dir"), F.regexp_extract("path", r"\.(\w+)$", 1).alias("kind"), F.col("content").cast("string").alias("text"), "path")
    pairs = ends.groupBy("dir").agg(*[F.min_by("text", F.when(F.col("kind") == k, F.col("path"))).alias(k) for k in ("microscope", "acquisition")])
    tiles = pairs.join(leaves(every), "dir", "left_semi")
    if dims is None:
        # the first channel's file is opened for its header alone, where it lies on a file system that all executors reach
        first = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.0.{npy,tif,tiff}").load(path)
        tiles = tiles.join(first.select(folder(F.col("path")).alias("dir"), F.col("path").alias("file"), F.regexp_extract("path", r"\.(\w+)$", 1).alias("ext")), "dir", "left")
    else:
        tiles = tiles.withColumns({"file": F.lit(None).cast("string"), "ext": F.lit(None).cast("string")})

    def row(r) -> tuple:
        try:
            meta = textproto.tile(r.microscope, r.acquisition, r.dir, version)
            size, kind = dims, dtype
            if size is None:
                size, kind = volumes.header_of(r.file, r.ext)
            return (r.dir, meta["format"], 3, meta["ori"], meta["shape"], kind, size, size, textproto.transform(meta, size), meta["volume"], None)
        except Exception as e:
            return (r.dir, None, None, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}")

    def run(batches):
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for b in batches:
            yield pd.DataFrame([row(r) for r in b.itertuples()], columns=names).astype({"ndim": "Int32"})

    return tiles.mapInPandas(run, SCHEMA)


def catalogue(spark: SparkSession, path: str, cache: str = "auto", **options) -> DataFrame:
    """Tiles of the tree that can be read, by a walk of tasks. With cache auto, a folder that holds a catalogue gives the catalogue's tiles and is not entered, at the root or below."""
    found = tilesource.opened(spark, path, cache=cache, **options)
    return yamlcache.usable(found).select(*[c.split()[0] for c in SCHEMA.split(", ")])


def build(spark: SparkSession, path: str, into: str, **options) -> int:
    """Scans a tree, writes its YAML catalogue to the folder `into`, and gives the number of tiles."""
    tiles = written(catalogue(spark, path, **options))
    yamlcache.write(tiles, into, path.rstrip("/") + "/")
    return tiles.count()


def copy(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copies the files of all leaf folders to the same places below target, by tasks; gives file, size and where it went."""
    import pandas as pd

    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).select("path")
    files = every.withColumn("dir", folder(F.col("path"))).join(leaves(every), "dir", "left_semi").select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    root = source.removeprefix("file://").rstrip("/")

    def run(batches):
        from pyarrow import fs

        for b in batches:
            out = []
            for p in b["path"]:
                to = target.rstrip("/") + p[len(root) :]
                (store, at), (other, there) = fs.FileSystem.from_uri(p), fs.FileSystem.from_uri(to)
                other.create_dir(there.rsplit("/", 1)[0], recursive=True)
                fs.copy_files(at, there, source_filesystem=store, destination_filesystem=other)
                out.append((p, store.get_file_info(at).size, to))
            yield pd.DataFrame(out, columns=["path", "bytes", "copy"])

    return written(files.repartition("path").mapInPandas(run, "path string, bytes bigint, copy string"))
