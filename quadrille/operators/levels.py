"""Pyramids of chunked volumes that are kept up to date: what changed climbs the tree, and only those nodes are made again.

A pyramid is a folder of versions. A version's rows are the chunks that it made (or found gone) at each level, with a fingerprint; what a node
holds now is its row of the highest version. An update compares the fingerprints of the finest chunks with those stored, makes the parents of
the chunks that differ from their children, and goes on from the parents that came out different.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import written
from . import chunks as C

NODE = f"level int, {C.CHUNK}, print bigint, print2 bigint, gone boolean"
_KEY = ["vol_id", *C.AXES]


def _printed(chunks: DataFrame, level: int) -> DataFrame:
    """Chunks of one level with two fingerprints of what they hold."""
    return chunks.select(
        F.lit(level).alias("level"), "vol_id", "dims", *C.AXES, "key", "data", F.xxhash64("dims", "data").alias("print"), F.xxhash64(F.lit(1), "data", "dims").alias("print2"), F.lit(False).alias("gone")
    )


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of every version."""
    return spark.read.schema(f"{NODE}, version int").parquet(folder)


def stored(spark: SparkSession, folder: str, level: int | None = None) -> DataFrame:
    """The nodes as they are now. The newest version of each is found on keys alone; data are read once, for what is left."""
    rows = versions(spark, folder)
    rows = rows if level is None else rows.where(F.col("level") == level)
    newest = rows.groupBy("level", "vol_id", "key").agg(F.max("version").alias("version"))
    return rows.join(newest, ["level", "vol_id", "key", "version"], "left_semi").where("not gone").drop("version", "gone")


def _differ(new: DataFrame, old: DataFrame) -> DataFrame:
    """Keys of chunks that are new, changed or gone (gone: not in new)."""
    a = new.select("vol_id", "key", *C.AXES, F.col("print").alias("p"), F.col("print2").alias("q"))
    b = old.select(F.col("vol_id").alias("v"), F.col("key").alias("k"), *[F.col(c).alias(f"_{c}") for c in C.AXES], F.col("print").alias("op"), F.col("print2").alias("oq"), F.col("dims").alias("odims"))
    met = a.join(b, (F.col("vol_id") == F.col("v")) & (F.col("key") == F.col("k")), "full_outer")
    met = met.where(~(F.col("p").eqNullSafe(F.col("op")) & F.col("q").eqNullSafe(F.col("oq"))))
    return met.select(F.coalesce("vol_id", "v").alias("vol_id"), F.coalesce("key", "k").alias("key"), *[F.coalesce(c, f"_{c}").alias(c) for c in C.AXES], F.col("p").isNull().alias("gone"), "odims")


def _rows_of(changed: DataFrame, new: DataFrame, level: int) -> DataFrame:
    """What a version keeps of one level: changed chunks, and marks of those that are gone."""
    kept = new.join(changed.where("not gone").select("vol_id", "key"), ["vol_id", "key"], "left_semi").select("level", "vol_id", "dims", *C.AXES, "key", "data", "print", "print2", "gone")
    marks = changed.where("gone").select(
        F.lit(level).alias("level"), "vol_id", F.col("odims").alias("dims"), *C.AXES, "key", F.lit(None).cast("array<double>").alias("data"), F.lit(None).cast("bigint").alias("print"), F.lit(None).cast("bigint").alias("print2"), F.lit(True).alias("gone")
    )
    return kept.unionByName(marks)


def update(spark: SparkSession, folder: str, chunks: DataFrame, side: int) -> int:
    """Brings the pyramid in a folder up to the given chunks of the finest level (the whole table); gives the version that it wrote, or the last one if nothing
    has changed.

    The first update makes everything. Levels go up until each volume is one chunk.
    """
    old, version = _now(spark, folder)
    now, level, out = written(_printed(chunks, 0)), 0, None
    changed = written(_differ(now, old.where("level = 0")))
    if changed.isEmpty():
        return version
    while True:
        part = _rows_of(changed, now, level)
        out = part if out is None else out.unionByName(part)
        # a volume that is one chunk has no parent
        largest = now.agg(F.max(F.array_max("dims"))).head()[0]
        before = old.agg(F.max("level")).head()[0]
        if (largest is None or largest <= side) and (before is None or before <= level):
            break
        parents = changed.select("vol_id", *[F.floor(F.col(c) / 2).cast("int").alias(c) for c in C.AXES]).distinct()
        above = [F.floor(F.col(c) / 2).cast("int").alias(f"_{c}") for c in C.AXES]
        many = now.where(F.array_max("dims") > side).select("vol_id", "dims", *C.AXES, "key", "data", *above)
        asked = parents.select("vol_id", *[F.col(c).alias(f"_{c}") for c in C.AXES])
        children = many.join(asked, ["vol_id", *[f"_{c}" for c in C.AXES]], "left_semi")
        level += 1
        made = written(_printed(C.halved(children, side), level))
        was = old.where(F.col("level") == level)
        changed = written(_differ(made, was.join(parents, _KEY, "left_semi")))
        # the level as a whole: nodes that nothing below touched stay as they were
        kept = was.join(parents, _KEY, "left_anti").withColumn("gone", F.lit(False))
        now = written(made.unionByName(kept.select(made.columns)))
    out.write.parquet(f"{folder}/version={version + 1}")
    return version + 1


def _now(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """What the folder holds, and its highest version (0: it is new)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], NODE).drop("gone"), 0
    last = versions(spark, folder).agg(F.max("version")).head()[0]
    return written(stored(spark, folder)), last or 0
