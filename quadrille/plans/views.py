"""The engine's data model over the synthetic tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIMS = (754, 1035, 199, 2)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tiles(spark: SparkSession, sf_dir: str, jitter: bool = True) -> DataFrame:
    """id, path, ori, shape, dims, dtype and the flat columns o, s, e for each axis, from orders."""
    k = F.col("o_orderkey")
    own = F.col("o_custkey")
    o = [F.pmod(k, F.lit(25)) * 317200 + (F.pmod(own, F.lit(7)) * 100 if jitter else F.lit(0)), F.pmod(F.floor(k / 25), F.lit(25)) * 487500, F.floor(k / 625) * 300000]
    s = [377200 + (F.pmod(own, F.lit(3)) * 1000 if jitter else F.lit(0)), F.lit(517500), F.lit(398000)]
    path = F.concat(F.lit("/data/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/"), F.lpad(k.cast("string"), 6, "0"))
    flat = [c.cast("long").alias(f"{n}{d}") for n, cs in (("o", o), ("s", s)) for d, c in enumerate(cs)]
    out = read(spark, sf_dir, "orders").select(k.alias("id"), path.alias("path"), *flat)
    return out.withColumns({f"e{d}": F.col(f"o{d}") + F.col(f"s{d}") for d in range(3)})


def boxed(df: DataFrame, name: str = "box") -> DataFrame:
    box = F.struct(F.array("o0", "o1", "o2").alias("ori"), F.array("s0", "s1", "s2").alias("shape"))
    return df.withColumn(name, box)


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vol_id and the 64 values of a 4 x 4 x 4 volume, x fastest, from embeddings."""
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("vol_id"), F.transform("embedding", lambda v: v.cast("double")).alias("v"))


def voxels(df: DataFrame, column: str = "v") -> DataFrame:
    """One row per voxel: vol_id, x, y, z, v."""
    # the outer form spares a filter on the array's size, which would be pushed down with all that makes the array
    rows = df.select("vol_id", F.posexplode_outer(column).alias("i", "v")).where("i is not null")
    at = lambda n: F.floor(F.col("i") / n) % 4
    return rows.select("vol_id", at(1).cast("int").alias("x"), at(4).cast("int").alias("y"), at(16).cast("int").alias("z"), "v")
