"""A persistent index of boxes: a packed tree as a table of levels, over entries that lie in the files in the tree's order.

Boxes are ordered by the Morton key of their centres and packed, `fan` to a leaf, `fan` leaves to a node, and so on up to the root. Each level is a table of
node, parent and bounds; queries descend by joins of (query, node) with the node's children, and only children that a query hits
go on. Entries of neighbouring leaves lie in the same files, so a box's leaves are few ranges, which the scan gets as filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import written
from .chunks import morton

_BOX = [f"{c}{d}" for c in "oe" for d in range(3)]
_GRID = 1 << 21


def _key(row) -> Column:
    """The Morton key of a box's centre on a grid of 2^21 cells over the bounds."""
    at = []
    for d in range(3):
        low, high = float(row[f"low{d}"]), float(row[f"high{d}"])
        place = ((F.col(f"o{d}").cast("double") + F.col(f"e{d}")) / 2 - low) / max(high - low, 1.0)
        at.append(F.least(F.floor(place * _GRID), F.lit(_GRID - 1)))
    return morton(*at)


def ranked(df: DataFrame, order: list[str], rank: str = "rank") -> DataFrame:
    """A number for each row by these columns. Rows are sorted by ranges; a row's number is its place in its range behind the counts of those before."""
    part = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = part.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))  # a row for each range
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return part.withColumn("_place", place).join(before, "_part").withColumn(rank, (F.col("_before") + F.col("_place")).cast("bigint")).drop("_part", "_before", "_place")


def _bounds(by: str) -> list[Column]:
    return [F.min(c).alias(c) if c[0] == "o" else F.max(c).alias(c) for c in _BOX]


def build(boxes: DataFrame, folder: str, fan: int = 256) -> None:
    """Writes the index of boxes (id, o0..o2, e0..e2; those without extent are left out) to a folder."""
    boxes = boxes.select("id", *_BOX).where(" and ".join(f"e{d} > o{d}" for d in range(3)))
    row = boxes.agg(*[F.min(f"o{d}").alias(f"low{d}") for d in range(3)], *[F.max(f"e{d}").alias(f"high{d}") for d in range(3)]).head()
    if row["low0"] is None:
        boxes.withColumn("leaf", F.lit(0).cast("bigint")).write.parquet(f"{folder}/entries")
        boxes.sparkSession.createDataFrame([], "level int, node bigint, parent bigint, " + ", ".join(f"{c} bigint" for c in _BOX)).write.parquet(f"{folder}/levels")
        return
    entries = ranked(boxes.withColumn("_key", _key(row)), ["_key", "id"]).withColumn("leaf", F.floor(F.col("rank") / fan))
    entries.drop("_key", "rank").repartitionByRange("leaf").sortWithinPartitions("leaf", "id").write.parquet(f"{folder}/entries")
    level = boxes.sparkSession.read.parquet(f"{folder}/entries").groupBy(F.col("leaf").alias("node")).agg(*_bounds("leaf"))
    at, out = 0, None
    while True:
        level = written(level.withColumns({"level": F.lit(at), "parent": F.floor(F.col("node") / fan)}))
        out = level if out is None else out.unionByName(level)
        if level.agg(F.max("node")).head()[0] == 0:
            break
        level, at = level.groupBy(F.col("parent").alias("node")).agg(*_bounds("parent")), at + 1
    out.select("level", "node", "parent", *_BOX).repartitionByRange("level", "node").sortWithinPartitions("level", "node").write.parquet(f"{folder}/levels")


def levels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/levels")


def entries(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/entries")


def _hit(a: str, b: str) -> Column:
    out = None
    for d in range(3):
        one = F.least(F.col(f"{a}e{d}"), F.col(f"{b}e{d}")) > F.greatest(F.col(f"{a}o{d}"), F.col(f"{b}o{d}"))
        out = one if out is None else out & one
    return out


def leaves(spark: SparkSession, folder: str, queries: DataFrame) -> DataFrame:
    """query, leaf: the leaves that the boxes of queries (query, o, e) hit, by descent from the root."""
    tree = levels(spark, folder)
    top = tree.agg(F.max("level")).head()[0]
    q = queries.select("query", *[F.col(c).alias(f"q{c}") for c in _BOX])
    if top is None:
        return q.select("query", F.lit(0).cast("bigint").alias("leaf")).limit(0)
    now = q.withColumn("node", F.lit(0).cast("bigint"))
    for k in range(top, -1, -1):
        here = tree.where(F.col("level") == k).select("node", F.col("parent").alias("_up"), *_BOX)
        met = now.join(here, "node") if k == top else now.withColumnRenamed("node", "_up").join(here, "_up")
        now = met.where(_hit("q", "")).select("query", *[f"q{c}" for c in _BOX], "node")
    return now.select("query", F.col("node").alias("leaf"), *[f"q{c}" for c in _BOX])


def hits(spark: SparkSession, folder: str, queries: DataFrame) -> DataFrame:
    """query, id of every entry that a query's box hits."""
    found = leaves(spark, folder, queries)
    if "qo0" not in found.columns:
        return found.select("query", F.col("leaf").alias("id"))
    return found.join(entries(spark, folder), "leaf").where(_hit("q", "")).select("query", "id")


def in_box(spark: SparkSession, folder: str, ori: list[int], shape: list[int], most: int = 1000) -> DataFrame:
    """Entries that one box hits. Its leaves become ranges in the scan's filter, `most` at most (nearby ones are joined), so files without them are not read."""
    box = spark.createDataFrame([(0, *ori, *[o + n for o, n in zip(ori, shape)])], "query bigint, " + ", ".join(f"{c} bigint" for c in _BOX))
    found = leaves(spark, folder, box).select("leaf").distinct()
    # runs of successive leaves; more than `most` of them are read as the one range that holds all
    w = Window.orderBy("leaf")
    runs = found.withColumn("_run", F.col("leaf") - F.row_number().over(w)).groupBy("_run").agg(F.min("leaf").alias("a"), F.max("leaf").alias("b"))
    ranges = [(r["a"], r["b"]) for r in runs.orderBy("a").limit(most + 1).collect()]
    df = entries(spark, folder)
    if not ranges:
        return df.where(F.lit(False))
    if len(ranges) > most:
        low, high = found.agg(F.min("leaf"), F.max("leaf")).head()
        ranges = [(low, high)]
    near = None
    for a, b in ranges:
        one = F.col("leaf").between(a, b)
        near = one if near is None else near | one
    inside = None
    for d in range(3):
        one = (F.col(f"o{d}") < ori[d] + shape[d]) & (F.col(f"e{d}") > ori[d])
        inside = one if inside is None else inside & one
    return df.where(near).where(inside if all(n > 0 for n in shape) else F.lit(False))
