"""Tiles that arrive over time: a file stream of catalogue rows, kept as the newest row of each path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import written


def newest(rows: DataFrame, order: str = "seq") -> DataFrame:
    w = Window.partitionBy("path").orderBy(F.col(order).desc())
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def ingest(spark: SparkSession, source: str, schema: str, catalogue: str, checkpoint: str) -> StreamingQuery:
    """Appends new parquet files of tiles (with a seq) to the catalogue, a folder with one version for each batch."""

    def put(batch: DataFrame, epoch: int) -> None:
        fresh = newest(batch).withColumn("epoch", F.lit(epoch))
        fresh.write.mode("overwrite").parquet(f"{catalogue}/epoch={epoch}")  # a batch that is tried again writes the same place

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, catalogue: str) -> DataFrame:
    return newest(spark.read.option("recursiveFileLookup", "true").parquet(catalogue))


def compact(spark: SparkSession, catalogue: str) -> DataFrame:
    """The newest rows as one table."""
    return written(current(spark, catalogue))
