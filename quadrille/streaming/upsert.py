"""A catalogue that follows a stream of tiles: the state of each path is its newest row, and only newer rows come out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

STATE = StructType([StructField("seq", LongType()), StructField("late", LongType())])


def newer(rows: DataFrame) -> DataFrame:
    """Rows of a stream (path, seq, any others) that are newer than all before of their path, one for each path and batch.

    The state of a path holds the highest seq and how many late rows it has had: a row that is not newer is late, whenever it comes, and is only counted. Of rows
    with one seq the first wins. `late` is the count so far. Paths are dealt by hash; a batch's rows of one path meet in one group, in
    parts of a batch each, of which only the newest row is held.
    """
    columns = rows.columns
    schema = StructType([*rows.schema.fields, StructField("late", LongType())])

    def upsert(_key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seq, late = state.get if state.exists else (None, 0)
        best = None
        for part in parts:
            part = part[part["seq"].notna()]
            if not len(part):
                continue
            top = part.loc[[part["seq"].idxmax()]]
            high = int(top["seq"].iloc[0])
            fresh = seq is None or high > seq
            late += len(part) - int(fresh) + int(fresh and best is not None)
            if fresh:
                seq, best = high, top
        if seq is not None:
            state.update((seq, late))
        if best is not None:
            yield best[columns].assign(late=late)

    return rows.groupBy("path").applyInPandasWithState(upsert, schema, STATE, "update", GroupStateTimeout.NoTimeout)


def follow(spark: SparkSession, source: str, schema: str, catalogue: str, checkpoint: str, per_batch: int | None = None) -> StreamingQuery:
    """Appends what new parquet files of tiles change to the catalogue, a folder with one version for each batch; what came before a stop is known after it."""
    reader = spark.readStream.schema(schema)
    reader = reader if per_batch is None else reader.option("maxFilesPerTrigger", per_batch)

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{catalogue}/epoch={epoch}")  # a batch that is tried again writes the same place

    return newer(reader.parquet(source)).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, catalogue: str) -> DataFrame:
    """The newest row of each path: that of its last epoch, since what comes out of the stream is newer each time."""
    w = Window.partitionBy("path").orderBy(F.col("epoch").desc())
    return spark.read.parquet(catalogue).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "epoch")
