"""Tables in the folder that driver and executors share, to cut a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def work_dir(spark) -> str:
    """The application's own folder in the session's spark.checkpoint.dir. Where none is set, local mode (tests) has a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="quadrille-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/quadrille-{spark.sparkContext.applicationId}"


def spread(df: DataFrame, rows: int = 5_000) -> DataFrame:
    """df dealt to many tasks, about `rows` rows each, for work in Python that a row makes long: a file of one row group would be a single task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    many = -(-df.count() // rows)
    return df.repartition(max(1, min(many, 64 * cores)))


def written(df: DataFrame) -> DataFrame:
    """df, written as a table to the shared folder and read again. Python workers on the way get BATCH_BYTES at a time, so that rows with long arrays do not make them grow."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_BYTES)
    spark.conf.set(_BYTES, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BYTES, before)
    return spark.read.schema(df.schema).parquet(path)
