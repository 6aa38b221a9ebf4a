"""Cutting the lineage of a result that several jobs read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below `spark.checkpoint.dir`, or below the session's checkpoint folder.

    It must be one that all machines see, so on a cluster there is no default. A session
    that runs on one machine only uses its warehouse where neither is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        set_by_call = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not set_by_call.isEmpty():
            root = set_by_call.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/gleanery-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them from there.

    Unlike a checkpoint of the rows this computes them once, survives the loss of
    executors, and later readers fetch only the columns they need.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
