"""Shared intermediate tables as Parquet, so that a plan that uses one several times neither grows nor repeats work."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


_paths: list[str] = []


def sweep(spark: SparkSession) -> None:
    """Delete all that path_for() named so far: to be called when no result of a query is read any more."""
    while _paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(_paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_for(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which driver and executors share. A machine's own folder would lose rows, so there is no other."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    _paths.append(f"{base.rstrip('/')}/strandwise/{name}-{uuid.uuid4().hex}")
    return _paths[-1]


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again."""
    path = path_for(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
