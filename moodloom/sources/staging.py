"""Tables written between the stages of a job.

They live in the folder the cluster names in ``spark.checkpoint.dir``, which every executor
reaches, so a lost executor costs a re-read and never the stages before.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder; a local temporary one only where Spark itself runs locally."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="moodloom-"))
        shared = context.getCheckpointDir()
    return shared.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{staging_root(spark)}/moodloom/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so later passes do not repeat its work."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
