"""A folder for what a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which all machines share; on a local master without the setting, below a temporary folder."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder for files of the job")
        at = "file://" + tempfile.mkdtemp(prefix="spanloom-")
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in a work folder and read back, for small tables that cost much to make and are read more than once."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
