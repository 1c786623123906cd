"""Where jobs keep tables between stages and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`work_folder` named, once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path below ``spark.checkpoint.dir``, which the cluster shares.

    Only a local session, where all tasks run on this machine, may do without it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="clickloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a new work folder and read it again, for what is used more than once."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
