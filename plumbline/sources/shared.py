"""The shared folder for checkpoints and written intermediate tables."""
from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a cluster the
    setting is required, since executors do not share a machine's temporary folder. The folder is
    deleted through its own file system when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="plumbline-")
        spark.sparkContext.setCheckpointDir(root)
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{purpose}-{uuid4().hex}")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(top)
    files.deleteOnExit(top)
    return f"{top.toString()}/data"


def settled(df: DataFrame, purpose: str = "table") -> DataFrame:
    """Write a table once to the shared folder and read it back, cutting its lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
