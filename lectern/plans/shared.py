"""Where intermediate tables live, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local master may fall back to a folder of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    at = tempfile.mkdtemp(prefix="lectern-")
    spark.sparkContext.setCheckpointDir(at)
    return at


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, survives the loss of executors and is computed once however often it is used. It is
    deleted when the application ends.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    jvm_path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
