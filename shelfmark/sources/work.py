"""Tables that a job needs between its steps, in the folder that the cluster's machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.  A session on one machine may leave that unset; on a cluster, executors would each write to a
    disk of their own, so there it is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str) -> DataFrame:
    """df as a stored table: lineage ends here, and a lost executor costs a reread."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of an address."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)
