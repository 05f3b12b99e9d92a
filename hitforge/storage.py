"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where that is unset, a local master gets a temporary folder; a cluster an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.sparkContext.setCheckpointDir(path)
    return path


def tables_dir(spark: SparkSession) -> str:
    """Where this application's intermediate tables are."""
    return f"{shared_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


#: Whether the shuffle files of an action go when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it: lineage ends there, it survives lost executors, and its size is known.

    What was shuffled for it is deleted when it is written, as nothing else reads that. The tables stay until ``clear``, as a
    result may be read at any later time.
    """
    spark = df.sparkSession
    path = f"{tables_dir(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables; results that were not saved can't be read afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
