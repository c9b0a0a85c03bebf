"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder the session names.

    ``spark.checkpoint.dir`` is the cluster's shared folder. A private
    temporary folder is used in local mode only, where there is one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="recordsieve-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df, path: str):
    """Write ``df`` as Parquet and read it back: cuts lineage, survives executor loss."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, on whatever file system it is."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def collect_garbage(spark: SparkSession) -> None:
    """Let go of what finished queries have left: Spark deletes shuffle files and broadcasts, and the driver's heap
    shrinks, only when the driver has collected the objects that name them. For jobs of many queries."""
    spark._jvm.System.gc()


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return [s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()]
