"""Tables that a computation keeps between its steps, in a folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class NoSharedFolder(ValueError):
    """No folder is known that all machines of the cluster see."""


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder of the warehouse where that is unset.

    A warehouse on a machine's own disk is refused unless all of Spark runs on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    master = spark.sparkContext.master
    if warehouse.startswith("file:") and master != "local" and not master.startswith("local["):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse.rstrip('/')}/_work"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new shared folder; it goes when the driver's JVM ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path, store = _path(spark, folder)
    store.mkdirs(path)
    store.deleteOnExit(path)
    return folder


def kept(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes df as a Parquet table of the folder and returns the table, which cuts the lineage."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, folder: str) -> bool:
    """Removes a folder; whether it was there."""
    path, store = _path(spark, folder)
    return store.delete(path, True)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the folders in a folder."""
    path, store = _path(spark, folder)
    return [s.getPath().toString() for s in store.listStatus(path) if s.isDirectory()]
