"""Folder for tables written on the way to a result."""

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """One per process, removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="marketlens-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`; a temporary one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
    return _local_folder().name


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody else writes to."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder that `new_folder` has named, once nothing reads it any more."""
    if not folder.startswith(f"{shared_folder(spark)}/"):
        raise ValueError(f"{folder} is no scratch folder of this session")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
