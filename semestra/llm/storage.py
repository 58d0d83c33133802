"""Intermediate tables in the shared folder, and the checkpoint folder of a session."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, as in tests, one is made and set for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="semestra-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts lineage so that a lost executor costs no more than its running tasks.
    """
    path = new_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps now.

    Spark deletes them when the driver's garbage is collected; a driver with little to do
    may keep them for the whole of a long job.
    """
    gc.collect()
    spark._jvm.System.gc()


def dropped(frame: DataFrame) -> None:
    """Delete the files behind a frame from ``stored`` that nothing reads any more."""
    spark = frame.sparkSession
    folders = {file.rsplit("/", 1)[0] for file in frame.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
