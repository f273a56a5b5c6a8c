"""Cutting lineage through storage that every executor shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is a plain ``local`` one (tests), a temporary folder is
    made; on a cluster without the setting this raises, as a folder of one machine would be lost with it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder:
        if not context.getCheckpointDir():
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lexcurate-")
    atexit.register(shutil.rmtree, folder, True)
    context.setCheckpointDir(f"file://{folder}")
    return f"file://{folder}"


def work_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; removed when the driver's Python ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/lexcurate-{spark.sparkContext.applicationId}"
    if folder not in _made:
        _made.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


_made: set[str] = set()


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the JVM may be gone
        pass


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed now and read from reliable storage from here on; removed once it is no longer referenced,
    if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on. For small tables inside loops."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def tabled(df: DataFrame) -> DataFrame:
    """``df`` written as a compressed Parquet table in the shared folder and read again. For large intermediate
    results: columns stay prunable and the bytes stay few."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
