"""The folder for intermediate results that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only in local mode without that setting."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="checkpoints-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{own}")
    return f"file://{own}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, rows_a_batch: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, read back: what follows does not run it again, whoever is lost.

    ``rows_a_batch`` holds for the Arrow batches of this table's Python steps alone: few where a row is large.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    before = spark.conf.get(_BATCH)
    try:
        if rows_a_batch:
            spark.conf.set(_BATCH, str(rows_a_batch))
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Deletes the files below the shared folder that ``df`` is read from, once nothing reads them any more."""
    spark = df.sparkSession
    own = shared_folder(spark)
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName() and own.partition(":")[2].strip("/") in folder:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
