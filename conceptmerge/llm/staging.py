"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import fresh_path

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows a batch for whole texts, which bounds a worker's memory.
FEW = 512


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings (underscores for dots are not translated: pass a dict) for the time of a block."""
    changes = values.pop("values", {}) | values
    before = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, label: str, rows_a_batch: int | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage like a reliable checkpoint: a lost executor costs only the tasks
    it was running, and the shuffle files behind the table are given back at once.
    ``rows_a_batch`` holds for the Arrow batches of this table's Python steps alone: few rows
    where each may be a long text.  ``codec`` is the table's compression, the session's if not given.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    batch = {} if rows_a_batch is None else {_BATCH: str(rows_a_batch)}
    with settings(spark, values={_CLEAN: "true"} | batch):
        df.write.options(**({"compression": codec} if codec else {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in tables:
        path = getattr(df, "_staged_at", None)
        if path:
            delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` does not have, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
