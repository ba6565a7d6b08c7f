"""Sinks.  Tables are written by tasks; only a single document is written as one file."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .scratch import fresh_path


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_jsonl(df: DataFrame, path: str, append: bool = False, keep_nulls: bool = False) -> None:
    """One JSON object a line, UTF-8 as it is."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def append_lines(df: DataFrame, column: str, path: str) -> None:
    """A log of text lines."""
    df.select(F.col(column).cast("string")).write.mode("append").text(path)


def array_document(df: DataFrame, order: list[str], keep_nulls: bool = False) -> DataFrame:
    """One row ``value``: all rows as a JSON array, in order.  A document is one string and so one task's work."""
    rest = [c for c in df.columns if not c.startswith("_")]
    one = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*rest).alias("r"))
    return df.agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["r"]).alias("a")).select(F.to_json("a", {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value"))


def write_document(row: DataFrame, path: str) -> None:
    """Writes a single row's text as one file."""
    row.coalesce(1).write.mode("overwrite").text(path)


def dictionary_document(nodes: DataFrame, edges: DataFrame, node_order: list[str], edge_order: list[str]) -> DataFrame:
    """``{"nodes": [...], "edges": [...]}`` with explicit nulls, as one row ``value``."""
    n = array_document(nodes, node_order, keep_nulls=True).select(F.lit('{"nodes":').alias("head"), "value")
    e = array_document(edges, edge_order, keep_nulls=True).select(F.lit(',"edges":').alias("head"), "value")
    part = lambda head: F.max(F.when(F.col("head") == head, F.concat("head", "value")))
    return n.unionByName(e).agg(F.concat(part('{"nodes":'), part(',"edges":'), F.lit("}")).alias("value"))


def write_ordered(spark: SparkSession, path: str, *pieces: str | tuple[DataFrame, list[str]], keep_nulls: bool = False) -> None:
    """Writes one file out of texts and JSON arrays, in turn, whose rows are written by all tasks.

    An array is ``(rows, order)``; columns whose names begin with an underscore are left out
    of it.  Rows are range partitioned along the order and each partition writes its part, the
    commas being the line ends of Spark's text writer.  The parts are then copied one after
    another through a buffer, an array's last without its comma, into a file that appears when
    it is complete.  No task and no row holds the document.
    """
    work, parts = fresh_path(spark, "document"), []
    for n, piece in enumerate(pieces):
        if isinstance(piece, str):
            parts.append(piece)
            continue
        rows, order = piece
        rest = F.struct(*[c for c in rows.columns if not c.startswith("_")])
        placed = rows.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], rest.alias("r")).orderBy(*[f"_o{i}" for i in range(len(order))], "r")
        folder = f"{work}/{n}"
        placed.select(F.to_json("r", {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value")).write.option("lineSep", ",").text(folder)
        fs, at = _filesystem(spark, folder)
        held = sorted((s.getPath().toString(), s.getLen()) for s in fs.listStatus(at) if s.getPath().getName().startswith("part-") and s.getLen())
        parts += ["[", *[(p, size - (k == len(held))) for k, (p, size) in enumerate(held, 1)], "]"]
    _joined(spark, parts, path)
    fs, at = _filesystem(spark, work)
    fs.delete(at, True)


def _joined(spark: SparkSession, parts: list[str | tuple[str, int]], path: str) -> None:
    """Texts and the first bytes of files one after another as ``path``."""
    jvm = spark._jvm
    fs, target = _filesystem(spark, path)
    _, draft = _filesystem(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    try:
        for part in parts:
            if isinstance(part, str):
                out.write(bytearray(part.encode()))
                continue
            held, at = _filesystem(spark, part[0])
            source = held.open(at)
            try:
                jvm.org.apache.commons.io.IOUtils.copyLarge(source, out, 0, part[1])
            finally:
                source.close()
    finally:
        out.close()
    fs.delete(target, True)
    if not fs.rename(draft, target):
        raise OSError(f"cannot write {path}")


def append_batch(df: DataFrame, folder: str, batch: int | str) -> bool:
    """Appends a batch of records to a log once; whether it was added now.

    Rows go to a folder of this attempt, and count when its name stands in the batch's entry
    of the manifest, which is put in place by one rename.  A batch that comes again finds the
    entry and adds nothing; files of attempts that failed are read by nobody.
    """
    spark = df.sparkSession
    fs, entry = _filesystem(spark, f"{folder}/batches/{batch}.txt")
    if fs.exists(entry):
        return False
    attempt = f"{batch}-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/rows/{attempt}")
    _, draft = _filesystem(spark, f"{folder}/batches/{attempt}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(attempt.encode()))
    out.close()
    if fs.rename(draft, entry):
        return True
    fs.delete(draft, False)
    return False


def read_log(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    """The rows of all batches of a log, with ``_batch``, the name of the batch."""
    fs, at = _filesystem(spark, f"{folder}/batches")
    names = [s.getPath().toString() for s in fs.listStatus(at) if s.getPath().getName().endswith(".txt")] if fs.exists(at) else []
    attempts = [r[0] for r in spark.read.text(names).collect()] if names else []  # one name for each batch
    if not attempts:
        return spark.createDataFrame([], schema).withColumn("_batch", F.lit(None).cast("string"))
    rows = spark.read.schema(schema).parquet(*[f"{folder}/rows/{a}" for a in attempts])
    return rows.withColumn("_batch", F.regexp_extract(F.col("_metadata.file_path"), r"/rows/(.*)-[0-9a-f]{32}/", 1))


def stamp(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("_%Y%m%d_%H%M%S")


def backed_up(spark: SparkSession, folder: str, suffix: str = ".json", when: str | None = None) -> list[str]:
    """Moves a folder's documents below ``backup/backup<stamp>``; what was moved, by new name."""
    fs, base = _filesystem(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    moved = []
    if not fs.exists(base):
        return moved
    found = [s.getPath() for s in fs.listStatus(base) if s.getPath().getName().endswith(suffix)]
    if found:
        target = path(base, f"backup/backup{when or stamp()}")
        fs.mkdirs(target)
        for p in found:
            to = path(target, p.getName())
            if not fs.rename(p, to):
                raise OSError(f"cannot move {p.toString()}")
            moved.append(to.toString())
    return moved


def write_partial_then_raise(partial: DataFrame, path: str, error: Exception) -> None:
    """Keeps what a failed step had, beside its target, and fails."""
    write_jsonl(partial, f"{path}_partial_debug")
    raise error


def write_store(docs: DataFrame, path: str) -> None:
    """Vector documents as a table; later opens prune columns and push id filters down."""
    docs.write.mode("overwrite").parquet(path)
