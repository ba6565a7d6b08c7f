"""Scans.  Files are read by Spark from any store; the driver only lists names."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import stable_id

STRICT, PERMISSIVE, RAISING, CHECKED = "strict", "permissive", "raising", "checked"


def numbered_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every line as it is, blank ones too: ``(_source, _source_rank, _line, _raw)``; rank is the place in ``paths``.

    One scan reads all files.  A task reads a block's lines one after another, so their row ids
    follow each other: a line's number is its row id less the least of its block, after the
    lines of the blocks before it.  What is joined is a row for each block (of some 128 MB);
    lines are never shuffled.  A path may be a pattern or a folder; its files are numbered
    each on its own, and a file that several paths name stands once for each.
    """
    if not paths:
        return spark.createDataFrame([], "_source string, _source_rank int, _line long, _raw string")
    named = [(file, path, rank) for rank, path in enumerate(paths) for file in spark.read.text(path).inputFiles()]
    files = {file for file, _, _ in named}
    distinct = list(dict.fromkeys(paths))
    if len({(file, path) for file, path, _ in named}) > len(files):  # patterns that overlap: one scan would read a file for each
        parts = [numbered_lines(spark, [path]).withColumn("_source_rank", F.lit(rank)) for rank, path in enumerate(paths)]
        return functools.reduce(DataFrame.unionByName, parts)
    lines = spark.read.text(distinct).select("value", F.input_file_name().alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = lines.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row for each block
    before = blocks.select("_file", "_block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_add"))
    ranks = spark.createDataFrame(named, "_file string, _source string, _source_rank int")
    numbered = lines.join(F.broadcast(before.join(F.broadcast(ranks), "_file")), ["_file", "_block"])
    return numbered.select("_source", "_source_rank", (F.col("_at") + F.col("_add")).alias("_line"), F.col("value").alias("_raw"))


def read_jsonl(spark: SparkSession, paths: Sequence[str] | str, schema: str, mode: str = STRICT, comments: bool = False) -> DataFrame:
    """Records of line files in the given schema, with ``_source, _source_rank, _line, _raw``.

    ``strict`` skips blank lines and fails on malformed ones; ``raising`` fails on both;
    ``permissive`` skips both; ``checked`` keeps all lines, with null records for what is
    malformed, as checks need them.  With ``comments`` lines that begin with ``#`` go first.
    """
    lines = numbered_lines(spark, [paths] if isinstance(paths, str) else list(paths))
    if comments:
        lines = lines.where(~F.col("_raw").startswith("#"))
    blank, sound = F.trim("_raw") == "", F.json_object_keys("_raw").isNotNull()
    if mode in (STRICT, PERMISSIVE):
        lines = lines.where(~blank)
    if mode == PERMISSIVE:
        lines = lines.where(sound)
    elif mode in (STRICT, RAISING):
        message = F.concat(F.lit("malformed line "), F.col("_source"), F.lit(":"), F.col("_line").cast("string"))
        lines = lines.withColumn("_raw", F.when(sound, F.col("_raw")).otherwise(F.raise_error(message)))
    return lines.withColumn("_r", F.from_json("_raw", schema)).select("_r.*", "_source", "_source_rank", "_line", "_raw")


def read_large_jsonl(spark: SparkSession, paths: Sequence[str] | str, schema: str, fail_fast: bool = True) -> DataFrame:
    """Records without line numbers, split and pushed down by Spark's own reader: for files of any size."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if fail_fast else "DROPMALFORMED").json(paths)


def read_json_array(spark: SparkSession, path: str, schema: str, missing_ok: bool = True) -> DataFrame:
    """Elements of one JSON array document, in order; what is missing, empty or no array has none."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        if not missing_ok:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], StructType.fromDDL(schema))
    whole = spark.read.text(path, wholetext=True).where(F.ltrim("value").startswith("["))
    return whole.select(F.posexplode(F.from_json("value", f"array<struct<{_fields(schema)}>>")).alias("_at", "_r")).select("_r.*", "_at")


def _fields(schema: str) -> str:
    return StructType.fromDDL(schema).simpleString().removeprefix("struct<").removesuffix(">")


def read_texts(spark: SparkSession, folder: str, pattern: str = "ch*.txt") -> DataFrame:
    """Whole text files as ``(document_id, text, _rank)``; the id is the file's name without its ending, the rank its place in the order of names.  None is an error."""
    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    held = [f.rpartition("/")[2] for f in files.inputFiles()]  # as a location has them: a space is %20
    if not held:
        raise FileNotFoundError(f"{folder}/{pattern}")
    names = [(rank, name, unquote(name).rpartition(".")[0] or unquote(name)) for rank, name in enumerate(sorted(held, key=unquote))]  # a row for each file
    ranks = F.broadcast(spark.createDataFrame(names, "_rank int, _name string, document_id string"))
    return files.select(F.col("_metadata.file_name").alias("_name"), F.col("value").alias("text")).join(ranks, "_name").select("document_id", "text", "_rank")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A table with tabs and a heading; a ``#`` before a column's name goes."""
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    return raw.toDF(*[c.lstrip("#") for c in raw.columns])


def processing_queue(spark: SparkSession, root: str, order: Sequence[str]) -> tuple[list[str], list[str]]:
    """Term and edge files under ``root`` in order of precedence; anything below an ``archive`` folder stays out.

    A file belongs to the source whose name, with or without ``src_``, is a folder on its path.
    """
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(base, True)
    found = []
    while files.hasNext():
        found.append(files.next().getPath().toString())
    prefix = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toString()
    terms: list[str] = []
    edges: list[str] = []
    for source in order:
        for path in sorted(found):
            folders = path.removeprefix(prefix).strip("/").split("/")
            if "archive" in folders or not {source, f"src_{source}"} & set(folders[:-1]):
                continue
            if folders[-1].endswith("terms.jsonl"):
                terms.append(path)
            elif folders[-1].endswith("edges.jsonl"):
                edges.append(path)
    return terms, edges


def formatted_terms(records: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Raw records in the layout of terms: ``fields`` names the source key of each field; discarded terms go."""
    from ..functions import scalars as s
    from ..schemas import DISCARD

    raw = F.col("_raw")
    key = lambda name: s.key_or_default(raw, fields.get(name, name))
    listed = ("gtc_id", "exact_synonyms", "evidence", "publication", "db_xref")
    plain = ("gsd_id", "classification", "definition", "description", "iupac_condensed", "raw_term")
    meta = F.struct(
        *[s.blank_to_null(F.get_json_object(raw, f"$.{fields.get(k, k)}")).alias(k) for k in plain],
        *[s.scalar_or_list(raw, f"$.{fields.get(k, k)}").alias(k) for k in listed],
        *[s.content_list(F.get_json_object(raw, f"$.{fields.get(k, k)}")).alias(k) for k in ("function", "disease_association")],
    )
    out = records.select(*[key(k).alias(k) for k in ("term", "xref", "term_uuid", "src_uuid")], meta.alias("metadata"), "_source", "_source_rank", "_line", "_raw")
    return out.where(F.coalesce(F.col("term") != DISCARD, F.lit(True)))


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """A persisted table of vector documents."""
    return spark.read.parquet(path)


def by_id(store: DataFrame, *ids: str) -> DataFrame:
    """Documents of the given ids; the filter reaches the scan."""
    return store.where(F.col("id").isin(*ids))


def with_ids(rows: DataFrame, *parts: str, prefix: str = "") -> DataFrame:
    return rows.withColumn("id", stable_id(*[F.col(p).cast("string") for p in parts], prefix=prefix))
