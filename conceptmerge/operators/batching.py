"""Numbering, batches and runs over ordered rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import distinct_members
from ..sources.scratch import fresh_path


def numbered(rows: DataFrame, order: list[str | Column], name: str = "line", parts: list[str] | None = None) -> DataFrame:
    """``rows`` with their number from 1.

    Without ``parts`` the whole table is numbered: rows are range partitioned and sorted,
    and each partition starts after the rows of those before it, so no task sees all rows.
    """
    if parts:
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
    return running_totals(rows, order, None, name)


def _dealt(rows: DataFrame, order: list[str | Column]) -> DataFrame:
    """Rows range partitioned along the order, with ``_part``, the number of their partition.

    Range bounds come from a sample, so the deal is written once and not made twice.
    """
    spark = rows.sparkSession
    n, path = int(spark.conf.get("spark.sql.shuffle.partitions")), fresh_path(spark, "numbered")
    rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def running_totals(rows: DataFrame, order: list[str | Column], value: str | None, name: str = "line", total: str = "total") -> DataFrame:
    """``rows`` with their number from 1 and, if a ``value`` is named, its sum up to each row; no task sees all rows."""
    dealt = _dealt(rows, order)
    sums = [F.count("*").alias("_size")] + ([F.sum(value).alias("_sum")] if value else [])
    sizes = dealt.groupBy("_part").agg(*sums)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"), *([F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_so_far")] if value else []))
    w = Window.partitionBy("_part").orderBy(*order)
    out = dealt.withColumn("_within", F.row_number().over(w))
    if value:
        out = out.withColumn("_run", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_within"))
    if value:
        out = out.withColumn(total, F.col("_so_far") + F.col("_run"))
    return out.drop("_part", "_within", "_before", "_so_far", "_run")


def line_slice(rows: DataFrame, order: list[str | Column], first: int, last: int) -> DataFrame:
    """Rows number ``first`` to ``last``, both included, counted from 1."""
    return numbered(rows, order, "_line_no").where(F.col("_line_no").between(first, last)).drop("_line_no")


def fixed_batches(rows: DataFrame, order: list[str | Column], size: int, parts: list[str] | None = None) -> DataFrame:
    """``rows`` with ``batch``, from 0; the last may be smaller."""
    return numbered(rows, order, "_n", parts).withColumn("batch", F.floor((F.col("_n") - 1) / size).cast("long")).drop("_n")


def adaptive_batches(rows: DataFrame, part: str | list[str] | None, order: list[str], term: str, least: int = 5, most: int = 12, prefix: int = 4) -> DataFrame:
    """``rows`` with ``batch``: at least ``least`` rows, and up to ``most`` while terms are alike; along one order, or within each part.

    Alike are terms that are equal or share their first letters in lower case.  The rule is an
    automaton whose state is the size of the open batch, so a stretch of rows is a function of
    the size it begins with.  Without ``part`` each range partition is folded for all sizes at
    once, the functions are chained over partitions (a row each, on the driver), and then each
    partition numbers its batches.  With ``part`` a part is folded in one task.  Rows stream
    through in Arrow batches that carry the state on, so no task holds a partition.
    """
    names = rows.columns
    kinds = rows.withColumn("batch", F.lit(0).cast("long")).schema
    if part is not None:
        keys = [part] if isinstance(part, str) else part
        w = Window.partitionBy(*keys).orderBy(*order)
        marked = rows.withColumn("_like", _alike(F.col(term), F.lag(term).over(w), prefix)).withColumn("_first", F.row_number().over(w) == 1)

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            size = n = 0
            for batch in batches:
                made, first = np.empty(batch.num_rows, dtype=np.int64), batch.column("_first").to_numpy(zero_copy_only=False)
                like = batch.column("_like").to_numpy(zero_copy_only=False)
                cuts = [0, *(np.flatnonzero(first[1:]) + 1).tolist(), batch.num_rows]
                for lo, hi in zip(cuts, cuts[1:]):
                    if lo < hi:
                        size, n = (0, 0) if first[lo] else (size, n)
                        begun, size = _batches(like[lo:hi], size, least, most)
                        made[lo:hi] = n + begun - 1
                        n += int(begun[-1])
                yield _with_batch(batch, names, made)

        return marked.mapInArrow(whole, kinds)  # the windows leave each part's rows together and in order

    dealt = _dealt(rows, order)
    w = Window.partitionBy("_part").orderBy(*order)
    # the last term of each partition that has rows, for the first row of the next
    ends = dealt.groupBy("_part").agg(F.max_by(term, F.struct(*order)).alias("_end"))
    ends = ends.select((F.lead("_part").over(Window.orderBy("_part"))).alias("_part"), "_end").where("_part is not null")
    first = F.row_number().over(w) == 1
    marked = dealt.withColumn("_first", first).withColumn("_before", F.lag(term).over(w)).join(F.broadcast(ends), "_part", "left")
    marked = marked.withColumn("_like", _alike(F.col(term), F.when(F.col("_first"), F.col("_end")).otherwise(F.col("_before")), prefix)).drop("_before", "_end")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sizes, counts = None, [], []

        def out() -> pa.RecordBatch:
            columns = [pa.array([at] * (most + 1), pa.int32()), pa.array(range(most + 1), pa.int32()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, names=["_part", "size", "started", "left"])

        for batch in batches:
            for part_, lo, hi, new in _stretches(batch):
                if new:
                    if at is not None:
                        yield out()
                    at, sizes, counts = part_, list(range(most + 1)), [0] * (most + 1)
                sizes, counts = _folded(batch.column("_like").to_numpy(zero_copy_only=False)[lo:hi].tolist(), sizes, counts, least, most)
        if at is not None:
            yield out()

    by_part: dict[int, dict[int, tuple[int, int]]] = {}
    for r in marked.mapInArrow(folded, "_part int, size int, started long, left int").collect():
        by_part.setdefault(r["_part"], {})[r["size"]] = (r["started"], r["left"])
    size, count, enter = 0, 0, {}
    for p in sorted(by_part):
        enter[p] = (size, count)
        started, size = by_part[p][size]
        count += started

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = count = 0
        for batch in batches:
            made, like = np.empty(batch.num_rows, dtype=np.int64), batch.column("_like").to_numpy(zero_copy_only=False)
            for part_, lo, hi, new in _stretches(batch):
                if new:
                    size, count = enter[part_]
                begun, size = _batches(like[lo:hi], size, least, most)
                made[lo:hi] = count + begun - 1
                count += int(begun[-1])
            yield _with_batch(batch, names, made)

    return marked.mapInArrow(placed, kinds)


def _with_batch(batch: pa.RecordBatch, names: list[str], made: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(made)], names=[*names, "batch"])


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, bool]]:
    """Of a batch of sorted rows ``(partition, from, to, whether the partition begins there)``."""
    part, first = batch.column("_part").to_numpy(), batch.column("_first").to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            yield int(part[lo]), lo, hi, bool(first[lo])


def _folded(like: list[bool], sizes: list[int], counts: list[int], least: int, most: int) -> tuple[list[int], list[int]]:
    """Sizes of the open batch and batches begun after some rows, for each size they began with; equal sizes go on together."""
    for i, same in enumerate(like):
        if min(sizes) == max(sizes):
            begun, size = _batches(np.array(like[i:], dtype=bool), sizes[0], least, most)
            return [size] * len(sizes), [n + int(begun[-1]) for n in counts]
        stay = [size and (size < least or (same and size < most)) for size in sizes]
        sizes = [size + 1 if s else 1 for size, s in zip(sizes, stay)]
        counts = [n if s else n + 1 for n, s in zip(counts, stay)]
    return sizes, counts


def _alike(term: Column, before: Column, prefix: int) -> Column:
    return F.coalesce((term == before) | (F.substring(F.lower(term), 1, prefix) == F.substring(F.lower(before), 1, prefix)), F.lit(False))


def _batches(like: np.ndarray, size: int, least: int, most: int) -> tuple[np.ndarray, int]:
    """How many batches have begun up to each row, if the open one begins with ``size`` rows (0: none is open), and the size of the last."""
    begun = np.zeros(len(like), dtype=np.int64)
    n = 0
    for i, same in enumerate(like.tolist()):
        if size and (size < least or (same and size < most)):
            size += 1
        else:
            size, n = 1, n + 1
        begun[i] = n
    return begun, size


def runs(rows: DataFrame, part: list[str], order: list[str], key: str) -> DataFrame:
    """``rows`` with ``run``: the number of the stretch of neighbours with an equal key, within each part.  Rows without a key part runs and go."""
    w = Window.partitionBy(*part).orderBy(*order)
    new = F.when(F.coalesce(F.col(key).eqNullSafe(F.lag(key).over(w)), F.lit(False)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    marked = rows.withColumn("_new", new)
    return marked.withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new").where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))


def summarized_runs(rows: DataFrame, part: list[str], order: list[str], key: str, terms: str, text: str) -> DataFrame:
    """Per run: the lists as they came, their distinct members, and the texts joined by line feeds."""
    marked = runs(rows, part, order, key)
    one = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(terms).alias("t"), F.col(text).alias("d"))
    listed = marked.groupBy(*part, "run", key).agg(F.array_sort(F.collect_list(one)).alias("l"))
    nested = F.transform("l", lambda x: x["t"])
    return listed.select(*part, "run", key, nested.alias("nested"), distinct_members(nested).alias("distinct_terms"), F.array_join(F.transform("l", lambda x: x["d"]), "\n").alias("descriptions"))
