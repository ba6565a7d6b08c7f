"""Nearest vectors by cosine, as products of matrices on blocks of both sides.

Vectors are scaled to length one, put to the nearest of a few pivots, and packed: a row of a
packed table is a block of vectors around one pivot.  A block of queries meets the blocks of
the store that can hold anything within the floor: by the triangle inequality for angles, a
vector near a pivot is no nearer to a query than the pivot's angle less both distances.  Each
meeting is one product, of which every query keeps its k best; no row is made for a pair.
A row of a meeting holds two blocks, so Python takes these one by one, and a product some
queries at a time: what a worker holds is two blocks, however many meetings its task has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.scratch import removed, written

_SLACK = 1e-9
#: Digits of a score: what differs by less is a tie, as sums of one product may be made in another order.
DIGITS = 12
#: Vectors of one side in a product at a time.
ROWS = 256


def unit_rows(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of a column of vectors: the rows that have a direction, their lengths, and per length the unit vectors in that order.

    Null, zero and empty vectors and such with null or non-finite members have none.
    """
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.float64())
    flat = flat.to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    rows, dims, parts = [], [], []
    for d in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == d)
        m = flat[starts[at][:, None] + np.arange(d)]
        sound = np.isfinite(m).all(axis=1)
        m = np.where(sound[:, None], m, 0.0)
        top = np.abs(m).max(axis=1)
        m = m / np.where(top > 0, top, 1.0)[:, None]
        norm = np.sqrt((m * m).sum(axis=1))
        good = sound & (norm > 0)
        rows.append(at[good])
        dims.append(np.full(good.sum(), d))
        parts.append(m[good] / norm[good][:, None])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *dims]), parts


def _placed(df: DataFrame, pivots: dict[int, np.ndarray], kind: str) -> DataFrame:
    """Rows ``(id, at, unit, dims, pivot, angle)`` of ``(id, at, v)``: the unit vector, its nearest pivot and the angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, dims, parts = unit_rows(batch.column("v"))
            if not len(rows):
                continue
            pivot, angle = np.full(len(rows), -1, dtype=np.int32), np.full(len(rows), math.pi)
            for m in parts:
                p = pivots.get(m.shape[1])
                if p is not None and len(m):
                    cos = m @ p.T
                    best = cos.argmax(axis=1)
                    here = dims == m.shape[1]
                    pivot[here] = best
                    angle[here] = np.arccos(np.clip(cos[np.arange(len(m)), best], -1, 1))
            flat = np.concatenate([m.ravel() for m in parts])
            unit = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(dims)), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)), batch.column("at").take(pa.array(rows)), unit, pa.array(dims, pa.int32()), pa.array(pivot), pa.array(angle)],
                names=["id", "at", "unit", "dims", "pivot", "angle"],
            )

    return df.mapInArrow(run, f"id {kind}, at long, unit array<double>, dims int, pivot int, angle double")


def _pivots(store: DataFrame, n: int) -> dict[int, np.ndarray]:
    """At most n unit vectors of the store, the first by a hash of their ids: a fixed number, whatever the store."""
    got = store.where("v is not null").orderBy(F.xxhash64("id"), "id").limit(n).select("v").toArrow()
    return {m.shape[1]: m for m in unit_rows(got.column("v"))[2] if len(m)} if got.num_rows else {}


def nearest(
    queries: DataFrame, store: DataFrame, k: int, floor: float, earlier: bool = False, rows_a_block: int = 4096, queries_a_block: int = 1024, pivots: int = 32
) -> DataFrame:
    """Rows ``(query_id, id, score, rank)`` for ``queries`` and ``store`` of ``(id, at, v)``: the k nearest within the floor.

    Scores are rounded to twelve digits and ties go to the smaller id.  With ``earlier`` only
    vectors of smaller ``at`` count.  Vectors without a direction, and such of different
    length, have no score.  Ids of one side are distinct.
    """
    spark = store.sparkSession
    kinds = [dict(df.dtypes)["id"] for df in (queries, store)]
    centre = _pivots(store, pivots)
    held, asked = written(_placed(store, centre, kinds[1]), "nearest-store"), written(_placed(queries, centre, kinds[0]), "nearest-queries")
    spread = held.groupBy("dims", "pivot").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()  # a row for each pivot and length

    def packed(df: DataFrame, chunks, *more) -> DataFrame:
        return df.withColumn("chunk", F.pmod(F.xxhash64("id"), chunks)).groupBy("dims", "pivot", "chunk").agg(F.collect_list(F.struct("id", "at", "unit")).alias("block"), *more)

    reach = []
    for s in spread:
        chunks = -(-s["n"] // rows_a_block)
        for p in [-1, *range(len(centre.get(s["dims"], ())))]:
            exact = p >= 0 and s["pivot"] >= 0
            gap = math.acos(min(1.0, max(-1.0, float(centre[s["dims"]][p] @ centre[s["dims"]][s["pivot"]])))) - s["radius"] if exact else -math.pi
            reach.append((s["dims"], p, s["pivot"], float(gap), chunks))
    reach_df = spark.createDataFrame(reach, "dims int, pivot int, other int, gap double, chunks long")
    size = reach_df.groupBy("dims", F.col("other").alias("pivot")).agg(F.max("chunks").alias("chunks"))
    blocks = packed(held.join(F.broadcast(size), ["dims", "pivot"]), F.col("chunks")).select("dims", F.col("pivot").alias("other"), "chunk", F.col("block").alias("stored"))
    parts = asked.groupBy("dims", "pivot").agg(F.ceil(F.count("*") / queries_a_block).alias("chunks"))
    wanted = packed(asked.join(F.broadcast(parts), ["dims", "pivot"]), F.col("chunks"), F.max("angle").alias("radius")).select("dims", "pivot", "radius", F.col("block").alias("asked"))
    widest = math.acos(max(-1.0, min(1.0, floor))) + _SLACK
    meets = wanted.join(F.broadcast(reach_df), ["dims", "pivot"]).where(F.col("gap") - F.col("radius") <= widest)
    met = meets.select("dims", "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "asked").join(blocks, ["dims", "other", "chunk"])

    def sides(column: pa.Array, i: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        items = column.slice(i, 1).flatten()
        ids, at, unit = (items.field(j) for j in range(3))
        m = unit.flatten().to_numpy(zero_copy_only=False)
        return ids, at.to_numpy(zero_copy_only=False), m.reshape(len(ids), -1)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q_at, q = sides(batch.column("asked"), i)
                s_ids, s_at, s = sides(batch.column("stored"), i)
                by_id = np.argsort(np.asarray(s_ids.to_pylist(), dtype=object), kind="stable")
                place = np.empty(len(by_id), dtype=np.int64)
                place[by_id] = np.arange(len(by_id))
                for lo in range(0, len(q), ROWS):
                    score = np.round(q[lo : lo + ROWS] @ s.T, DIGITS)
                    keep = score >= floor
                    if earlier:
                        keep &= s_at[None, :] < q_at[lo : lo + ROWS, None]
                    rows, cols = np.nonzero(keep)
                    if not len(rows):
                        continue
                    order = np.lexsort((place[cols], -score[rows, cols], rows))
                    rows, cols = rows[order], cols[order]
                    first = np.searchsorted(rows, rows)  # where the query's own rows begin
                    top = np.arange(len(rows)) - first < k
                    rows, cols = rows[top], cols[top]
                    yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(rows + lo)), s_ids.take(pa.array(cols)), pa.array(score[rows, cols])], names=["query_id", "id", "score"])

    found = written(met.select("asked", "stored").mapInArrow(best, f"query_id {kinds[0]}, id {kinds[1]}, score double"), "nearest-found", rows_a_batch=1)
    removed(held)
    removed(asked)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k)
