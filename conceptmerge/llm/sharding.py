"""Shards of near equal size by longest-processing-time scheduling.

Groups of rows that must stay together go from large to small, each to the least loaded
shard, which a heap of the shards' loads names.  Groups of equal size are alike to this rule,
so it is decided on the counts of sizes: of each size a shard gets a number of groups, and
a group finds its shard by its rank among those of its size.  Sizes of more than twelve binary
digits share a class with those of the same leading twelve and count as the mean of the class,
so the driver holds at most about a hundred thousand counts, whatever the corpus, and a shard's
load is known to a few parts in a hundred thousand.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .staging import dropped, staged, unused

_DIGITS = 12
_RANKS = 1 << 44


def size_class(size: Column) -> Column:
    """A number that grows with the size and is the same for sizes of the same leading digits."""
    over = F.greatest(F.length(F.bin(size)) - _DIGITS, F.lit(0))
    return (over * (1 << _DIGITS)).cast("long") + F.call_function("shiftright", size, over)


class Loads:
    """The shards' loads in a heap; of equal loads the smaller shard comes first."""

    def __init__(self, shards: int):
        self.heap = [(0.0, i) for i in range(shards)]

    def put(self, size: float, n: int) -> dict[int, int]:
        """Deal n groups of one size, each to the least loaded shard; how many each shard got."""
        got: dict[int, int] = {}
        if size > 0 and n > 2 * len(self.heap):
            n -= self._up_to_level(size, n, got)
        elif size <= 0:
            each, n = divmod(n, len(self.heap))
            got = {i: each for _, i in self.heap if each}
        for _ in range(n):
            load, i = self.heap[0]
            got[i] = got.get(i, 0) + 1
            if size > 0:
                heapq.heapreplace(self.heap, (load + size, i))
            else:
                heapq.heapreplace(self.heap, (np.nextafter(load, np.inf), i))
        return got

    def _up_to_level(self, size: float, n: int, got: dict[int, int]) -> int:
        """Fill shards at once as far as the heap would certainly go, up to a common level; how many groups went."""
        loads = sorted(self.heap)
        total, level = 0.0, 0.0
        for k, (load, _) in enumerate(loads, 1):
            total += load
            level = (total + n * size) / k
            if k == len(loads) or level <= loads[k][0]:
                break
        put = 0
        for k, (load, i) in enumerate(loads):
            more = min(int(max(level - load, 0.0) // size), n - put)
            if more:
                got[i] = more
                loads[k] = (load + more * size, i)
                put += more
        self.heap = loads
        heapq.heapify(self.heap)
        return put


def schedule(classes: Sequence[tuple[int, int, int]], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """From (class, groups, their size together): the first rank of each run of groups, as ``class * 2**44 + rank``, and its shard."""
    loads, first, shard = Loads(shards), [], []
    for number, n, total in sorted(classes, reverse=True):
        rank = number * _RANKS
        for i, k in sorted(loads.put(total / n, n).items()):
            first.append(rank)
            shard.append(i)
            rank += k
    order = np.argsort(np.array(first, dtype=np.int64), kind="stable")
    return np.array(first, dtype=np.int64)[order], np.array(shard, dtype=np.int32)[order]


def sharded(
    rows: DataFrame, shards: int, size: Column, group: Column, carried: Sequence[str] | None = None, salts: int | None = None, groups_a_task: int = 200_000
) -> DataFrame:
    """The ``carried`` columns (all if not given) of every row, with ``shard`` (from 0) and ``slot`` (its place there, gapless from 0).

    Rows of equal ``group`` stay together, also those where it is null; groups of equal 64-bit
    code count as one.  A null or negative size is zero.  A shard exceeds another by no more
    than one of its groups.  Repeated rows are rows of their own, and no rows give no rows.  Where a carried
    column is called ``shard`` or ``slot`` (in any case) the new one gets underscores before its name.

    A group may hold any share of the rows: its rows are dealt to ``salts``, by default the
    session's number of shuffle partitions, and slots are counted by task and shard.
    """
    spark = rows.sparkSession
    salts = salts or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = list(carried if carried is not None else rows.columns)
    kept = [f"c{i}" for i in range(len(names))]
    own = staged(
        rows.select(
            F.xxhash64(group).alias("key"), F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("salt"),
            F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("size"), *[F.col(f"`{c}`").alias(k) for c, k in zip(names, kept)],
        ),
        "sharding-rows",
    )
    parts = staged(own.groupBy("key", "salt").agg(F.sum("size").alias("size")), "sharding-parts")
    groups = staged(parts.groupBy("key").agg(F.sum("size").alias("size")).withColumn("class", size_class(F.col("size"))), "sharding-groups")
    classes = [tuple(r) for r in groups.groupBy("class").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()]
    plan = spark.sparkContext.broadcast(schedule(classes, shards))

    # The rank of a group in its class: shares of the class one after another, and the order of keys within each.
    shares = max(1, -(-sum(n for _, n, _ in classes) // groups_a_task))
    dealt = groups.withColumn("share", F.pmod(F.col("key"), F.lit(shares)))
    before = (
        dealt.groupBy("class", "share").agg(F.count("*").alias("n"))
        .select("class", "share", (F.sum("n").over(Window.partitionBy("class").orderBy("share")) - F.col("n")).alias("before"))
    )
    within = F.row_number().over(Window.partitionBy("class", "share").orderBy("key")) - 1
    ranked = dealt.withColumn("within", within).join(before, ["class", "share"]).select("key", (F.col("class") * _RANKS + F.col("before") + F.col("within")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, shard = plan.value
        for batch in batches:
            at = np.searchsorted(first, batch.column("rank").to_numpy(), side="right") - 1
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(shard[at])], names=["key", "shard"])

    homes = parts.select("key", "salt").join(ranked.mapInArrow(place, "key long, shard int"), "key")
    placed = staged(
        own.join(homes, ["key", "salt"]).select(*kept, "shard", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("row")), "sharding-placed"
    )
    dropped(own, parts, groups)
    taken = (
        placed.groupBy("shard", "task").agg(F.count("*").alias("n"))
        .select("shard", "task", (F.sum("n").over(Window.partitionBy("shard").orderBy("task")) - F.col("n")).alias("before"))
    )
    nth = F.row_number().over(Window.partitionBy("shard", "task").orderBy("row")) - 1
    shard_name, slot_name = unused(rows.select(*[F.col(f"`{c}`") for c in names]), "shard", "slot")
    out = placed.withColumn("nth", nth).join(taken, ["shard", "task"])
    out = staged(out.select(*[F.col(k).alias(c) for k, c in zip(kept, names)], F.col("shard").alias(shard_name), (F.col("before") + F.col("nth")).cast("long").alias(slot_name)), "sharding-slots")
    dropped(placed)
    return out
