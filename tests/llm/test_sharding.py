"""Shards against a plain heap over all groups, and what must hold for any sharding."""

import heapq
from collections import defaultdict
from random import Random

import pytest
from pyspark.sql import functions as F

from conceptmerge.llm.queries import op12_sharding
from conceptmerge.llm.sharding import Loads, schedule, sharded, size_class

from .conftest import ODD

DATA = "/root/testdata/sf0.001"


def plain(sizes, shards):
    """Loads after each group went to the least loaded shard, largest first."""
    heap = [(0, i) for i in range(shards)]
    for s in sorted(sizes, reverse=True):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + s, i))
    return sorted(load for load, _ in heap)


def by_text(docs, shards, **how):
    body = F.coalesce("text", F.lit(""))
    return sharded(docs, shards, F.octet_length(body) + 16, body, **how)


def check(df, docs, shards):
    rows = df.collect()
    assert len(rows) == docs.count()
    home, slots, loads, size = {}, defaultdict(list), dict.fromkeys(range(shards), 0), defaultdict(int)
    for r in rows:
        text = r["text"] or ""
        assert home.setdefault(text, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += len(text.encode()) + 16
        size[text] += len(text.encode()) + 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sorted(loads.values()), size.values()


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_equals_a_plain_heap(docs, shards):
    rng = Random(shards)
    rows = [(i, "x" * rng.choice([0, 5, 5, 5, rng.randrange(3000)]) + str(rng.randrange(60))) for i in range(700)] + [(i, "copy") for i in range(300)]
    df = docs(rows).repartition(5)
    got, sizes = check(by_text(df, shards, groups_a_task=20), df, shards)
    assert got == plain(sizes, shards)


def test_odd_rows(docs):
    df = docs(ODD)
    out = by_text(df, 4, salts=2)
    assert out.columns == [*df.columns, "shard", "slot"]
    check(out, df, 4)
    assert by_text(docs([]), 4).collect() == []


def test_names_of_new_columns_that_are_taken(docs):
    df = docs([(1, "a"), (2, "b")]).withColumn("Shard", F.lit("mine")).withColumn("slot.", F.lit(1)).withColumn("class", F.lit(2))
    out = by_text(df, 2)
    assert out.columns == [*df.columns, "_shard", "slot"] and {r["Shard"] for r in out.collect()} == {"mine"} and {r["_shard"] for r in out.collect()} == {0, 1}


def test_sizes_that_say_nothing(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([None, -5, 0, 0, 0, 7, 1 << 61])], "id long, s long")
    got = {r["id"]: r["shard"] for r in sharded(df, 3, F.col("s"), F.col("id")).collect()}
    assert len(got) == 7 and got[5] != got[6]


def test_equal_sizes_at_once_or_one_by_one():
    rng = Random(5)
    for _ in range(200):
        a, b = Loads(7), Loads(7)
        for size in sorted((rng.choice([1, 2, 3, 10, 250]) for _ in range(4)), reverse=True):
            n = rng.randrange(200)
            a.put(size, n)
            for _ in range(n):
                b.put(size, 1)
            assert sorted(x for x, _ in a.heap) == sorted(x for x, _ in b.heap)


def test_size_classes(spark):
    sizes = sorted({0, 1, 4095, 4096, 4097, 8191, 8192, 8195, 8196, (1 << 53) - 1, 1 << 53, (1 << 62) - 1, *range(0, 5000, 7)})
    got = [r[0] for r in spark.createDataFrame([(s,) for s in sizes], "s long").select(size_class(F.col("s"))).collect()]
    assert got == sorted(got) and got[: sizes.index(4096)] == sizes[: sizes.index(4096)]
    assert got[sizes.index(8192)] == got[sizes.index(8195)] < got[sizes.index(8196)]
    first, shard = schedule([(5, 3, 15), (9, 1, 9)], 2)
    assert first.tolist() == [5 << 44, (5 << 44) + 1, 9 << 44] and shard.tolist() == [0, 1, 0]


def test_query_on_the_test_tables(spark):
    rows = op12_sharding(spark, DATA).collect()
    loads, groups, counts = defaultdict(int), defaultdict(int), defaultdict(int)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and r["size"] == len(texts[r["doc_id"]].encode()) + 16
        loads[r["shard"]] += r["size"]
        groups[texts[r["doc_id"]]] += r["size"]
        counts[r["shard"]] += 1
    want = plain(groups.values(), 40)
    assert len(rows) == len(texts) and max(loads.values()) <= 1.001 * want[-1]
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, i) for s in sorted(counts) for i in range(counts[s])]
