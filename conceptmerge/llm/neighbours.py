"""Near-duplicate vectors by a forest of random-projection trees with spill.

Each node of a tree splits by a random direction of its own at the median of the projections.  In its first
levels a margin on both sides of the median goes down both ways, so close vectors are seldom
parted.  Vectors are compared only within leaves, exactly and in double precision.  A pair
that shares leaves of several trees counts in the first it shares, which both members can
tell from the leaf numbers that they carry: links are counted without ever being listed.

Large labels have medians of their own.  How often a tree parts vectors at the floor depends
on the data, so it is measured on pairs of the sample, and trees are added until the label
that does worst is expected to reach the recall; a label that no number of trees brings there gets
fewer levels.

Vectors of different length have no cosine, so each length that is frequent has a forest of
its own, and each of the others is one leaf: all its vectors of a label are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from .components import component_labels
from .simhash import _Forest
from .staging import dropped, settings, staged

_LEAF_BITS = 20  # a leaf's number, below that of its tree


@dataclass
class Tree:
    """Per level a direction for each node, and per group and node a median (infinite: no split) and the margin around it."""

    directions: list[np.ndarray]  # level: nodes x dimensions
    medians: list[np.ndarray]  # level: groups x nodes
    margins: list[float]

    def leaves(self, x: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, leaf) for all leaves of each row."""
        row, node = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        for d, m, g in zip(self.directions, self.medians, self.margins):
            p = np.einsum("ij,ij->i", x[row], d[node]) - m[group[row], node]
            left, right = p <= g, p > -g
            row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
        return row, node


def grow(sample: np.ndarray, group: np.ndarray, levels: list[int], spill_levels: int, margin: float, rng: np.random.Generator) -> Tree:
    """A tree whose medians come from ``sample``, group by group; a node without sampled rows splits at its group's median."""
    directions, medians, margins = [], [], []
    node = np.zeros(len(sample), dtype=np.int64)
    for level in range(max([*levels, 0])):
        d = rng.standard_normal((1 << level, sample.shape[1]))
        d /= np.linalg.norm(d, axis=1, keepdims=True)
        p = np.einsum("ij,ij->i", sample, d[node])
        m = np.full((len(levels), 1 << level), np.inf)
        for g, most in enumerate(levels):
            mine = np.flatnonzero(group == g)
            if level >= most or not len(mine):
                continue
            m[g] = np.median(p[mine])
            order = mine[np.argsort(node[mine], kind="stable")]
            ids, begin = np.unique(node[order], return_index=True)
            for i, part in zip(ids, np.split(order, begin[1:])):
                m[g, i] = np.median(p[part])
        directions.append(d)
        medians.append(m)
        margins.append(margin if level < spill_levels else 0.0)
        node = 2 * node + (p > m[group, node])
    return Tree(directions, medians, margins)


def close_pairs(sample: np.ndarray, group: np.ndarray, floor: float, rng: np.random.Generator, each: int = 500) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Per group pairs to measure recall on: sampled vectors with a partner made at the floor, and pairs of the sample that reach it."""
    out = []
    for g in np.unique(group).tolist():
        x = sample[group == g][:2000]
        made = rng.standard_normal(x[:each].shape)
        made -= (made * x[:each]).sum(1, keepdims=True) * x[:each]
        made /= np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)
        a, b = np.nonzero(np.triu(x @ x.T >= floor, 1))
        pick = rng.permutation(len(a))[:each]
        out.append((np.concatenate([x[:each], x[a[pick]]]), np.concatenate([floor * x[:each] + math.sqrt(max(0.0, 1 - floor * floor)) * made, x[b[pick]]]), g))
    return out


def shared_rate(tree: Tree, a: np.ndarray, b: np.ndarray, g: int) -> float:
    """The share of the pairs that meet in a leaf of the tree."""
    held = []
    for x in (a, b):
        row, leaf = tree.leaves(x, np.full(len(x), g))
        held.append(np.unique(row << _LEAF_BITS | leaf))
    return len(np.unique(np.intersect1d(*held) >> _LEAF_BITS)) / len(a)


def planted(sample: np.ndarray, group: np.ndarray, levels: list[int], floor: float, recall: float, spill_levels: int, margin: float, least_trees: int, most_trees: int = 128, seed: int = 11) -> tuple[list[Tree], float]:
    """Trees, ``least_trees`` and more until the worst group's expected recall reaches ``recall``, and that recall.

    Groups that are not there after ``most_trees`` lose a level, and the forest is planted
    anew: without levels every pair of a group meets, so the recall is always reached.
    """
    rng = np.random.default_rng(seed)
    pairs = close_pairs(sample, group, floor, rng) if len(sample) else []
    levels = list(levels)
    while True:
        trees: list[Tree] = []
        missed = np.ones(max(len(pairs), 1))
        while len(trees) < least_trees or (missed.max() > 1 - recall and len(trees) < most_trees):
            trees.append(grow(sample, group, levels, spill_levels, margin, rng))
            missed *= [max(1e-6, 1 - shared_rate(trees[-1], a, b, g)) for a, b, g in pairs] or 0.0
        if missed.max() <= 1 - recall:
            return trees, 1 - float(missed.max())
        for miss, (*_, g) in zip(missed, pairs):
            levels[g] -= int(miss > 1 - recall)


@dataclass
class Forest:
    """The trees of the vectors of one length, and the numbers of the labels with medians of their own."""

    trees: list[Tree]
    hot: dict[int, int]


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length its rows and their unit vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for dims in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dims)
        x = flat.reshape(-1, dims) if len(at) == len(sizes) else flat[starts[at][:, None] + np.arange(dims)]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
        yield dims, at, x / np.linalg.norm(x, axis=1, keepdims=True)


def _leaf_codes(column: pa.Array, labels: pa.Array, forests: dict[int, Forest]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, leaf number), in order; leaf numbers count through all trees of a length."""
    rows, leaves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for dims, at, x in _by_length(column):
        forest = forests.get(dims)
        if forest is None:
            rows.append(at)
            leaves.append(np.zeros(len(at), np.int64))
            continue
        group = _group_of(labels.take(pa.array(at)), forest.hot)
        for t, tree in enumerate(forest.trees):
            row, node = tree.leaves(x, group)
            rows.append(at[row])
            leaves.append(node | t << _LEAF_BITS)
    row, leaf = np.concatenate(rows), np.concatenate(leaves)
    order = np.lexsort((leaf, row))
    return row[order], leaf[order].astype(np.int32)


def _group_of(labels: pa.Array, hot: dict[int, int]) -> np.ndarray:
    return np.fromiter((hot.get(x, 0) for x in labels.to_pylist()), dtype=np.int64, count=len(labels))


def _leaf_sizes(nodes: DataFrame, forests: Broadcast) -> DataFrame:
    """Rows ``(dims, label, leaf, size)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, leaf = _leaf_codes(batch.column("vec"), batch.column("label"), forests.value)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column("dims").take(take), batch.column("label").take(take), pa.array(leaf)], names=["dims", "label", "leaf"])

    return nodes.select("dims", "label", "vec").mapInArrow(run, "dims int, label long, leaf int").groupBy("dims", "label", "leaf").agg(F.count("*").alias("size"))


def _assigned(nodes: DataFrame, forests: Broadcast) -> DataFrame:
    """A row for each vector and leaf, with the numbers of all leaves of the vector."""
    names = ["dims", "label", "leaf", "node", "weight", "member", "vec"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, leaf = _leaf_codes(batch.column("vec"), batch.column("label"), forests.value)
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))).astype(np.int32)
            member = pa.ListArray.from_arrays(pa.array(ends), pa.array(leaf))
            take = pa.array(row)
            dims, label, node, weight, vec = (batch.column(c).take(take) for c in ("dims", "label", "node", "weight", "vec"))
            yield pa.RecordBatch.from_arrays([dims, label, pa.array(leaf), node, weight, member.take(take), vec], names=names)

    return nodes.select("dims", "label", "node", "weight", "vec").mapInArrow(run, "dims int, label long, leaf int, node long, weight long, member array<int>, vec array<double>")


def _first_shared(member: list[np.ndarray], i: np.ndarray, j: np.ndarray, leaf: int) -> np.ndarray:
    """Of pairs that share ``leaf``, those that share none before it."""
    width = max(map(len, member))
    table = np.full((len(member), width), -1, dtype=np.int32)
    for k, m in enumerate(member):
        early = m[m < leaf]
        table[k, : len(early)] = early
    other = np.where(table < 0, -2, table)
    out = np.ones(len(i), dtype=bool)
    for lo in range(0, len(i), 1 << 16):
        a, b = table[i[lo : lo + (1 << 16)]], other[j[lo : lo + (1 << 16)]]
        out[lo : lo + (1 << 16)] = ~(a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
    return out


def _compared(rows: DataFrame, floor: float, step: int = 1024) -> DataFrame:
    """Rows ``(a, b, n)``: b null, n the weight of what vector a links with here; or b a linked vector, a forest of them."""

    def solve(group: pa.Table) -> Iterator[pa.RecordBatch]:
        leaf, same = int(group.column("leaf")[0].as_py()), not group.column("crossed")[0].as_py()
        side = group.column("side").to_numpy()
        node, weight = group.column("node").to_numpy(), group.column("weight").to_numpy()
        ((_, _, x),) = _by_length(group.column("vec"))
        member = [m.values.to_numpy() for m in group.column("member").combine_chunks()]
        near = np.zeros(len(node), dtype=np.int64)
        forest, links = _Forest(len(node)), []
        first = np.flatnonzero(side == 0)
        second = first if same else np.flatnonzero(side == 1)
        for p in range(0, len(first), step):
            a = first[p : p + step]
            for q in range(p if same else 0, len(second), step):
                b = second[q : q + step]
                i, j = np.nonzero(x[a] @ x[b].T >= floor)
                i, j = a[i], b[j]
                if same:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                new = _first_shared(member, i, j, leaf)
                np.add.at(near, i[new], weight[j[new]])
                np.add.at(near, j[new], weight[i[new]])
                for u, v in zip(i.tolist(), j.tolist()):
                    if forest.join(u, v):
                        links.append((node[u], node[v]))
        on = np.flatnonzero(near)
        a = np.concatenate([node[on], np.array([x[0] for x in links], dtype=np.int64)])
        if len(a):
            b = pa.array([None] * len(on) + [int(x[1]) for x in links], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(np.concatenate([near[on], np.zeros(len(links), np.int64)]))], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            key = [table.column(c).to_numpy() for c in ("dims", "label", "leaf", "bucket")]
            change = np.zeros(table.num_rows - 1, dtype=bool)
            for k in key:
                change |= k[1:] != k[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
            for s, e in zip(cuts, cuts[1:]):
                if e - s > 1:
                    yield from solve(table.slice(s, e - s))
            rest = table.slice(cuts[-1])
        if rest is not None and rest.num_rows > 1:
            yield from solve(rest)

    return rows.mapInArrow(run, "a long, b long, n long")


def linked_vectors(
    vectors: DataFrame, floor: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    leaf_size: int = 1024, spill_levels: int = 3, margin: float = 0.65, recall: float = 0.9999, sample: int = 50_000, block: int = 2048, least_trees: int = 4, least_levels: int = 2, hot_labels: int = 64, lengths: int = 4,
) -> DataFrame:
    """Rows ``(vec_id, n_links, component_id, kept)``, one for each row of ``vectors``.

    Vectors link when their labels are equal and not null, their lengths are equal, and their
    cosine is at least ``floor``, in double precision.  A vector that is null, empty, zero, or
    holds a null or non-finite number links with nothing.  Equal vectors are one class: they
    link with each other and alike with the rest.  Rows with equal ids count each for itself;
    a null id never names a component.  A vector without links is its own component.  An empty
    input gives an empty result.

    Each of the ``lengths`` most frequent lengths goes through a forest of ``least_trees`` or more trees
    of ``least_levels`` or more levels; vectors of any other length are compared with all of
    theirs of the label.  Medians come from at most ``sample`` vectors a forest, for each of the
    ``hot_labels`` largest labels from its own, for the others from theirs together; every
    vector is indexed.  Levels grow with the logarithm of a label's size up to one leaf for each
    16 sampled vectors, trees as the measured recall asks; ``margin`` is in standard deviations
    of the difference of two projections at the floor.  Leaves of more than ``block`` rows are
    compared in pairs of blocks.
    """
    spark = vectors.sparkSession
    vec = F.col(vector_col).cast("array<double>")
    rows = staged(
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), vec.alias("vec")).withColumn("row", F.monotonically_increasing_id()), "neighbours-rows"
    )
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.coalesce(finite & F.exists("vec", lambda v: v != 0) & F.col("label").isNotNull(), F.lit(False))
    nodes = staged(rows.where(sound).groupBy("label", "vec").agg(F.min("row").alias("node"), F.count("*").alias("weight")).withColumn("dims", F.size("vec")), "neighbours-nodes")
    forests = {}
    for length in nodes.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").limit(lengths).collect():
        own = nodes.where(F.col("dims") == length["dims"])
        largest = own.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(hot_labels + 1).collect()
        big = [r for r in largest[:hot_labels] if r["n"] > 2 * leaf_size]
        hot = {r["label"]: i + 1 for i, r in enumerate(big)}
        sizes = [max((r["n"] for r in largest if r["label"] not in hot), default=1), *(r["n"] for r in big)]
        share = -(-length["n"] // sample)
        picked = own.where(F.pmod(F.xxhash64("node"), F.lit(share)) == 0).select("label", "vec").limit(2 * sample).toArrow()
        base = np.concatenate([np.zeros((0, length["dims"])), *(x for _, _, x in _by_length(picked.column("vec")))]) if picked.num_rows else np.zeros((0, length["dims"]))
        group = _group_of(picked.column("label"), hot)
        known = np.bincount(group, minlength=len(sizes))
        levels = [max(least_levels, min(math.ceil(math.log2(max(1, n) / leaf_size)), int(math.log2(max(k, 16) / 16)))) for n, k in zip(sizes, known.tolist())]
        spill = margin * math.sqrt(2 * (1 - floor) / length["dims"])
        forests[length["dims"]] = Forest(planted(base, group, levels, floor, recall, spill_levels, spill, least_trees)[0], hot)
    sent = spark.sparkContext.broadcast(forests)  # at most as large as lengths, samples and trees allow
    with settings(spark, values={"spark.sql.execution.arrow.maxRecordsPerBatch": "2048"}):
        full = staged(_leaf_sizes(nodes, sent).where("size > 1"), "neighbours-leaves")
        blocks = F.ceil(F.col("size") / block).cast("int")
        mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct((F.least(mine, o).cast("long") * (1 << 31) + F.greatest(mine, o)).alias("bucket"), (mine != o).alias("crossed"), F.when(mine > o, 1).otherwise(0).alias("side")))
        dealt = (
            _assigned(nodes, sent).join(full, ["dims", "label", "leaf"]).withColumn("p", F.explode(pairs))
            .select("dims", "label", "leaf", "p.bucket", "p.crossed", "p.side", "node", "weight", "member", "vec")
            .repartition("dims", "label", "leaf", "bucket").sortWithinPartitions("dims", "label", "leaf", "bucket")
        )
        got = staged(_compared(dealt, floor), "neighbours-links")
    near = got.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("near"))
    roots = component_labels(got.where("b is not null").select("a", "b"), "neighbours-components")
    about = nodes.select("label", "vec", "node", "weight").join(near, "node", "left").join(roots, "node", "left")
    about = about.select("label", "vec", (F.coalesce("near", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    known = rows.where(sound).join(about, ["label", "vec"]).select("row", "n_links", "root")
    every = staged(rows.select("row", "vec_id").join(known, "row", "left"), "neighbours-every")
    least = every.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    component = F.coalesce("least", "vec_id")
    out = every.join(least, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )
    out = staged(out, "neighbours-classes")
    dropped(rows, full, nodes, got, every)
    return out
