"""SimHash near-duplicates by generalised pigeonhole search.

Fingerprints within ``radius`` bits are found by cutting the 64 bits into parts and giving
each part an own threshold, whose sum (each plus one) is ``radius + 1``: two fingerprints
within the radius must agree in some part within that part's threshold.  Bits that vary
together go into one part, so that the parts are as informative as they can be, and dynamic
programming chooses the thresholds with the least expected work, estimated from counts over
all fingerprints.  Probed pairs are verified on all bits.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import component_labels
from .staging import FEW, dropped, staged, unused

BITS = 64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_codes(text: str | None, width: int) -> np.ndarray:
    """Hashes of the text's shingles in order, repeats included; fewer words than ``width`` are one shingle."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], dtype=np.uint64)
    shift = [itertools.islice(words, i, None) for i in range(width)]
    return np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in map(b" ".join, zip(*shift))), dtype=np.uint64, count=len(words) - width + 1)


def fingerprint_of(codes: np.ndarray, block: int = 1 << 16) -> int:
    """The SimHash of a text's shingle codes; memory beside them is bounded by ``block``."""
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, len(codes), block):
        part = np.ascontiguousarray(codes[lo : lo + block]).astype("<u8", copy=False)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(codes)).tolist()))


def fingerprint(text: str | None, width: int = 4) -> int:
    """The 64-bit SimHash of one text, as an unsigned number."""
    return fingerprint_of(shingle_codes(text, width))


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """Rows ``(doc_id, mark, fp)``: fp is the fingerprint's 64 bits as a signed long, mark a code of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(x, width) for x in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got.view(np.int64))], names=["doc_id", "mark", "fp"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text")).mapInArrow(run, "doc_id long, mark long, fp long")


# --- the plan -------------------------------------------------------------------------------

def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and the 64 x 64 counts of bits set together, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            v = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            for lo in range(0, len(v), 65536):
                x = np.unpackbits(v[lo : lo + 65536], axis=1, bitorder="little").astype(np.float32)
                total += x.T @ x
            n += len(v)
        cell = np.append(total.ravel().astype(np.int64), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cell), dtype=np.int32)), pa.array(cell)], names=["cell", "n"])

    rows = nodes.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1, dtype=np.int64)
    for r in rows:
        cells[r["cell"]] = r["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def correlated_parts(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size; each group grows by the bit that correlates most with it."""
    n = max(n, 1)
    p = np.diag(together) / n
    cov = together / n - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        order = sorted(free)
        group = [max(order, key=lambda b: (corr[b, order].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def expected_work(n: int, together: np.ndarray, group: list[int], most: int) -> list[tuple[float, float]]:
    """For thresholds -1 to ``most``: keys written and pairs compared, if the group's bits differ independently."""
    p = np.diag(together)[group] / max(n, 1)
    differ = 2 * p * (1 - p)
    chance = np.zeros(most + 2)
    chance[0] = 1
    for q in differ:
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
    out = [(0.0, 0.0)]
    for t in range(most + 1):
        keys = n if t == 0 else n * (1 + sum(math.comb(len(group), i) for i in range(t + 1)))
        out.append((float(keys), n * max(n - 1, 0) / 2 * float(chance[: t + 1].sum())))
    return out


def thresholds(work: list[list[float]], radius: int) -> tuple[float, list[int]]:
    """One threshold (-1: unused) for each part, summing with one each to ``radius + 1``, of least total work."""
    best = {0: (0.0, [])}
    for costs in work:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, extra in enumerate(costs, start=-1):
                total = used + t + 1
                if total <= radius + 1 and (total not in following or cost + extra < following[total][0]):
                    following[total] = (cost + extra, [*chosen, t])
        best = following
    return best[radius + 1]


def plan(n: int, together: np.ndarray, radius: int, key_cost: float = 60.0) -> list[tuple[list[int], int]]:
    """The parts (bits, threshold) to probe; writing a key counts as ``key_cost`` comparisons."""
    best: tuple[float, list[tuple[list[int], int]]] = (math.inf, [])
    for parts in range(1, radius + 2):
        groups = correlated_parts(n, together, parts)
        most = min(radius, 2)
        work = [[key_cost * k + c for k, c in expected_work(n, together, g, most)] for g in groups]
        if parts * (most + 1) < radius + 1:
            continue
        cost, chosen = thresholds(work, radius)
        if cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, chosen) if t >= 0])
    return best[1]


# --- the search -----------------------------------------------------------------------------

def _masks(group: list[int], t: int) -> list[int]:
    return [sum(1 << b for b in c) for i in range(t + 1) for c in itertools.combinations(group, i)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def keyed(nodes: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """Rows ``(part, key, probe, fp)``: each fingerprint once as stored, and for positive thresholds once for each near key."""
    out = None
    for i, (group, t) in enumerate(parts):
        held = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in group))))
        rows = nodes.select(F.lit(i).alias("part"), held.alias("key"), F.lit(False).alias("probe"), "fp")
        if t > 0:
            flips = F.array(*[F.lit(_signed(m)) for m in _masks(group, t)])
            rows = rows.unionByName(
                nodes.select(F.lit(i).alias("part"), F.explode(F.transform(flips, lambda m: held.bitwiseXOR(m))).alias("key"), F.lit(True).alias("probe"), "fp")
            )
        out = rows if out is None else out.unionByName(rows)
    return out


_POP = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each of ``a`` with each of ``b``."""
    x = a[:, None] ^ b[None, :]
    return np.bitwise_count(x) if hasattr(np, "bitwise_count") else _POP[x.view(np.uint16).reshape(*x.shape, 4)].sum(-1)


class _Forest:
    """Keeps only links that join different trees, so a bucket of n gives at most n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def bucket_links(stored: np.ndarray, probes: np.ndarray, radius: int, block: int = 1024) -> list[tuple[int, int]]:
    """Links that span what the bucket connects: every stored fingerprint against every probing one."""
    ids = np.unique(np.concatenate([stored, probes]))
    at_s, at_p = np.searchsorted(ids, stored), np.searchsorted(ids, probes)
    forest, out = _Forest(len(ids)), []
    raw = ids.view(np.uint64)
    for i in range(0, len(at_s), block):
        for j in range(0, len(at_p), block):
            a, b = at_s[i : i + block], at_p[j : j + block]
            near = np.argwhere(distances(raw[a], raw[b]) <= radius)
            for x, y in zip(a[near[:, 0]].tolist(), b[near[:, 1]].tolist()):
                if x != y and forest.join(x, y):
                    out.append((int(ids[x]), int(ids[y])))
    return out


def _finder(radius: int):
    """Streams rows sorted by bucket; memory is bounded by the bucket size that ``near_links`` allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
            part, key, probe, fp = (table.column(c).to_numpy() for c in ("part", "key", "probe", "fp"))
            cuts = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
            ends = np.append(cuts, len(fp))
            begins = np.append(0, cuts)
            both = ends - begins > 1
            links: list[tuple[int, int]] = []
            for i, j in zip(begins[both].tolist(), ends[both].tolist()):
                p = probe[i:j]
                stored = fp[i:j][~p]
                asking = fp[i:j][p] if p.any() else stored
                if len(stored) and len(asking):
                    links += bucket_links(stored, asking, radius)
            if links:
                a = np.array(links, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            part, key = table.column("part").to_numpy(), table.column("key").to_numpy()
            last = np.flatnonzero((part != part[-1]) | (key != key[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from solve(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks()
        if rest is not None:
            yield from solve(rest)

    return run


def _refined(rows: DataFrame, hot: DataFrame, parts: list[tuple[list[int], int]], radius: int, level: int) -> DataFrame:
    """Rows of overfull buckets under narrower keys.

    Two members that are within the radius differ in at most ``radius`` bits, so of
    ``radius + 1`` disjoint groups of bits at least one agrees in both: the bucket's key is
    extended by each group's value in turn.
    """
    dealt = np.random.default_rng(1000 + level).permutation(BITS)  # another deal at each level
    groups = [dealt[g :: radius + 1].tolist() for g in range(radius + 1)]
    inner = rows.join(hot, ["part", "key"])
    pick = F.explode(F.array(*[F.struct(F.lit(g).alias("g"), F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits)))).alias("v")) for g, bits in enumerate(groups)]))
    return inner.select("part", "key", "probe", "fp", pick.alias("x")).select(
        "part", F.xxhash64(F.lit(level), "part", "key", "x.g", "x.v").alias("key"), "probe", "fp"
    )


def near_links(nodes: DataFrame, radius: int = 4, bucket: int = 4096, levels: int = 3) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` within ``radius`` bits.

    Buckets of more than ``bucket`` rows get narrower keys up to ``levels`` times; what is
    then still together differs in hardly any bit, and is compared in blocks: each row goes
    to the pairs of blocks that hold it, so one task never has more than two blocks.
    """
    n, together = bit_statistics(nodes)
    parts = plan(n, together, radius)
    rows, links = keyed(nodes, parts), None
    for level in range(levels + 1):
        sizes = rows.groupBy("part", "key").agg(F.count("*").alias("size")).where(F.col("size") > bucket)
        hot = staged(sizes, "simhash-hot")
        overfull = not hot.isEmpty()
        calm = rows.join(hot, ["part", "key"], "left_anti") if overfull else rows
        got = calm.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(_finder(radius), "a long, b long")
        links = got if links is None else links.unionByName(got)
        if not overfull:
            return links
        if level < levels:
            rows = staged(_refined(rows, hot.select("part", "key"), parts, radius, level), "simhash-refined")
    return links.unionByName(_blocked(rows.join(hot, ["part", "key"]), radius, bucket))


def _blocked(rows: DataFrame, radius: int, bucket: int) -> DataFrame:
    """Block pairs of buckets that stay overfull."""
    blocks = F.ceil(F.col("size") / (bucket // 2)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(mine, o).alias("i"), F.greatest(mine, o).alias("j")))
    split = rows.select("part", "key", "probe", "fp", F.explode(pairs).alias("p")).select(
        "part", F.xxhash64("part", "key", "p.i", "p.j").alias("key"), "probe", "fp"
    )
    return split.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(_finder(radius), "a long, b long")


def _labelled(docs: DataFrame, id_col: str, text_col: str, radius: int, width: int) -> DataFrame:
    """Rows ``(doc_id, mark, fp, root, component_id)``; root is a fingerprint that names the component."""
    marks = staged(with_fingerprints(docs, id_col, text_col, width), "simhash-marks", FEW)
    nodes = staged(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = component_labels(near_links(nodes.select("fp"), radius), "simhash-components")
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = staged(named, "simhash-named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_mark = staged(named.join(least, "root").select("fp", "root", "component_id"), "simhash-least")
    dropped(nodes, named)
    return marks.join(by_mark, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, width: int = 4) -> DataFrame:
    """Rows ``(doc_id, fp, component_id)``, one for each row of ``docs``.

    Null and blank texts have fingerprint zero and link like any other.  Rows with a null id
    belong to their component but never name it; one without any id is named null.  Repeated
    rows stay.  An empty input gives an empty result.  Only the two named columns are read.
    """
    return _labelled(docs, id_col, text_col, radius, width).select("doc_id", "fp", "component_id")


def near_duplicates_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, width: int = 5) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, a null id coming last.  All columns stay.

    Of repeated rows one stays; rows that share an id but not a component all stay.
    """
    return kept_of_each(docs, _labelled(docs, id_col, text_col, radius, width), id_col, text_col)


def kept_of_each(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The first row of each root in ``found(doc_id, mark, root)``."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("x")
    a, b, c = unused(docs, "keep_id", "keep_none", "keep_mark")
    keep = staged(found.groupBy("root").agg(first).select(F.coalesce("x.doc_id", F.lit(-1)).alias(a), F.col("x.none").alias(b), F.col("x.mark").alias(c)).distinct(), "simhash-kept")
    rows = docs.select("*", F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias(a), F.col(id_col).cast("long").isNull().alias(b), F.xxhash64(F.col(text_col).cast("string")).alias(c))
    return rows.join(keep, [a, b, c], "left_semi").dropDuplicates([a, b, c]).select(docs.columns)
