"""Near copies: texts whose sets of word shingles have a Jaccard similarity of ``least`` or more.

Candidates come from two searches.  SimHash fingerprints over the same shingles within a few
bits, found by the pigeonhole search of ``simhash``, connect the close copies at once; but at
a similarity of 0.8 two fingerprints differ in about ten of 64 bits, beyond any radius that
can be searched.  So texts that share one of ``BANDS`` independent fingerprints, each of the
minima of four hash functions over the shingles, are candidates too: a pair of similarity s
shares one with a chance of ``1 - (1 - s**4)**BANDS``, 0.99997 at 0.8.  Only candidates whose
shingles (as 64-bit hashes) really have the similarity are linked, so no other pair is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import component_labels
from .simhash import fingerprint_of, kept_of_each, near_links, shingle_codes
from .staging import FEW, dropped, staged

BANDS, ROWS = 20, 4
_RANDOM = np.random.default_rng(11)
_FLIP = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64)
_TIMES = _RANDOM.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """The text's distinct shingles as sorted hashes."""
    return np.unique(shingle_codes(text, width))


def band_keys(hashes: np.ndarray, block: int = 4096) -> np.ndarray:
    """One key for each band; texts without words have none."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    least = None
    for lo in range(0, len(hashes), block):
        x = (((hashes[None, lo : lo + block] ^ _FLIP) * _TIMES)).min(axis=1)
        least = x if least is None else np.minimum(least, x)
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(bands)], dtype=np.uint64).view(np.int64)


def with_bands(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Rows ``(doc_id, mark, node, fp, n, keys)``: node names the set of n shingles, mark the text, fp is its SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp, sizes, keys = [], [], [], []
            for text in batch.column(2).to_pylist():
                codes = shingle_codes(text, width)
                held = np.unique(codes)
                node.append(xxhash.xxh64_intdigest(held.tobytes()))
                fp.append(fingerprint_of(codes))
                sizes.append(len(held))
                keys.append(band_keys(held))
            signed = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (node, fp)]
            made = [batch.column(0), batch.column(1), *signed, pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "mark", "node", "fp", "n", "keys"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, mark long, node long, fp long, n long, keys array<long>")


def _hashed(texts: DataFrame, width: int) -> DataFrame:
    """Rows ``(node, hashes)`` of ``(node, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [shingle_hashes(x, width).view(np.int64) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, type=pa.list_(pa.int64()))], names=["node", "hashes"])

    return texts.mapInArrow(run, "node long, hashes array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` that have the similarity."""
    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", F.size("x").alias("p"), F.size("y").alias("q"), F.size(F.array_intersect("x", "y")).alias("k"))
    return both.where(F.col("k") >= F.lit(least) * (F.col("p") + F.col("q") - F.col("k"))).select("a", "b")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """How many members each set of ``a`` shares with each of ``b``, by products of 0-1 tables of ``step`` columns."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    everything = [np.concatenate(x) for x in (a, b)]
    common = np.intersect1d(*everything)
    held = []
    for sets, flat in zip((a, b), everything):
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(common, flat), max(len(common) - 1, 0))
        on = common[at] == flat if len(common) else np.zeros(len(flat), dtype=bool)
        order = np.argsort(at[on], kind="stable")
        held.append((owner[on][order], at[on][order]))
    for lo in range(0, len(common), step):
        tables = []
        for sets, (owner, at) in zip((a, b), held):
            i, j = np.searchsorted(at, (lo, lo + step))
            table = np.zeros((len(sets), min(step, len(common) - lo)), dtype=np.float32)
            table[owner[i:j], at[i:j] - lo] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _bucket_links(rows: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b)`` that span what each group ``(key, i, j)`` connects: members of side 0, held, against those of side 1, streamed.

    Groups come one after another, side 0 first.  Pairs are compared in blocks and never
    listed; a group of m components gives at most m - 1 links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, up, first = None, {}, []

        def top(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        def held(part: pa.RecordBatch) -> list[tuple[int, int, np.ndarray]]:
            sets = [x.values.to_numpy() for x in part.column("hashes")]
            return list(zip(part.column("node").to_pylist(), part.column("root").to_pylist(), sets))

        for batch in batches:
            if not batch.num_rows:
                continue
            names = [batch.column(c).to_numpy() for c in ("key", "i", "j", "side")]
            changes = np.zeros(batch.num_rows - 1, dtype=bool)
            for x in names:
                changes |= x[1:] != x[:-1]
            cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
            links: list[tuple[int, int]] = []
            for lo, hi in zip(cuts, cuts[1:]):
                key, i, j, side = (x[lo] for x in names)
                if (key, i, j) != group:
                    group, up, first = (key, i, j), {}, []
                part = held(batch.slice(lo, hi - lo))
                if side == 0:
                    first += part
                    continue
                if not first:
                    continue
                k = shared_counts([x[2] for x in first], [x[2] for x in part]).astype(np.float64)
                size = np.array([len(x[2]) for x in first])[:, None] + np.array([len(x[2]) for x in part])[None, :]
                for x, y in np.argwhere(k >= least * (size - k)).tolist():
                    (a, ra, _), (b, rb, _) = first[x], part[y]
                    ra, rb = top(ra), top(rb)
                    if ra != rb:
                        up[max(ra, rb)] = min(ra, rb)
                        links.append((a, b))
            if links:
                made = np.array(links, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])

    dealt = rows.select("key", "i", "j", "side", "node", "root", "hashes").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
    return dealt.mapInArrow(run, "a long, b long")


def _dealt(at: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Members of open buckets in groups: those outside a bucket's main component, in blocks of ``block`` shingles, meet all its members, in blocks of eight times that."""
    outside, whole = (F.greatest(F.ceil(F.col(c) / F.lit(n)).cast("int"), F.lit(1)) for c, n in (("outside_n", block), ("all_n", 8 * block)))
    i, j = F.pmod(F.xxhash64("node"), outside).cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), whole).cast("int")
    entry = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    asking = F.when(F.col("root") != F.col("main"), F.transform(F.sequence(F.lit(0), whole - 1), lambda x: entry(i, x, 0))).otherwise(F.array().cast("array<struct<i:int,j:int,side:int>>"))
    asked = F.transform(F.sequence(F.lit(0), outside - 1), lambda x: entry(x, j, 1))
    return at.select("key", "node", "root", F.inline(F.concat(asking, asked))).join(sets, "node")


def _pairs(one: DataFrame, other: DataFrame, least: float) -> DataFrame:
    """Distinct pairs of ``(key, node, n, root)`` with ``(key, o_node, o_n, o_root)`` that are not yet connected and whose sizes allow the similarity."""
    near = (F.least("n", "o_n") >= F.lit(least) * F.greatest("n", "o_n")) & (F.col("root") != F.col("o_root"))
    return one.join(other, "key").where(near).select(F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b")).distinct()


def close_pairs(nodes: DataFrame, radius: int) -> DataFrame:
    """Distinct pairs ``(a, b)`` that connect the ``nodes(node, fp)`` whose fingerprints lie within ``radius`` bits."""
    of = staged(nodes.groupBy("fp").agg(F.min("node").alias("first")), "nearcopies-fingerprints")
    near = near_links(of.select("fp"), radius)
    a, b = of.select(F.col("fp").alias("a"), F.col("first").alias("x")), of.select(F.col("fp").alias("b"), F.col("first").alias("y"))
    across = near.join(a, "a").join(b, "b").select("x", "y")
    equal = nodes.join(of, "fp").where("node <> first").select(F.col("first").alias("x"), F.col("node").alias("y"))
    return across.unionByName(equal).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_copy_links(bands: DataFrame, sets: DataFrame, least: float, few: int = 64, most: int = 8, rounds: int = 6, known: DataFrame | None = None, block: int = 1 << 21) -> DataFrame:
    """Links ``(a, b)`` that connect all candidates of ``bands(key, node, n)`` that have the similarity; ``known`` are links found before.

    While the pairs not yet connected are more than ``most`` times the rows, each bucket of
    more than ``few`` first compares its members to one of them, drawn anew in each round: a
    group of near copies becomes one component without a list of its pairs.  What is then not
    connected, or what rounds no longer make much fewer, is compared within its buckets, in
    blocks of at most about ``block`` shingles, so nothing is left out and no pairs are listed.
    Each round starts from the former components as stars, which contract at once.
    """
    shared = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    bands = staged(bands.join(shared, "key"), "nearcopies-bands")
    links, before, spent = known, None, []
    for turn in range(rounds + 1):
        at = bands.withColumn("root", F.col("node"))
        if links is not None:
            roots = component_labels(links, "nearcopies-components")
            dropped(*spent)
            links, spent = roots.select(F.col("node").alias("a"), F.col("root").alias("b")), [roots]
            at = bands.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        of_root = at.groupBy("key", "root").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
        buckets = of_root.groupBy("key").agg(F.sum("c").alias("size"), F.sum(F.col("c") * F.col("c")).alias("sq"), F.sum("n").alias("all_n"), F.max(F.struct("c", "root", "n")).alias("m"))
        buckets = buckets.select("key", "size", "all_n", F.col("m.root").alias("main"), (F.col("all_n") - F.col("m.n")).alias("outside_n"), ((F.col("size") * F.col("size") - F.col("sq")) / 2).alias("open"))
        buckets = staged(buckets.where("open > 0"), "nearcopies-buckets")
        total = buckets.agg(F.sum("open").alias("open"), F.sum("size").alias("size")).first()
        if not total["size"]:
            break
        last = turn == rounds or total["open"] <= most * total["size"] or (before is not None and total["open"] > 0.8 * before)
        before = total["open"]
        at = at.join(buckets if last else buckets.where(F.col("size") > few), "key")
        if last:
            got = staged(_bucket_links(_dealt(at, sets, block), least), "nearcopies-links", 128)
        else:
            other = at.select("key", F.col("node").alias("o_node"), F.col("n").alias("o_n"), F.col("root").alias("o_root"))
            hub = at.groupBy("key").agg(F.min_by(F.struct("node", "n", "root"), F.xxhash64("node", F.lit(turn))).alias("hub")).select("key", "hub.*")
            got = staged(_verified(_pairs(hub, other, least), sets, least), "nearcopies-links")
        dropped(buckets)
        spent.append(got)
        links = got if links is None else links.unionByName(got)
        if last:
            break
    dropped(bands)
    if links is None:
        return sets.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    return links


def _labelled(docs: DataFrame, id_col: str, text_col: str, width: int, least: float, radius: int) -> DataFrame:
    """Rows ``(doc_id, mark, root)``; root names the component."""
    marks = staged(with_bands(docs, id_col, text_col, width), "nearcopies-marks", FEW)
    nodes = marks.groupBy("node").agg(F.min_by(F.struct("doc_id", "mark", "fp", "n", "keys"), F.struct("mark", "doc_id")).alias("x")).select("node", "x.*")
    nodes = staged(nodes, "nearcopies-nodes")
    close = staged(close_pairs(nodes.where("n > 0").select("node", "fp"), radius), "nearcopies-close")
    bands = nodes.select(F.explode("keys").alias("key"), "node", "n")
    shared = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    able = bands.join(shared, "key").select("node").unionByName(close.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    text = F.col(text_col).cast("string")
    here = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("_id"), F.xxhash64(text).alias("_mark"), text.alias("_text"))
    named = nodes.join(able, "node", "left_semi").select(F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("mark").alias("_mark"), "node")
    sets = staged(_hashed(here.join(named, ["_id", "_mark"]).select("node", "_text"), width).dropDuplicates(["node"]), "nearcopies-sets", FEW)
    known = staged(_verified(close, sets, least), "nearcopies-known")
    roots = component_labels(near_copy_links(bands, sets, least, known=known), "nearcopies-components")
    dropped(sets, close, known)
    return marks.select("doc_id", "mark", "node").join(roots, "node", "left").select("doc_id", "mark", F.coalesce("root", "node").alias("root"))


def near_copies_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = 0.8, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each component of linked texts: that of the smallest id, a null id coming last.

    All columns stay.  Texts without words are copies of each other.  Of repeated rows one
    stays; rows that share an id but not a component all stay.  ``radius`` is that of the
    SimHash search and decides how soon, not which, texts are linked.
    """
    return kept_of_each(docs, _labelled(docs, id_col, text_col, width, least, radius), id_col, text_col)
