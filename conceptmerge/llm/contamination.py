"""Benchmark decontamination: short test items inside long documents.

Containment search by MinHash sketches of the items.  Of an item with q shingles, the
``q - ceil(t q) + 1`` shingles of least code are its sketch (a bottom-k MinHash of a size
that depends on the item's size).  A document that contains at least the share t of the
item lacks at most ``q - ceil(t q)`` shingles, so it has one of the sketch: the search loses
nothing.  Items are partitioned by size: partition b holds those of ``2**b`` to ``2**(b+1) - 1``
shingles, each partition has a sketch field of its own, and a document is only probed against
partitions whose smallest item it could hold the share t of.  Items of fewer words than a
shingle make partitions with shingles of their own length.  Candidates are verified by exact
containment of their shingles' texts.

Documents are probed where they are read: bit fields of fixed size, one for each partition and
so at most 32 for each shingle length, say which shingles can belong to a sketch; only documents
that pass are shuffled, and of these only shingles that can belong to an item.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .staging import FEW, staged, unused
from .wordcodes import Words, text_buffers

_FIELD_BITS = 24  # 2 MB each


def _plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text bytes in lower case (A-Z) with ASCII punctuation as spaces; words are then runs of letters and digits."""
    data, offsets = text_buffers(column)
    return _PLAIN[data], offsets


def _plain_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isalnum() else 32
    return out


_PLAIN = _plain_table()


def _chunks(column: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, int, Words]]:
    data, offsets = _plain(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1))
        yield lo, hi, Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def plain_words(text: str | None) -> list[bytes]:
    return _PLAIN[np.frombuffer((text or "").encode(), dtype=np.uint8)].tobytes().split()


def _item_shingles(items: DataFrame, width: int, share: Fraction) -> DataFrame:
    """Rows ``(item_id, mark, k, q, shingle, bit, sketched)``: distinct shingles of each item; k is their length in words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for lo, hi, w in _chunks(batch.column(2)):
                for k in sorted({min(width, int(n)) for n in w.counts} - {0}):
                    codes, whole = w.runs(k, 5)
                    for i in np.flatnonzero(np.minimum(w.counts, width) == k).tolist():
                        a, b = int(w.first[i]), int(w.first[i + 1])
                        mine = {b" ".join(w.words(j, j + k)): int(codes[j]) for j in range(a, b - k + 1)}
                        q = len(mine)
                        need = -(-share.numerator * q // share.denominator)
                        sketch = set(sorted(mine, key=lambda s: (mine[s], s))[: q - need + 1])
                        out += [(ids[lo + i], marks[lo + i], k, q, s, mine[s] >> (64 - _FIELD_BITS), s in sketch) for s in mine]
            if out:
                c = list(zip(*out))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.bool_())
                cols = [pa.array(x, t) for x, t in zip(c, kinds)]
                cols[4] = cols[4].cast(pa.string())
                yield pa.RecordBatch.from_arrays(cols, names=["item_id", "mark", "k", "q", "shingle", "bit", "sketched"])

    return items.mapInArrow(run, "item_id long, mark long, k int, q int, shingle string, bit int, sketched boolean")


def _field(rows: DataFrame) -> np.ndarray:
    """A bit field with the given bits set, of fixed size."""
    words = rows.groupBy((F.col("bit") / 64).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("w")).toArrow()
    out = np.zeros(1 << (_FIELD_BITS - 6), dtype=np.int64)
    out[words.column("at").to_numpy()] = words.column("w").to_numpy()
    return out.view(np.uint64)


def _in_field(field: np.ndarray, codes: np.ndarray) -> np.ndarray:
    at = codes >> np.uint64(64 - _FIELD_BITS)
    return (field[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _probed(docs: DataFrame, fields: dict[int, tuple[dict[int, np.ndarray], np.ndarray]], share: Fraction) -> DataFrame:
    """Rows ``(doc_id, row, k, n, shingle)`` for documents that may hold a sketched shingle; n: their shingles of that length.

    ``fields`` has, for each shingle length, the sketch field of each size partition and one field of all shingles.
    """
    any_sketch = {k: np.bitwise_or.reduce(list(by_size.values())) for k, (by_size, _) in fields.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), batch.column(1)
            for lo, hi, w in _chunks(batch.column(2)):
                owner, out = w.owner(), []
                for k, (by_size, everything) in fields.items():
                    codes, whole = w.runs(k, 5)
                    if not len(codes):
                        continue
                    at = np.flatnonzero(whole & _in_field(any_sketch[k], codes))
                    theirs = w.counts[owner[at]] - k + 1
                    hit = np.zeros(len(at), dtype=bool)
                    for b, sketches in by_size.items():
                        able = theirs * share.denominator >= (1 << b) * share.numerator
                        hit |= able & _in_field(sketches, codes[at])
                    for i in np.unique(owner[at[hit]]).tolist():
                        a, b = int(w.first[i]), int(w.first[i + 1])
                        span = np.arange(a, b - k + 1)
                        got = {b" ".join(w.words(j, j + k)) for j in span[_in_field(everything, codes[a : b - k + 1])].tolist()}
                        out += [(lo + i, k, b - a - k + 1, s) for s in got]
                if out:
                    at, k, n, s = zip(*out)
                    at = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), rows.take(at), pa.array(k, pa.int32()), pa.array(n, pa.int64()), pa.array(s, pa.binary()).cast(pa.string())], names=["doc_id", "row", "k", "n", "shingle"]
                    )

    return docs.mapInArrow(run, "doc_id long, row long, k int, n long, shingle string")


def _held(docs: DataFrame, items: DataFrame, share: float, width: int, id_col: str, text_col: str, item_id: str, item_text: str) -> DataFrame:
    """Rows ``(doc_id, row, item_id, mark, q, n_shared)``: which item each document holds; row is a code of its text."""
    exact = Fraction(str(share))
    text = F.col(item_text).cast("string")
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.xxhash64(text).alias("mark"), text.alias("text")).distinct()
    shingles = staged(_item_shingles(asked, width, exact), "contamination-items", FEW)
    size = F.floor(F.log2("q")).cast("int")
    parts = [(r["k"], r["b"]) for r in shingles.select("k", size.alias("b")).distinct().collect()]  # at most width x 32
    fields = {}
    for k in sorted({k for k, _ in parts}):
        mine = shingles.where(F.col("k") == k)
        fields[k] = ({b: _field(mine.where(F.col("sketched") & (size == b))) for b in sorted(b for x, b in parts if x == k)}, _field(mine))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    probes = staged(_probed(rows, fields, exact), "contamination-probes", FEW)
    held = probes.join(shingles, ["k", "shingle"]).where(F.col("n") >= F.ceil(F.col("q") * F.lit(share) - 1e-9))
    return (
        held.select("doc_id", "row", "item_id", "mark", "q", "shingle", "sketched").distinct()
        .groupBy("doc_id", "row", "item_id", "mark", "q").agg(F.count("*").alias("n_shared"), F.max("sketched").alias("sketched"))
        .where(F.col("sketched") & (F.col("n_shared") * exact.denominator >= F.col("q").cast("long") * exact.numerator))
    )


def contaminated(docs: DataFrame, items: DataFrame, share: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows ``(doc_id, item_id, n_shingles, n_shared, containment)``: items of which a document holds the share or more.

    Containment is the share of the item's distinct shingles of ``width`` words that occur in
    the document; words are runs of letters and digits, A-Z in lower case.  An item of fewer
    words is one shingle of that length; one without words is never found.  Null texts are
    empty.  Rows with equal ids are compared each for itself and reported once, with their
    largest containment; null ids form one such group.  Empty tables give an empty result.
    """
    found = _held(docs, items, share, width, id_col, text_col, item_id, item_text)
    best = found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct(F.col("q").cast("long").alias("n_shingles"), "n_shared"), F.col("n_shared") / F.col("q")).alias("x"))
    return best.select("doc_id", "item_id", "x.*", (F.col("x.n_shared") / F.col("x.n_shingles")).alias("containment"))


def decontaminated(docs: DataFrame, items: DataFrame, share: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds the share or more of an item.  All columns stay.

    Rows are told apart by id and text, so a clean row stays even if it has no id or shares
    its id with a contaminated one.
    """
    found = _held(docs, items, share, width, id_col, text_col, item_id, item_text)
    bad_id, bad_mark = unused(docs, "bad_id", "bad_mark")
    bad = found.select(F.col("doc_id").alias(bad_id), F.col("row").alias(bad_mark)).distinct()
    same = docs[id_col].cast("long").eqNullSafe(F.col(bad_id)) & (F.xxhash64(docs[text_col].cast("string")) == F.col(bad_mark))
    return docs.join(bad, same, "left_anti")
