"""Packing of tokenised documents into training sequences by best-fit decreasing.

Documents are cut into full windows and a rest.  Which window a piece of a given length
goes to depends only on how many pieces of each length there are, so the packing is decided
on the length counts (at most ``size`` numbers, whatever the corpus): pieces from long to
short go to the tightest open window, found in a segment tree indexed by remaining capacity;
windows that are alike are handled together.  Each piece then looks its place up by its rank
among the pieces of its length.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .staging import FEW, dropped, staged

_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed values: the published pre-tokenizer pattern
#: Where a blank may be more than one plain space or line feed before a word, texts are encoded whole.
_ODD_BLANKS = re.compile(r"[ \n][ \n]|[ \n]\Z|[\t\r\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -     　]")


class FastEncoder:
    """Token ids of the byte-level BPE in a tokenizers JSON file, as little-endian 32-bit bytes.

    A blank always begins a new piece of the pre-tokenizer, so a text is the chain of its
    words, each with the blank before it.  Words are encoded once and kept, up to ``kept``
    of them.  New words go through tiktoken with the ranks of the same file, which makes the
    same merges; texts with special tokens or unusual blanks go to tokenizers itself.
    """

    def __init__(self, path: str, kept: int = 250_000):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec["added_tokens"]]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.plain = tiktoken.Encoding("plain", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
        self.kept = kept
        self.after_space: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.line_feed = self._new("\n")

    def _new(self, text: str) -> bytes:
        return np.array(self.plain.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(x in text for x in self.special) or _ODD_BLANKS.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        out, spaced, bare = [], self.after_space, self.bare
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self.line_feed)
            first, *rest = line.split(" ")
            if first:
                got = bare.get(first)
                if got is None:
                    if len(bare) >= self.kept:
                        bare.clear()
                    got = bare[first] = self._new(first)
                out.append(got)
            for word in rest:
                got = spaced.get(word)
                if got is None:
                    if len(spaced) >= self.kept:
                        spaced.clear()
                    got = spaced[word] = self._new(" " + word)
                out.append(got)
        return b"".join(out)


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): b for b in own}, 256
    for b in range(256):
        if b not in own:
            out[chr(extra)] = b
            extra += 1
    return out


_encoders: dict[str, FastEncoder] = {}


def encoder(path: str) -> FastEncoder:
    """One encoder for each Python worker."""
    if path not in _encoders:
        _encoders[path] = FastEncoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, start, length, ids_crc32, doc_tokens)``: full windows of each document and its rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        for batch in batches:
            row, start, length, crc, whole = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = enc.encode(text or "") + tail
                n = len(ids) // 4
                for s in range(0, n, size):
                    part = ids[4 * s : 4 * (s + size)]
                    row.append(i)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    whole.append(n)
            if row:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (start, length, crc, whole))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    )


class CapacityTree:
    """Open windows by remaining capacity; finds the least capacity that is enough."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.filled = [0] * (2 * self.leaves)
        self.at: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def put(self, capacity: int, first: int, n: int) -> None:
        """Windows first to first + n - 1 have this much room."""
        self.at[capacity].append((first, n))
        i = capacity + self.leaves
        while i:
            self.filled[i] += 1
            i //= 2

    def take(self, need: int) -> tuple[int, int, int] | None:
        """Remove and return (capacity, first, n) of the tightest windows with room for ``need``."""
        i = need + self.leaves
        if not self.filled[i]:
            while i > 1 and (i & 1 or not self.filled[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i *= 2
                if not self.filled[i]:
                    i += 1
        capacity = i - self.leaves
        first, n = self.at[capacity].pop()
        while i:
            self.filled[i] -= 1
            i //= 2
        return capacity, first, n


def best_fit(counts: dict[int, int], size: int) -> tuple[np.ndarray, int]:
    """The packing of ``counts[length]`` pieces, and the number of windows.

    Rows (length, first rank, pieces, first window, pieces a window, offset): the pieces of
    that length from that rank on go in order into consecutive windows.
    """
    tree, plan, windows = CapacityTree(size), [], 0
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        while left:
            got = tree.take(length)
            if got is None:
                each = size // length
                n = -(-left // each)
                got = (size, windows, n)
                windows += n
            capacity, first, n = got
            each = capacity // length
            put = min(left, n * each)
            plan.append((length, rank, put, first, each, size - capacity))
            full, rest = divmod(put, each)
            for a, k, used in ((first, full, each), (first + full, 1 if rest else 0, rest), (first + full + (rest > 0), n - full - (rest > 0), 0)):
                if k and capacity - used * length:
                    tree.put(capacity - used * length, a, k)
            rank, left = rank + put, left - put
    return np.array(plan, dtype=np.int64).reshape(-1, 6), windows


def packed(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", rows_a_task: int = 200_000) -> DataFrame:
    """Rows ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``: where each piece of each document lies.

    A null or empty text is the end token alone.  Rows with equal or null ids are separate
    documents.  Sequences are numbered from 0, and pieces lie in one without gaps from
    offset 0.  An empty input gives an empty result.
    """
    pieces = staged(token_pieces(docs, tokenizer, size, end_id, id_col, text_col), "packing-pieces", FEW)
    by_length = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan, _ = best_fit(by_length, size)
    shares = max(1, -(-sum(by_length.values()) // rows_a_task))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shares)))
    before = (
        salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    )
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1
    ranked = salted.withColumn("within", within).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("within"))
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    plan = plan[order]
    key = plan[:, 0] * (1 << 44) + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            p = plan[np.searchsorted(key, length * (1 << 44) + rank, side="right") - 1]
            nth = rank - p[:, 1]
            made = [*(batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), pa.array(p[:, 3] + nth // p[:, 4]), pa.array(p[:, 5] + nth % p[:, 4] * length)]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
