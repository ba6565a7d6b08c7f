"""Alignment of the tokens of two tokenizers over the same texts.

The texts of a batch are laid end to end, and so are their tokens; ends of tokens are then
running sums of token lengths.  One count over the places where tokens of A and of B end
tells everything: places counted twice are the common cuts, which part the tokens into
groups, and any two neighbouring places bound the overlap of exactly one A token with one B
token, a link.  Sums up to the documents' ends, subtracted, give each document's share.

How often a pair of ids is linked in the whole corpus is an aggregation over pairs.  The
pairs linked most (a fixed number, ``direct``) go to all workers; what a document holds
besides meets its counts in a join.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .packing import FastEncoder, _byte_letters
from .staging import FEW, dropped, staged

_MARK = "▁"  # fixed value: how piece models write a space
_FIRST, _SECOND = operator.itemgetter(0), operator.itemgetter(1)


class PairEncoder:
    """Ids of a text, with a space before it, by a byte-level BPE (A) and a piece model (B), as little-endian 32-bit bytes.

    No token of either goes over a blank into the next word, so texts whose blanks are single
    spaces and line feeds are chains of words, each with the blank before it.  Words not met
    before are encoded together, in one pass of each tokenizer, and kept.  Texts with other
    blanks go to the tokenizers whole.  Special tokens in a text are plain text.
    """

    def __init__(self, path_a: str, path_b: str, kept: int = 400_000):
        import sentencepiece
        from tokenizers import Tokenizer

        self.plain_a = FastEncoder(path_a).plain
        self.whole_a = Tokenizer.from_file(path_a)
        self.whole_a.encode_special_tokens = True
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.kept, self.units = kept, {}
        letters = _byte_letters()
        vocab = sorted(self.whole_a.get_vocab(with_added_tokens=True).items(), key=_SECOND)
        n_a, n_b = vocab[-1][1] + 1, self.model.get_piece_size()
        of_a = [b""] * n_a
        for token, i in vocab:
            of_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        of_b = []
        for i in range(n_b):
            piece = self.model.id_to_piece(i)
            of_b.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(_MARK, " ").encode())
        self.bytes_a, self.bytes_b = pa.array(of_a, pa.large_binary()), pa.array(of_b, pa.large_binary())
        self.sizes_a, self.sizes_b = np.array([len(x) for x in of_a]), np.array([len(x) for x in of_b])
        self.n_a, self.n_b = n_a, n_b
        #: Whether a token begins with a blank.
        self.opens_a, self.opens_b = (np.array([x[:1] in (b" ", b"\n") for x in of]) for of in (of_a, of_b))
        #: A ids before a comma and before a bar, then B ids before a comma, before a semicolon and at the end.
        self.written = pa.array(
            [f"{i}{s}" for s in (",", "|") for i in range(n_a)] + [f"{i}{s}" for s in (",", ";", "") for i in range(n_b)], pa.large_string()
        )

    def _learn(self, words: list[str]) -> None:
        """Tokens of words, each with the blank before it; a token that begins with a blank begins a word."""
        for lo in range(0, len(words), 4096):
            some = words[lo : lo + 4096]
            said = "".join(w if w[:1] == "\n" else " " + w for w in some)
            a = np.array(self.plain_a.encode_ordinary(said), dtype="<u4")
            b = np.array(self.model.encode(said[1:] if said[:1] == " " else said), dtype="<u4")
            if said[:1] != " ":
                b = b[1:]  # without the added space
            parts = []
            for ids, opens in ((a, self.opens_a), (b, self.opens_b)):
                at = np.append(np.flatnonzero(opens[ids]), len(ids)) * 4
                raw = ids.tobytes()
                parts.append([raw[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())])
            self.units.update(zip(some, zip(*parts), strict=True))

    def encode(self, texts: Sequence[str | None]) -> list[tuple[bytes, bytes]]:
        """Tokens of each text; none where it is null or empty."""
        chains, out = [], []
        for t in texts:
            plain = t and " ".join(t.split()) == t.replace("\n", " ") and _MARK not in t and "\u180e" not in t
            chains.append((t.replace("\n", " \n") if "\n" in t else t).split(" ") if plain else None)
        words = set().union(*filter(None, chains))
        new = words.difference(self.units)
        if len(self.units) + len(new) > self.kept:
            self.units.clear()
            new = words
        self._learn(list(new))
        for t, chain in zip(texts, chains):
            if chain:
                got = list(map(self.units.__getitem__, chain))
                out.append((b"".join(map(_FIRST, got)), b"".join(map(_SECOND, got))))
            elif t:
                out.append(tuple(np.array(ids, dtype="<u4").tobytes() for ids in (self.whole_a.encode(" " + t, add_special_tokens=False).ids, self.model.encode(t))))
            else:
                out.append((b"", b""))
        for word in new:
            if len(word) > 64:
                del self.units[word]
        return out


_encoders: dict[tuple[str, str], PairEncoder] = {}


def encoder(path_a: str, path_b: str) -> PairEncoder:
    """One encoder for each Python worker."""
    if (path_a, path_b) not in _encoders:
        _encoders[path_a, path_b] = PairEncoder(path_a, path_b)
    return _encoders[path_a, path_b]


def _joined(table: pa.Array, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The entries of the ids end to end, and where each begins and the last ends."""
    taken = table.take(pa.array(ids))
    _, places, data = taken.buffers()
    at = np.frombuffer(places, np.int64, len(ids) + 1)
    return memoryview(data or b"").cast("B")[: at[-1]], at


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring places."""
    return np.diff(np.append(0, np.cumsum(values))[at])


class Aligned:
    """The tokens, cuts and links of some texts; texts without tokens have none of them."""

    def __init__(self, enc: PairEncoder, texts: Sequence[str | None]):
        bodies = [f" {t}".encode() if t else b"" for t in texts]
        parts = enc.encode(texts)
        a, b = (np.frombuffer(b"".join(map(side, parts)), "<u4").astype(np.int64) for side in (_FIRST, _SECOND))
        said_a, said_b, want = _joined(enc.bytes_a, a), _joined(enc.bytes_b, b), b"".join(bodies)
        if said_a[0] != want or said_b[0] != want:
            at_a, at_b = (np.append(0, np.cumsum([len(side(p)) // 4 for p in parts])) for side in (_FIRST, _SECOND))
            for i, body in enumerate(bodies):
                if any(said[0][said[1][at[i]] : said[1][at[i + 1]]] != body for said, at in ((said_a, at_a), (said_b, at_b))):
                    bodies[i], parts[i] = b"", (b"", b"")
            a, b = (np.frombuffer(b"".join(map(side, parts)), "<u4").astype(np.int64) for side in (_FIRST, _SECOND))
        self.enc, self.a, self.b = enc, a, b
        self.n_a, self.n_b = (np.array([len(side(p)) // 4 for p in parts], dtype=np.int64) for side in (_FIRST, _SECOND))
        self.stops = np.append(0, np.cumsum([len(x) for x in bodies]))
        self.ends_a, self.ends_b = np.cumsum(enc.sizes_a[a]), np.cumsum(enc.sizes_b[b])
        hits = np.bincount(np.concatenate([self.ends_a, self.ends_b]), minlength=self.stops[-1] + 1)
        self.edges = np.flatnonzero(hits)
        self.cut = hits[self.edges] == 2
        #: Whether a token of A ends its group, and likewise of B.
        self.last_a, self.last_b = hits[self.ends_a] == 2, hits[self.ends_b] == 2
        self.links_at = np.searchsorted(self.edges, self.stops, side="right")
        self.n_links = np.diff(self.links_at)
        self.n_groups = _sums(self.cut, self.links_at)

    def pairs(self) -> np.ndarray:
        """Of each link the number ``A id * size of B + B id``, in the order of the texts."""
        ends = np.zeros(self.stops[-1] + 1, dtype=bool)
        ends[self.ends_a] = True
        is_a = ends[self.edges]
        is_b = ~is_a | self.cut
        return self.a[np.cumsum(is_a) - is_a] * self.enc.n_b + self.b[np.cumsum(is_b) - is_b]

    def groups(self) -> tuple[memoryview, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of all texts, and where each begins and the last ends."""
        g_a, g_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        n = int(self.cut.sum())
        before_b = np.cumsum(np.bincount(g_b, minlength=n)) - np.bincount(g_b, minlength=n)
        up_to_a = np.cumsum(np.bincount(g_a, minlength=n))
        which = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        which[np.arange(len(self.a)) + before_b[g_a]] = self.a + self.enc.n_a * self.last_a
        follows = self.last_b.astype(np.int64)
        follows[(np.cumsum(self.n_b) - 1)[self.n_b > 0]] = 2
        which[np.arange(len(self.b)) + up_to_a[g_b]] = 2 * self.enc.n_a + self.b + self.enc.n_b * follows
        data, places = _joined(self.enc.written, which)
        return data, places[np.append(0, np.cumsum(self.n_a + self.n_b))]


def _chunks(texts: list[str | None], most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters, or one text."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > most:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def _lists(values: np.ndarray, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))


def token_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, a, b, a_until, b_until)``: the ids of both tokenizers, and up to which index of each a group goes.

    Group g holds the ids from ``a_until[g - 1]`` (0 for the first) to before ``a_until[g]``,
    and likewise of B.  Lists are empty where a text has no tokens (see ``alignments``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path_a, path_b)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _chunks(texts):
                t = Aligned(enc, texts[lo:hi])
                at_a, at_b = (np.append(0, np.cumsum(n)) for n in (t.n_a, t.n_b))
                until = [np.flatnonzero(last) + 1 - np.repeat(at[:-1], t.n_groups) for last, at in ((t.last_a, at_a), (t.last_b, at_b))]
                at = np.append(0, np.cumsum(t.n_groups))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), _lists(t.a.astype(np.int32), at_a), _lists(t.b.astype(np.int32), at_b), *(_lists(u.astype(np.int32), at) for u in until)],
                    names=["doc_id", "a", "b", "a_until", "b_until"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, a array<int>, b array<int>, a_until array<int>, b_until array<int>"
    )


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", direct: int = 500_000) -> DataFrame:
    """Rows ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one for each document.

    A text that is null or empty, or whose tokens' bytes are not those of the text with a
    space before it by either tokenizer, has no tokens: zeros and an empty digest.  Rows with
    equal or null ids are separate documents.  An empty input gives an empty result.

    Workers hold the counts of the ``direct`` pairs linked most, a table of fixed size.
    """
    spark = docs.sparkSession
    head = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    base = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path_a, path_b)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in _chunks(texts):
                t = Aligned(enc, texts[lo:hi])
                data, places = t.groups()
                sha = [hashlib.sha256(data[i:j]).hexdigest() if j > i else "" for i, j in zip(places[:-1], places[1:])]
                owner = np.repeat(np.arange(hi - lo), t.n_links)
                span = enc.n_a * enc.n_b
                held, times = np.unique(owner * span + t.pairs(), return_counts=True)
                at = np.searchsorted(held, np.arange(hi - lo + 1) * span)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(lo, hi - lo) for c in ("row", "doc_id")), *(pa.array(x, pa.int64()) for x in (t.n_a, t.n_b, t.n_groups, t.n_links)),
                        pa.array(sha, pa.string()), _lists((held % span).astype(np.int64), at), _lists(times.astype(np.int32), at),
                    ],
                    names=[*head, "pairs", "times"],
                )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, which = np.unique(batch.column("pairs").flatten().to_numpy(), return_inverse=True)
            if len(pairs):
                n = np.bincount(which, weights=batch.column("times").flatten().to_numpy()).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = staged(rows.mapInArrow(tokens, f"{base}, pairs array<long>, times array<int>"), "alignment-links", FEW, codec="zstd")
    counts = staged(found.select("pairs", "times").mapInArrow(added, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts")
    n_b = _pieces(path_b)
    most = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("most"))
    judged = staged(
        counts.withColumn("b", F.col("pair") % n_b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-judged"
    )
    top = judged.orderBy(F.desc("n"), "pair").limit(direct).toArrow()
    order = np.argsort(top["pair"].to_numpy())
    known = spark.sparkContext.broadcast(tuple(top[c].to_numpy()[order] for c in ("pair", "n", "best")))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            lists = batch.column("pairs")
            at = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            held, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            place = np.minimum(np.searchsorted(pair, held), max(len(pair) - 1, 0))
            hit = pair[place] == held if len(pair) else np.zeros(len(held), dtype=bool)
            weigh = lambda x: _sums(np.where(hit, x[place] * times, 0), at) if len(pair) else np.zeros(len(at) - 1, np.int64)
            rest = np.append(0, np.cumsum(_sums(~hit, at)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in head), pa.array(weigh(best.astype(np.int64))), pa.array(weigh(n)), _lists(held[~hit], rest), _lists(times[~hit].astype(np.int32), rest)],
                names=[*head, "n_best", "count_sum", "pairs", "times"],
            )

    partly = staged(found.mapInArrow(summed, f"{base}, n_best long, count_sum long, pairs array<long>, times array<int>"), "alignment-partly", codec="zstd")
    dropped(found, counts)
    rare = partly.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    rare = (
        rare.join(judged, "pair").groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0)).cast("long")).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    )
    out = partly.drop("pairs", "times").join(rare, "row", "left")
    more = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).alias(c)
    out = staged(out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", more("n_best", "more_best"), more("count_sum", "more_sum"), "groups_sha256"), "alignment-documents")
    dropped(partly, judged)
    return out


def _pieces(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
