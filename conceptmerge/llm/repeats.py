"""Removal of passages that already occur in an earlier document.

1. Each window of ``width`` words has an anchor: the least code among its shingles of
   ``seed`` words.  Equal windows have equal anchors, and only about one word in five starts
   an anchor, so finding anchors that occur in two documents is a cheap first sieve.
2. Windows over a recurring anchor are cut from the texts and confirmed by two independent
   64-bit codes, combined before the shuffle: a phrase in a third of all documents is a few
   rows for each task.
3. Confirmed windows are compiled, shard by shard, into Aho-Corasick automata over words.
   The cut passages of every document are streamed through the automaton of the shard that
   their anchor names.  Shards are small, as the automaton searches the many words that may
   follow its root one by one.  The passages of a hot shard are spread over several tasks,
   each with its own copy of that automaton; the phrases of a hot anchor over several
   automata, each of which the shard's passages go through.
4. The words covered by a match of an earlier document's phrase go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .staging import FEW, dropped, settings, staged
from .wordcodes import Words, mixed, sliding_min, word_chunks

NO_ID = (1 << 63) - 1  # a null id counts as later than all others


def _anchors(words: Words, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of the window from each word on, and whether that window lies in one text."""
    least = sliding_min(words.runs(seed, seed=3)[0], width - seed + 1)
    whole = words.runs(width)[1]
    return least[: len(whole)].view(np.int64), whole


def _occurrences(docs: DataFrame, width: int, seed: int) -> DataFrame:
    """Rows ``(anchor, doc, mark)``: the anchors of each text's windows, neighbours merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, w in word_chunks(batch.column(2)):
                anchor, whole = _anchors(w, width, seed)
                if not whole.any():
                    continue
                row = w.owner()[: len(whole)][whole]
                anchor = anchor[whole]
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))
                row = lo + row[new]
                yield pa.RecordBatch.from_arrays([pa.array(anchor[new]), pa.array(ids[row]), pa.array(marks[row])], names=["anchor", "doc", "mark"])

    return docs.select("doc", "mark", "text").mapInArrow(run, "anchor long, doc long, mark long")


def _passages(docs: DataFrame, width: int, seed: int) -> DataFrame:
    """Maximal runs of windows with a recurring anchor: ``(doc, mark, place, run, text)``; place is the first word's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            hits = batch.column(3)
            for lo, hi, w in word_chunks(batch.column(2)):
                anchor, _ = _anchors(w, width, seed)
                out: list[tuple[int, int, int, bytes]] = []
                for i in range(lo, hi):
                    a, b = int(w.first[i - lo]), int(w.first[i - lo + 1])
                    if b - a < width:
                        continue
                    known = hits[i].values.to_numpy(zero_copy_only=False)
                    on = np.isin(anchor[a : b - width + 1], known)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.view(np.int8), [0]])))
                    for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                        out.append((i, s, e - s, b" ".join(w.words(a + s, a + e + width - 1))))
                if out:
                    rows, place, n, text = zip(*out)
                    at = np.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(marks[at]), pa.array(place, pa.int32()), pa.array(n, pa.int32()), pa.array(text, pa.binary()).cast(pa.string())],
                        names=["doc", "mark", "place", "n_windows", "text"],
                    )

    return docs.select("doc", "mark", "text", "hits").mapInArrow(run, "doc long, mark long, place int, n_windows int, text string")


def _windows(passages: DataFrame, width: int) -> DataFrame:
    """Rows ``(c1, c2, doc, passage)`` for each window of each passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seg = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, w in word_chunks(batch.column(2)):
                c1, whole = w.runs(width, 1)
                c2, _ = w.runs(width, 2)
                own = w.owner()[: len(whole)][whole]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c1[whole].view(np.int64)), pa.array(c2[whole].view(np.int64)), pa.array(ids[lo:hi][own]), pa.array(seg[lo:hi][own])],
                    names=["c1", "c2", "doc", "passage"],
                )

    return passages.select("doc", "passage", "text").mapInArrow(run, "c1 long, c2 long, doc long, passage long")


_PIECE = "shard long, kind int, doc long, mark long, place int, text string, firsts array<long>"


def _stretches(w: Words, anchor: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``[from, to)`` of neighbouring wanted windows of one text that share an anchor."""
    owner = w.owner()[: len(anchor)]
    change = np.ones(len(anchor), dtype=bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (wanted[1:] != wanted[:-1])
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], len(anchor))
    return begin[wanted[begin]], end[wanted[begin]]


def _texts_of(w: Words, begin: np.ndarray, end: np.ndarray, width: int) -> pa.Array:
    """The words of the windows ``[begin, end)`` as they stand; passages have single spaces."""
    lo, hi = w.starts[begin], w.ends[end + width - 2]
    at = np.append(0, np.cumsum(hi - lo))
    data = w.data[np.arange(at[-1]) + np.repeat(lo - at[:-1], hi - lo)]
    return pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(at), pa.py_buffer(data)).cast(pa.string())


def _pieces(passages: DataFrame, width: int, seed: int, shards: int) -> DataFrame:
    """What is looked up: passages cut where the anchor changes, each with its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, places = (batch.column(c).to_numpy() for c in (0, 1, 2))
            for lo, hi, w in word_chunks(batch.column(3)):
                anchor, whole = _anchors(w, width, seed)
                begin, end = _stretches(w, anchor, whole)
                if not len(begin):
                    continue
                own = w.owner()[begin]
                place = places[lo + own] + (begin - w.first[own])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[begin] % shards), pa.array(np.ones(len(begin), np.int32)), pa.array(ids[lo + own]), pa.array(marks[lo + own]), pa.array(place.astype(np.int32)),
                        _texts_of(w, begin, end, width), pa.nulls(len(begin), pa.list_(pa.int64())),
                    ],
                    names=["shard", "kind", "doc", "mark", "place", "text", "firsts"],
                )

    return passages.select("doc", "mark", "place", "text").mapInArrow(run, _PIECE)


def _window_key(owner: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
    return mixed(mixed(c1.view(np.uint64)) + c2.view(np.uint64)) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _phrases(sources: DataFrame, width: int, seed: int, shards: int) -> DataFrame:
    """What is compiled: of each source passage the confirmed windows, with the first document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            f1, f2, first = (lists.values.field(x).to_numpy() for x in ("c1", "c2", "first"))
            for lo, hi, w in word_chunks(batch.column(0)):
                anchor, whole = _anchors(w, width, seed)
                if not whole.any():
                    continue
                c1, c2 = (w.runs(width, k)[0].view(np.int64) for k in (1, 2))
                at = slice(ends[lo], ends[hi])
                known = _window_key(np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1])), f1[at], f2[at])
                order = np.argsort(known)
                asked = _window_key(w.owner()[: len(c1)], c1, c2)
                place = np.minimum(np.searchsorted(known[order], asked), len(known) - 1)
                wanted = whole & (known[order][place] == asked)
                begin, end = _stretches(w, anchor, wanted)
                if not len(begin):
                    continue
                none = pa.nulls(len(begin), pa.int64())
                firsts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(end - begin)).astype(np.int32)), pa.array(first[at][order][place][wanted]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[begin] % shards), pa.array(np.zeros(len(begin), np.int32)), none, none, pa.nulls(len(begin), pa.int32()), _texts_of(w, begin, end, width), firsts],
                    names=["shard", "kind", "doc", "mark", "place", "text", "firsts"],
                )

    return sources.select("text", "found").mapInArrow(run, _PIECE)


class PhraseAutomaton:
    """Aho-Corasick over word numbers: finds phrases of ``width`` words and the first document of each."""

    def __init__(self, width: int, remembered: int = 100_000):
        self.width, self.remembered = width, remembered
        self.seen: dict[str, list[tuple[int, int, int]]] = {}
        self.numbers: dict[str, int] = {}
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        self.size = 0

    def add(self, text: str, firsts: list[int]) -> None:
        got = [self.numbers.setdefault(x, len(self.numbers) + 1) for x in text.split(" ")]
        for i, first in enumerate(firsts):
            self.machine.add_word(tuple(got[i : i + self.width]), first)
            self.size += 1

    def ready(self) -> PhraseAutomaton:
        if self.size:
            self.machine.make_automaton()
        return self

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """``(first word, word after the last, first document)`` of runs of neighbouring matches; texts met before are remembered."""
        if not self.size:
            return []
        got = self.seen.get(text)
        if got is None:
            known = self.numbers.get
            got, lo, hi, whose = [], 0, -1, None
            for end, first in self.machine.iter(tuple([known(x, 0) for x in text.split(" ")])):
                if first == whose and end == hi:
                    hi += 1
                    continue
                if whose is not None:
                    got.append((lo, hi, whose))
                lo, hi, whose = end - self.width + 1, end + 1, first
            if whose is not None:
                got.append((lo, hi, whose))
            if len(self.seen) >= self.remembered:
                self.seen.clear()
            self.seen[text] = got
        return got


def _located(rows: DataFrame, width: int) -> DataFrame:
    """Rows ``(doc, mark, place, n)``: runs of n words covered by an earlier document's phrases.

    Each task gets shards one after another, phrases before pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        automaton, open_ = PhraseAutomaton(width), True
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, salt, kind = (batch.column(c).to_numpy() for c in ("shard", "salt", "kind"))
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1]) | (kind[1:] != kind[:-1])) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kind)]):
                if (shard[i], salt[i]) != at:
                    at, automaton, open_ = (shard[i], salt[i]), PhraseAutomaton(width), True
                part = batch.slice(i, j - i)
                if kind[i] == 0:
                    for text, firsts in zip(part.column("text").to_pylist(), part.column("firsts").to_pylist()):
                        automaton.add(text, firsts)
                    continue
                if open_:
                    automaton.ready()
                    open_ = False
                found = _found(part, automaton)
                if found is not None:
                    yield found

    return rows.mapInArrow(run, "doc long, mark long, place int, n int")


def _found(pieces: pa.RecordBatch, automaton: PhraseAutomaton) -> pa.RecordBatch | None:
    """What the automaton finds of earlier documents; equal texts are searched once."""
    coded = pieces.column("text").dictionary_encode()
    matches = [automaton.matches(text) for text in coded.dictionary.to_pylist()]
    many = np.array([len(m) for m in matches], dtype=np.int64)
    if not many.any():
        return None
    lo, hi, first = np.array([x for m in matches for x in m], dtype=np.int64).T
    text = coded.indices.to_numpy()
    row = np.repeat(np.arange(len(text)), many[text])
    nth = np.arange(len(row)) - np.repeat(np.cumsum(many[text]) - many[text], many[text])
    hit = (np.cumsum(many) - many)[text[row]] + nth
    doc, mark, place = (pieces.column(c).to_numpy() for c in ("doc", "mark", "place"))
    on = first[hit] < doc[row]
    row, hit = row[on], hit[on]
    spans = (place[row] + lo[hit]).astype(np.int32), (hi[hit] - lo[hit]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(mark[row]), *map(pa.array, spans)], names=["doc", "mark", "place", "n"])


def _cleaned(docs: DataFrame) -> DataFrame:
    """What is left of each text, with counts and a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2)
            n_words, n_removed, digests, texts = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = (text or "").encode().split()
                gone = spans[i].as_py()
                kept = words
                if gone:
                    on = np.zeros(len(words) + 1, dtype=np.int64)
                    for g in gone:
                        on[g["place"]] += 1
                        on[g["place"] + g["n"]] -= 1
                    covered = np.cumsum(on)[:-1] > 0
                    kept = [x for x, c in zip(words, covered.tolist()) if not c]
                left = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(left).hexdigest())
                texts.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return docs.select("doc_id", "text", "gone").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, seed: int = 5, phrases_a_shard: int = 200, pieces_a_task: int = 100_000, phrases_a_machine: int = 5_000) -> DataFrame:
    """Rows ``(doc, mark, place, n)``: words of ``docs`` that repeat a window of an earlier document.

    doc is the id (``NO_ID`` for null), mark a code of the text, place the first word.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col)
    seen = staged(_occurrences(keyed, width, seed), "repeats-anchors", FEW)
    recurring = staged(seen.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("anchor"), "repeats-recurring")
    hits = staged(seen.join(recurring, "anchor", "left_semi").groupBy("doc", "mark").agg(F.collect_set("anchor").alias("hits")), "repeats-hits")
    dropped(seen, recurring)
    passages = staged(
        _passages(keyed.join(hits, ["doc", "mark"]), width, seed).withColumn("passage", F.xxhash64("doc", "mark", "place")), "repeats-passages"
    )
    dropped(hits)
    confirmed = staged(
        _windows(passages, width).groupBy("c1", "c2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.min("passage").alias("passage")).where("first < last").drop("last"),
        "repeats-confirmed",
    )
    shards = max(1, -(-confirmed.count() // phrases_a_shard))
    found = confirmed.groupBy("passage").agg(F.collect_list(F.struct("c1", "c2", "first")).alias("found"))
    phrases = staged(_phrases(passages.select("passage", "text").join(found, "passage"), width, seed, shards), "repeats-phrases")
    pieces = staged(_pieces(passages, width, seed, shards), "repeats-pieces")
    dropped(confirmed, passages)
    load = (
        pieces.groupBy("shard").agg(F.ceil(F.count("*") / pieces_a_task).cast("int").alias("copies"))
        .join(phrases.groupBy("shard").agg(F.ceil(F.sum(F.size("firsts")) / phrases_a_machine).cast("int").alias("machines")), "shard")
    )
    load = staged(load, "repeats-load")
    copies, machines = F.col("copies"), F.col("machines")
    own = F.pmod(F.xxhash64("text"), machines) * copies  # a phrase is in one machine of its shard, and in each copy of that
    to = F.pmod(F.xxhash64("doc", "mark", "place"), copies)  # a piece goes to one copy of each machine
    dealt = (
        phrases.join(load, "shard").withColumn("salt", F.explode(F.transform(F.sequence(F.lit(0), copies - 1), lambda c: (own + c).cast("int"))))
        .unionByName(pieces.join(load, "shard").withColumn("salt", F.explode(F.transform(F.sequence(F.lit(0), machines - 1), lambda m: (m * copies + to).cast("int")))))
        .select("shard", "salt", "kind", "doc", "mark", "place", "text", "firsts")
        .repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    )
    with settings(spark, values={"spark.sql.execution.arrow.maxRecordsPerBatch": "4096"}):
        out = staged(_located(dealt, width), "repeats-spans")
    dropped(phrases, pieces, load)
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"))


def passages_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, **limits: int) -> DataFrame:
    """Rows ``(doc_id, n_words, n_removed, kept_sha256, kept_text)``, one for each row of ``docs``.

    A word goes if a window of ``width`` words that covers it also starts in a document with a
    smaller id.  A null id counts as larger than all others; a null text as empty; rows with
    equal ids never remove from one another; a document of fewer words than ``width`` loses
    nothing.  Kept words are joined by one space.  An empty input gives an empty result.
    """
    spans = repeated_passages(docs, id_col, text_col, width, **limits)
    gone = spans.groupBy("doc", "mark").agg(F.collect_set(F.struct("place", "n")).alias("gone"))  # equal rows of one id find the same
    joined = _keyed(docs, id_col, text_col).join(gone, ["doc", "mark"], "left")
    return _cleaned(joined.select(F.expr(f"nullif(doc, {NO_ID}L)").alias("doc_id"), "text", "gone"))
