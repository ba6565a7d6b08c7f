"""A Brown class-based bigram model, and held-out scores of whole documents.

``P(text) = product of P(class | class before) * P(word | class)``, from the end mark to the
end mark.  Classes are learned in two steps, both from all training text:

1. Exchange clustering of the most frequent words: each moves to the class that raises the
   likelihood most, until none moves.  All other words take part in it as groups by spelling,
   which only serve as a first guess of the classes that stand beside them.
2. Every other word of the vocabulary goes to the class under which the classes that follow
   and precede it in training are most likely: an aggregation by word, so the vocabulary may
   be of any size.  Its table is joined, never collected; workers hold its most frequent words.

Transitions and emissions are then counted with the final classes.  Absolute discounting
takes a share of each word for one unknown word, which has a class of its own: a token of a
word that occurs c times counts ``1 - d/c`` for its class and ``d/c`` for the unknown one, so
what stands beside unknown words is learned too.  The emissions of each class sum to one over
its words, and those of the unknown class are the unknown word alone.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .staging import FEW, dropped, settings, staged

END = b""  # no word is empty
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LONG = 64
_OTHER = (1 << 16) - 1  # the place of a word that workers do not hold


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case; one of more than 64 bytes stands as a digest, so that tables of words have a known size."""
    found = (text or "").encode().translate(_LOWER).split()
    if any(len(x) > _LONG for x in found):
        found = [x if len(x) <= _LONG else b" " + hashlib.sha256(x).hexdigest()[:48].encode() + x[-3:].hex().encode() for x in found]
    return found


def spelling_group(word: bytes, groups: int) -> int:
    return zlib.crc32(word[-3:]) % groups


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _words(column: list[bytes]) -> pa.Array:
    return pa.array(column, pa.binary()).cast(pa.string())


def word_counts(texts: DataFrame, flush: int = 300_000) -> DataFrame:
    """Rows ``(word, c)`` over all tokens of the texts, end marks included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([_words(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return made

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(tokens(text))
                seen[END] += 1
            if len(seen) > flush:
                yield out()
        if seen:
            yield out()

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _places(table: dict[bytes, int], words: list[bytes], other: int, kind: type) -> np.ndarray:
    """The number of each word; ``map`` looks them up without a Python step for each."""
    return np.fromiter(map(table.get, words, repeat(other)), dtype=kind, count=len(words))


@dataclass
class Units:
    """Numbers of words in the first step: exchanged words by place, all others by spelling after them; ``direct`` holds those of frequent words."""

    exchanged: int
    groups: int
    direct: dict[bytes, int] = field(default_factory=dict)
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def size(self) -> int:
        return self.exchanged + self.groups

    def coded(self, words: list[bytes]) -> np.ndarray:
        low, n = self.exchanged, self.groups
        out = _places(self.direct, words, -1, np.int64)
        for k in np.flatnonzero(out < 0).tolist():
            out[k] = low + zlib.crc32(words[k][-3:]) % n
        return out


def unit_bigrams(texts: DataFrame, units: Units) -> np.ndarray:
    """Counts of neighbouring units over all texts: a table of fixed size."""
    n = units.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n, dtype=np.int64)
        for batch in batches:
            pairs = []
            for text in batch.column(0).to_pylist():
                unit = units.coded([END, *tokens(text), END])
                pairs.append(unit[:-1] * n + unit[1:])
            if pairs:
                total += np.bincount(np.concatenate(pairs), minlength=n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["cell", "n"])

    with settings(texts.sparkSession, values={"spark.sql.execution.arrow.maxRecordsPerBatch": str(FEW)}):
        got = texts.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n * n, dtype=np.float64)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, rounds: int = 200) -> np.ndarray:
    """The class of each unit, once none moves; ``rounds`` only guards against an endless loop.  Unit 0, the end mark, keeps class 0 to itself."""
    n = len(bigrams)
    freq = bigrams.sum(1) + bigrams.sum(0)
    order = [u for u in np.argsort(-freq, kind="stable").tolist() if u]
    of = np.zeros(n, dtype=np.int64)
    for i, u in enumerate(order):
        of[u] = 1 + i % (classes - 1) if classes > 1 else 0
    one = np.zeros((n, classes))
    one[np.arange(n), of] = 1
    right, left = bigrams @ one, bigrams.T @ one  # unit by class after, unit by class before
    table = one.T @ bigrams @ one
    ids = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for u in order:
            if not freq[u]:
                continue
            c, self_n = of[u], bigrams[u, u]
            r, l = right[u].copy(), left[u].copy()
            r[c] -= self_n
            l[c] -= self_n
            table[c, :] -= r
            table[:, c] -= l
            table[c, c] -= self_n
            row, col = table.sum(1) + l, table.sum(0) + r  # what follows and precedes a class, this unit beside it
            gain = (_xlogx(table + r) - _xlogx(table)).sum(1) + (_xlogx(table.T + l) - _xlogx(table.T)).sum(1)
            d = np.diag(table)
            gain += _xlogx(d + r[ids] + l[ids] + self_n) - _xlogx(d + r[ids]) - _xlogx(d + l[ids]) + _xlogx(d)
            nr, nl = r.sum() + self_n, l.sum() + self_n
            gain -= _xlogx(row + nr) - _xlogx(row) + _xlogx(col + nl) - _xlogx(col)
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[c] + 1e-9:
                best = c
            table[best, :] += r
            table[:, best] += l
            table[best, best] += self_n
            if best != c:
                of[u], moved = best, moved + 1
                right[:, c] -= bigrams[:, u]
                right[:, best] += bigrams[:, u]
                left[:, c] -= bigrams[u, :]
                left[:, best] += bigrams[u, :]
        if not moved:
            break
    return of


def _contexts(texts: DataFrame, units: Units, direct: list[bytes], class_of: np.ndarray, classes: int, flush: int = 800_000) -> DataFrame:
    """Rows ``(word, cell, n)`` for all words beyond the exchanged ones: how often a class stands before one (its number), after it (``classes`` more), or two stand around it (all pairs, from twice ``classes`` on).

    Workers add up the words of ``direct`` in a table of fixed size and send one row for each
    word and task; the cells of other words go as they come.  Rows are dealt by word once, and
    all sums over a word are made where it went.
    """

    bits = (classes * (classes + 2)).bit_length()  # of a code: the cell; above it the count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k2 = 2 * classes
        # one look-up for each token: its unit, or for a word of ``direct`` the number of all units and its place
        number = {w: u for w, u in units.direct.items() if u < units.exchanged} | {w: units.size + i for i, w in enumerate(direct)}
        unit_at = np.concatenate([np.arange(units.size), units.coded(direct)])
        table = np.zeros(len(direct) * k2, dtype=np.int64)
        others: dict[bytes, list[int]] = {}
        held = 0

        def out(words: list[bytes], ends: np.ndarray, cells: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            codes = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(n.astype(np.int64) << bits | cells))
            return pa.RecordBatch.from_arrays([_words(words), codes], names=["word", "codes"])

        def rest() -> pa.RecordBatch:
            lists = list(others.values())
            cells = np.fromiter((x for one in lists for x in one), dtype=np.int64, count=held)
            made = out(list(others), np.append(0, np.cumsum([len(x) for x in lists])), cells, np.ones(held, np.int64))
            others.clear()
            return made

        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                got = tokens(text)
                code = _places(number, [END, *got, END], -1, np.int64)
                far = np.flatnonzero(code < 0)
                unheld = [got[k] for k in (far - 1).tolist()]
                code[far] = [units.exchanged + spelling_group(w, units.groups) for w in unheld]
                cls = class_of[unit_at[code]]
                near = np.flatnonzero(code >= units.size)
                where = (code[near] - units.size) * k2
                found += (where + cls[near - 1], where + classes + cls[near + 1])
                around = (k2 + cls[far - 1] * classes + cls[far + 1]).tolist()
                for w, cell in zip(unheld, around):
                    others.setdefault(w, []).append(cell)
                held += len(around)
            if found:
                table += np.bincount(np.concatenate(found), minlength=len(table))
            if held > flush:
                yield rest()
                held = 0
        if held:
            yield rest()
        by_word = table.reshape(-1, k2) if len(table) else np.zeros((0, k2), np.int64)
        for lo in range(0, len(direct), 4096):
            part = by_word[lo : lo + 4096]
            row, cell = np.nonzero(part)
            if len(row):
                yield out(direct[lo : lo + 4096], np.append(0, np.cumsum((part > 0).sum(1))), cell, part[row, cell])

    rows = texts.select("text").mapInArrow(run, "word string, codes array<long>")
    cells = rows.repartition("word").select("word", F.explode("codes").alias("code"))
    cells = cells.select("word", F.col("code").bitwiseAND((1 << bits) - 1).cast("int").alias("cell"), F.shiftright("code", bits).alias("n"))
    return cells.groupBy("word", "cell").agg(F.sum("n").alias("n"))


def _placed(contexts: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """Rows ``(word, c, cls)``: each word's count and the class that makes its contexts most likely; ``before[c, k]`` and ``after[c, k]`` are log shares of class k beside class c."""
    classes = len(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("l")
            sizes = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            flat = lists.flatten()
            cell, n = flat.field("cell").to_numpy().astype(np.int64), flat.field("n").to_numpy().astype(np.float64)
            pair = cell >= 2 * classes
            around = cell - 2 * classes
            beside = np.zeros((len(sizes), 2 * classes))
            np.add.at(beside, (owner[~pair], cell[~pair]), n[~pair])
            np.add.at(beside, (owner[pair], around[pair] // classes), n[pair])
            np.add.at(beside, (owner[pair], classes + around[pair] % classes), n[pair])
            left, right = beside[:, :classes], beside[:, classes:]
            best = 1 + np.argmax((left @ before.T + right @ after.T)[:, 1:], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(left.sum(1).astype(np.int64)), pa.array(best.astype(np.int32))], names=["word", "c", "cls"])

    # at most classes * (classes + 2) cells a word
    return contexts.groupBy("word").agg(F.collect_list(F.struct("cell", "n")).alias("l")).mapInArrow(run, "word string, c long, cls int")


@dataclass
class Vocabulary:
    """What workers hold of the classes: the most frequent words; ``rest`` has all others in a table ``(word, c, cls)``."""

    place: dict[bytes, int]
    counts: np.ndarray
    class_of: np.ndarray
    classes: int  # without the unknown one, whose number is this
    discount: float
    n: int
    v: int
    mass: np.ndarray  # what is left of each class's counts after discounting


def learned(training: DataFrame, classes: int = 48, exchanged: int = 1000, groups: int = 128, direct: int = 40_000) -> tuple[Vocabulary, DataFrame]:
    """The classes of all training words: those that workers hold, and the table of all words beyond the exchanged ones.

    ``exchanged`` words are clustered one by one, ``groups`` are the first guess for the
    others, ``direct`` words at most are held by each worker; none of these bounds the
    vocabulary, whose every word gets a class by what stands beside it.
    """
    if not exchanged <= direct < _OTHER:
        raise ValueError(f"direct must lie between exchanged and {_OTHER - 1}")
    end = END.decode()
    counts = staged(word_counts(training), "classlm-counts", FEW)
    about = counts.where(F.col("word") != end).agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).first()
    ends = counts.where(F.col("word") == end).agg(F.sum("c")).first()[0] or 0
    n1, n2 = about["n1"], about["n2"]
    discount = min(0.9, max(0.1, n1 / (n1 + 2 * n2) if n1 else 0.5))
    top = counts.where(F.col("word") != end).orderBy(F.desc("c"), "word").limit(direct).collect()
    frequent = [r["word"].encode() for r in top[exchanged - 1 :]]
    numbers = {END: 0} | {r["word"].encode(): i + 1 for i, r in enumerate(top[: exchanged - 1])}
    units = Units(exchanged, groups, numbers | {w: exchanged + spelling_group(w, groups) for w in frequent})
    bigrams = unit_bigrams(training, units)
    of = exchange(bigrams, classes)
    one = np.zeros((units.size, classes))
    one[np.arange(units.size), of] = 1
    table = one.T @ bigrams @ one
    share = (table.sum(0) + 1) / (table.sum() + classes)
    beside = lambda t: np.log((t + share) / (t.sum(1, keepdims=True) + 1))
    rest = staged(_placed(_contexts(training, units, frequent, of, classes), beside(table.T), beside(table)), "classlm-classes", FEW, "zstd")
    dropped(counts)
    held = [(r["word"].encode(), r["c"]) for r in top]
    class_of = np.zeros(len(held) + 1, dtype=np.int64)
    class_of[1:exchanged] = of[1 : min(exchanged, len(held) + 1)]
    place = {END: 0} | {w: i + 1 for i, (w, _) in enumerate(held)}
    if len(held) >= exchanged:
        asked = training.sparkSession.createDataFrame([(w.decode(), i + 1) for i, (w, _) in enumerate(held) if i + 1 >= exchanged], "word string, at int")  # at most ``direct`` rows
        for r in rest.join(F.broadcast(asked), "word").select("at", "cls").collect():
            class_of[r["at"]] = r["cls"]
    known = np.array([ends, *(c for _, c in held)], dtype=np.int64)
    mass = np.bincount(class_of[:exchanged], weights=np.append(known[:1], known[1:exchanged] - discount), minlength=classes)
    for r in rest.groupBy("cls").agg(F.sum(F.col("c") - F.lit(discount)).alias("m")).collect():
        mass[r["cls"]] += r["m"]
    return Vocabulary(place, known, class_of, classes, discount, int(ends + (about["n"] or 0)), int((1 if ends else 0) + about["v"]), mass), rest


_TAIL = "array<struct<word:string,at:int>>"


def _sequences(texts: DataFrame, held: Vocabulary) -> DataFrame:
    """Per document its tokens as places among the held words (or that of any other word), and the other words with their positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner_type = pa.struct([("word", pa.string()), ("at", pa.int32())])
        for batch in batches:
            n, seq, words, at, ends = [], [], [], [], [0]
            for text in batch.column(1).to_pylist():
                got = tokens(text)
                got.append(END)
                place = _places(held.place, got, _OTHER, np.uint16)
                other = np.flatnonzero(place == _OTHER)
                words += [got[k] for k in other.tolist()]
                at.append(other.astype(np.int32))
                ends.append(len(words))
                n.append(len(got))
                seq.append(place.tobytes())
            if n:
                inner = pa.StructArray.from_arrays([_words(words), pa.array(np.concatenate(at))], fields=list(inner_type))
                made = [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(seq, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner)]
                yield pa.RecordBatch.from_arrays(made, names=["doc_id", "learns", "n_tokens", "seq", "tail"])

    return texts.mapInArrow(run, f"doc_id long, learns boolean, n_tokens long, seq binary, tail {_TAIL}")


def _resolved(batch: pa.RecordBatch, held: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Class and count of each token of each document; an unknown word has count 0 and the unknown class."""
    class_of, counts = (np.append(x, np.full(_OTHER + 1 - len(x), y)) for x, y in ((held.class_of, held.classes), (held.counts, 0)))
    lists = batch.column("known")
    ends, none = lists.offsets.to_numpy(), lists.is_null().to_numpy(zero_copy_only=False)
    at, count, cls_of = (lists.values.field(x).to_numpy() for x in ("at", "c", "cls"))
    for k, seq in enumerate(batch.column("seq").to_pylist()):
        place = np.frombuffer(seq, dtype=np.uint16)
        cls, c = class_of[place], counts[place]
        if not none[k]:
            i, j = ends[k], ends[k + 1]
            cls[at[i:j]], c[at[i:j]] = cls_of[i:j], count[i:j]
        yield cls, c


def _class_bigrams(rows: DataFrame, held: Vocabulary) -> np.ndarray:
    """How often classes follow each other in training, the unknown class among them."""
    k = held.classes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k)
        for batch in batches:
            for cls, c in _resolved(batch, held):
                cls, lost = np.append(0, cls), np.append(0.0, np.where(cls == 0, 0.0, held.discount / np.maximum(c, 1)))
                for a, wa in ((cls, 1 - lost), (np.full(len(cls), k - 1), lost)):
                    for b, wb in ((cls, 1 - lost), (np.full(len(cls), k - 1), lost)):
                        total += np.bincount(a[:-1] * k + b[1:], weights=wa[:-1] * wb[1:], minlength=k * k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k), pa.int32()), pa.array(total)], names=["cell", "n"])

    out = np.zeros(k * k)
    for r in rows.where("learns").select("seq", "known").mapInArrow(run, "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out.reshape(k, k)


def document_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", prior: float = 10.0, **model: int) -> DataFrame:
    """Rows ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one for each row of ``docs``.

    Learns from the rows where ``held_out``, a condition on ``doc_id``, is not true (null
    included).  A null or blank text is the end mark alone.  Repeated rows stay and count
    twice in training.  Without any training text, counts are zero and the scores those of
    the smoothing alone.  An empty input gives an empty result.
    """
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    learns = ~F.coalesce(held_out, F.lit(False))
    held, rest = learned(texts.where(learns), **model)
    parts = staged(_sequences(texts.select("doc_id", "text", learns.alias("learns")), held).withColumn("row", F.monotonically_increasing_id()), "classlm-parts", FEW, "zstd")
    # dealt by row first: lists of one element made before a shuffle would only be longer
    tail = parts.select("row", F.inline("tail")).join(rest, "word").select("row", "at", "c", "cls").repartition("row").groupBy("row").agg(F.collect_list(F.struct("at", "c", "cls")).alias("known"))
    whole = staged(parts.drop("tail").join(tail, "row", "left").drop("row"), "classlm-sequences", codec="zstd")
    dropped(parts, rest)
    with settings(spark, values={"spark.sql.execution.arrow.maxRecordsPerBatch": str(FEW)}):
        bigrams = _class_bigrams(whole, held)
    share = (bigrams.sum(0) + 1) / (bigrams.sum() + len(bigrams))
    transition = np.log10((bigrams + prior * share) / (bigrams.sum(1, keepdims=True) + prior))
    mass = np.append(held.mass, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = math.log10(held.n + held.v + 1)
        with np.errstate(divide="ignore"):
            of_class = np.log10(np.maximum(mass, 1e-300))
        for batch in batches:
            known, base, score = [], [], []
            for cls, c in _resolved(batch, held):
                seen = c > 0
                lost = np.where(cls == 0, 0.0, held.discount)
                emission = np.log10(np.where(seen, c - lost, 1.0)) - np.where(seen, of_class[cls], 0.0)
                known.append(int(seen.sum()))
                base.append(float(np.log10(c + 1.0).sum() - len(c) * total))
                score.append(float(transition[np.append(0, cls[:-1]), cls].sum() + emission.sum()))
            made = [batch.column("doc_id"), batch.column("n_tokens"), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    out = whole.select("doc_id", "n_tokens", "seq", "known").mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(held.n).cast("long").alias("train_tokens"), "base_score", "score")
