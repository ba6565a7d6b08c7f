"""Sentences, mentions and chunks of running text."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import stable_id, ustrip
from .batching import running_totals

SEPARATORS = ("\n\n", "\n", ". ", ", ", " ")

# What names no structure, found anywhere in a term and in any letter case ...
EXCLUDED_ANY_CASE = (
    r"\bMUC\d+\b",
    r"\bgalectin-?\d*\b",
    r"\blectins?\b",
    r"\bintegrins?\b",
    r"\balbumin\b",
    r"\btransferrin\b",
    r"\b(?:IgG|IgA|IgM)\b",
    r"\bantibod(?:y|ies)\b",
    r"\banti[-–\s]?glycans?\b",
    r"\b[a-zA-Zβ-]*transferases?\b",
    r"\b[a-zA-Zβ-]*glycosidas(?:e|es)\b",
    r"\bhexosaminidas(?:e|es)\b",
    r"\bmannosidas(?:e|es)\b",
    r"\b(?:GlycA|M2BPGi)\b",
    r"\bGP\d{1,3}\b",
    r"\b(?:UDP|GDP|CMP)-[A-Za-z0-9]+(?:Kdn|Xyl|Fuc|Man|Gal|Glc|GlcA|GlcNAc|GalNAc|Neu5Ac|Neu5Gc)?\b",
    r"\b(?:multivalent|vertebrate|bacterial|plant|fungal|nonreducing|cell surface|synthetic)(?:[-\w]*)\b",
    r"\b(?:[-\w]*?)linkage\b",
)
# ... or in this letter case.
EXCLUDED_AS_WRITTEN = (r"\b[αβ][1-9]-[1-9]\b", r"\b[αβ][1-9]→[1-9]\b", r"\bC[1-9]{2}:[1-9]\b")
# Whole terms, in lower case, that are too general.
STOP_TERMS = (
    "glycan", "glycans", "carbohydrate", "carbohydrates", "monosaccharide", "monosaccharides", "disaccharide", "disaccharides", "trisaccharide", "trisaccharides",
    "oligosaccharide", "oligosaccharides", "polysaccharide", "polysaccharides", "glycosylation", "glycosylations", "glycoform", "glycoforms", "glycoconjugate", "glycoconjugates",
    "glycoprotein", "glycoproteins", "glycosidic bond", "glycosidic bonds", "glycolipid", "glycolipids", "glycan structure", "glycan structures", "glycan motif", "glycan motifs",
    "glycan epitope", "glycan epitopes", "n-glycan", "n-glycans", "n-linked glycan", "n-linked glycans", "n-glycan structure", "n-glycan structures",
    "o-glycan", "o-glycans", "o-linked glycan", "o-linked glycans", "o-glycan structure", "o-glycan structures", "gag", "gags", "glycosaminoglycan", "glycosaminoglycans",
    "proteoglycan", "proteoglycans", "peptidoglycan", "peptidoglycans", "gt", "gts", "gh", "ghs", "sialidase", "sialidases", "neuraminidase", "neuraminidases",
    "ogt", "ogts", "oga", "ogas", "dol-p-man", "mannac-6-p",
)
_BREAK = re.compile(r"(?<=\.)\s+")


def _spans(text: str, out: array) -> None:
    """Appends start and end of each sentence."""
    start = 0
    for gap in _BREAK.finditer(text):
        out.extend((start, gap.start() + 1))
        start = gap.end()
    if start < len(text):
        out.extend((start, len(text)))


def _int_lists(texts: pa.Array, found: Callable[[str, array], None], width: int) -> tuple[pa.Array, np.ndarray]:
    """The ends of each text's list and all members, ``width`` numbers each; a null text has a null list.

    One text at a time becomes a Python string, and its numbers go into one flat array of four bytes each.
    """
    flat, ends = array("i"), np.zeros(len(texts) + 1, dtype=np.int32)
    for i, text in enumerate(texts):
        if text.is_valid:
            found(text.as_py(), flat)
        ends[i + 1] = len(flat) // width
    mask = np.append(texts.is_null().to_numpy(zero_copy_only=False), False)
    return pa.array(ends, pa.int32(), mask=mask), np.frombuffer(flat, dtype=np.int32)


def _span_lists(texts: pa.Array) -> pa.Array:
    ends, flat = _int_lists(texts, _spans, 2)
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(flat[::2]), pa.array(flat[1::2])], names=["s", "e"]))


def sentence_spans(text: Column) -> Column:
    """``array<struct<s, e>>`` of half-open character spans; a sentence ends after a full stop and the first blank behind it.

    One pass over each text in Arrow batches, without a Python object for a span: running
    offsets as array expressions would copy the list at every sentence.
    """
    return F.arrow_udf(_span_lists, "array<struct<s:int,e:int>>")(text)


def sentences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A row ``(…, at, sentence)`` for each sentence, in order, stripped; linear in the text."""
    split = F.split(F.col(text_col), r"(?<=\.)\s+")
    rest = [c for c in docs.columns if c != text_col]
    return docs.select(*rest, F.posexplode(split).alias("at", "sentence")).where("sentence <> ''")


def mention_sentence(text: Column, spans: Column, start: Column, end: Column, around: int = 120) -> Column:
    """The first sentence that overlaps the mention, stripped; without one the surrounding characters."""
    hit = F.get(F.filter(spans, lambda p: (p["s"] < end) & (p["e"] > start)), 0)
    low = F.greatest(start - around, F.lit(0))
    near = F.substring(text, low + 1, end + around - low)
    return ustrip(F.when(hit.isNotNull(), F.substring(text, hit["s"] + 1, hit["e"] - hit["s"])).otherwise(near))


def occurrences(docs: DataFrame, id_col: str, text_col: str, literal: str) -> DataFrame:
    """Rows ``(id, start_pos, end_pos)``: all places of the literal in whole texts, from left to right without overlaps, in characters."""
    pattern, n = re.compile(re.escape(literal)), len(literal)

    def starts(text: str, out: array) -> None:
        out.extend(m.start() for m in pattern.finditer(text))

    def places(texts: pa.Array) -> pa.Array:
        ends, flat = _int_lists(texts, starts, 1)
        return pa.ListArray.from_arrays(ends, pa.array(flat))

    found = docs.where(F.contains(F.col(text_col), F.lit(literal))).select(F.col(id_col).alias("id"), F.explode(F.arrow_udf(places, "array<int>")(F.col(text_col))).alias("start_pos"))
    return found.withColumn("end_pos", F.col("start_pos") + n)


def first_overlaps(mentions: DataFrame, spans: DataFrame, id_col: str = "id", start: str = "start_pos", end: str = "end_pos", width: int = 2048) -> DataFrame:
    """``mentions`` with ``s`` and ``e`` of the first span of ``spans (id, s, e)`` of the same document that they overlap, null without one.

    A join of ranges: both sides are put into bins of ``width`` places, so rows meet by
    document and bin, and a document with any number of mentions is spread over its bins.
    What meets in several bins is one match again in the minimum that picks the first.
    """
    def bins(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / width), F.floor(F.greatest(high - 1, low) / width)))

    key = [F.col(id_col).alias("_id"), F.col(start).alias("_a"), F.col(end).alias("_b")]
    sound = F.col("_id").isNotNull() & (F.col("_a") <= F.col("_b"))
    asked = mentions.select(*key).distinct().where(sound).withColumn("_bin", bins(F.col("_a"), F.col("_b")))
    held = spans.select(F.col("id").alias("_id"), "s", "e").where("s < e").withColumn("_bin", bins(F.col("s"), F.col("e")))
    met = asked.join(held, ["_id", "_bin"]).where((F.col("s") < F.col("_b")) & (F.col("e") > F.col("_a")))
    first = met.groupBy("_id", "_a", "_b").agg(F.min(F.struct("s", "e")).alias("_first"))
    same = (F.col(id_col) == F.col("_id")) & (F.col(start) == F.col("_a")) & (F.col(end) == F.col("_b"))
    return mentions.join(first, same, "left").select(*mentions.columns, F.col("_first.s").alias("s"), F.col("_first.e").alias("e"))


def is_excluded(term: Column) -> Column:
    """Whether a term holds anything of the excluded families."""
    any_case, as_written = "|".join(EXCLUDED_ANY_CASE), "|".join(EXCLUDED_AS_WRITTEN)
    return term.rlike(f"(?iuU)(?:{any_case})") | term.rlike(f"(?U)(?:{as_written})")


def kept_mentions(mentions: DataFrame, term: str = "term", start: str = "start_pos", end: str = "end_pos", least: int = 3) -> DataFrame:
    """Mentions with sound spans whose term is long enough, not generic and of no excluded family; the term is stripped.

    The tests are one condition on term and span, cheap ones first, so a plan that has
    aggregated mentions by term keeps them above that aggregate.
    """
    t = ustrip(F.coalesce(F.col(term), F.lit("")))
    s, e = F.try_to_number(F.col(start).cast("string"), F.lit("S999999999999")), F.try_to_number(F.col(end).cast("string"), F.lit("S999999999999"))
    sound = F.coalesce((s >= 0) & (e > s), F.lit(False))
    kept = F.when(sound & (F.length(t) >= least) & ~F.lower(t).isin(*STOP_TERMS), ~is_excluded(t)).otherwise(F.lit(False))
    return mentions.where(kept).withColumn(term, t)


def first_filled(*values: Column, default: Column | None = None) -> Column:
    """The first value that is neither null nor empty, as ``uuid`` else ``id``; ``default`` if there is none."""
    return F.coalesce(*[F.nullif(v.cast("string"), F.lit("")) for v in values], *([] if default is None else [default]))


def score_of(raw: Column) -> Column:
    """A mention's score out of its JSON: ``score``, else ``confidence`` where the key is absent, else 0."""
    keys = F.json_object_keys(raw)
    value = F.when(F.array_contains(keys, "score"), F.get_json_object(raw, "$.score")).when(F.array_contains(keys, "confidence"), F.get_json_object(raw, "$.confidence")).otherwise(F.lit("0"))
    return value.cast("double")


def progress(chunks: DataFrame, order: list[str | Column], hits: str, every: int = 10) -> DataFrame:
    """Rows ``(processed, hits)`` after each ``every`` chunks along the order, and after the last: how many were seen, and their mentions."""
    counted = running_totals(chunks.select(*order, F.coalesce(F.col(hits), F.lit(0)).cast("long").alias("_hits")), order, "_hits")
    last = counted.agg(F.max("line").alias("_last"))
    return counted.join(F.broadcast(last), (F.col("line") % every == 0) | (F.col("line") == F.col("_last"))).select(F.col("line").alias("processed"), F.col("total").alias("hits"))


def chunk_text(text: str, size: int = 1000, overlap: int = 200) -> list[str]:
    """Chunks of at most ``size`` characters that overlap by at most ``overlap``.

    A chunk ends behind the last separator of the highest rank in it; the next starts behind
    the first separator within the overlap, or at the overlap itself.
    """
    out, start = [], 0
    while start < len(text):
        end = start + size
        if end >= len(text):
            out.append(text[start:])
            break
        for sep in SEPARATORS:
            at = text.rfind(sep, start + size // 2, end)
            if at >= 0:
                end = at + len(sep)
                break
        out.append(text[start:end])
        low = max(start + 1, end - overlap)
        found = [at + len(sep) for sep in SEPARATORS if 0 <= (at := text.find(sep, low, end)) and at + len(sep) < end]
        start = found[0] if found else low
    return out


def chunks(docs: DataFrame, id_col: str, text_col: str = "text", size: int = 1000, overlap: int = 200) -> DataFrame:
    """Rows ``(id, at, chunk, chunk_id)`` in order; a document is chunked by one call, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, at, chunk) for i, text in zip(pdf["id"], pdf["text"]) if text for at, chunk in enumerate(chunk_text(text, size, overlap))]
            yield pd.DataFrame(rows, columns=["id", "at", "chunk"])

    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, at int, chunk string")
    return out.withColumn("chunk_id", stable_id(F.col("id").cast("string"), F.col("at").cast("string")))


def chunk_preview(chunked: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` chunks, by document and place: a report to look at."""
    return chunked.orderBy("id", "at").limit(n)


def mention_groups(mentions: DataFrame, term: str, sentence: str, about: Column, order: str) -> DataFrame:
    """Rows ``(original_term, term_in_sentence, metadata)``: all mentions of a term, in order."""
    one = F.struct(F.col(order).alias("o"), F.col(sentence).alias("s"), about.alias("m"))
    listed = mentions.groupBy(F.col(term).alias("original_term")).agg(F.array_sort(F.collect_list(one)).alias("l"))
    return listed.select("original_term", F.transform("l", lambda x: x["s"]).alias("term_in_sentence"), F.transform("l", lambda x: x["m"]).alias("metadata"))


def zipped(a: Column, b: Column) -> Column:
    """Pairs by position, as many as the shorter list has."""
    n = F.least(F.size(a), F.size(b))
    return F.arrays_zip(F.slice(a, 1, n).alias("a"), F.slice(b, 1, n).alias("b"))
