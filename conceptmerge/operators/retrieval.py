"""Thresholded top-k retrieval by cosine, and the decision whether a term is known."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import document_text, stable_id, with_synonym
from ..sources.scratch import fresh_path, removed, written
from .batching import numbered
from .nearest import DIGITS, ROWS, nearest, unit_rows


def cosine(a: Column, b: Column) -> Column:
    """In double precision; null for a zero vector."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, norm(a) * norm(b))


def top_k(queries: DataFrame, store: DataFrame, k: int, floor: float = 0.3, query_id: str = "query_id", store_id: str = "id", vector: str = "embedding", store_rows_a_block: int = 4096) -> DataFrame:
    """Rows ``(query_id, id, score, rank)``: the k nearest stored vectors of each query, ties by id.

    Scores are cosines in double precision, to twelve digits.  Blocks of queries meet blocks
    of the store in matrix products; see ``nearest``.
    """
    none = F.lit(0).cast("long").alias("at")
    asked = queries.select(F.col(query_id).alias("id"), none, F.col(vector).alias("v"))
    stored = store.select(F.col(store_id).alias("id"), none, F.col(vector).alias("v"))
    return nearest(asked, stored, k, floor, rows_a_block=store_rows_a_block)


def decide_in_order(terms: DataFrame, id_col: str, order: list[str], vector: str = "embedding", floor: float = 0.3, prefix: int = 4096) -> DataFrame:
    """Order-dependent decisions on a table of any size: ``(id, action, concept_id, score)``.

    Terms take their turn along ``order`` (ties by id).  A term maps to the nearest concept
    founded before it, if one lies within the floor, else it founds a concept of its own;
    the founders are the first independent set of the order.  They are found in rounds: the
    first ``prefix`` terms that are still open depend on each other alone and are decided one
    by one, on the driver, which never holds more; then all open terms near the new founders
    close, in one pass without a shuffle.  A round's founders are sent to the tasks: at most
    ``prefix`` vectors.  What maps finds its nearest founder by ``nearest``.

    A vector without a direction (null, zero, not finite) founds a concept that nothing maps
    to.  Ids are distinct.
    """
    spark = terms.sparkSession
    kind = dict(terms.dtypes)[id_col]
    plain = terms.select(F.col(id_col).alias("id"), F.struct(*order).alias("o"), F.col(vector).cast("array<double>").alias("v"))
    every = written(numbered(plain, ["o", "id"], "at").select("id", "at", "v"), "in-order")
    pending, used = every, [every]
    founders = None
    while True:
        first = pending.orderBy("at").limit(prefix).toArrow()
        if not first.num_rows:
            break
        rows, _, parts = unit_rows(first.column("v"))
        at = first.column("at").to_numpy()
        groups, begun = [], np.zeros(first.num_rows, dtype=bool)
        begun[np.setdiff1d(np.arange(first.num_rows), rows)] = True
        seen = 0
        for m in parts:
            mine = rows[seen : seen + len(m)]
            seen += len(m)
            turn = np.argsort(at[mine])
            mine, m = mine[turn], m[turn]
            open_, chosen = np.ones(len(m), dtype=bool), []
            for i in range(len(m)):
                if open_[i]:
                    chosen.append(i)
                    open_[i:] &= np.round(m[i:] @ m[i], DIGITS) < floor
            begun[mine[chosen]] = True
            groups.append(m[chosen])
        new = spark.createDataFrame(first.select(["id", "at", "v"]).filter(pa.array(begun)))
        new.select(F.col("id").cast(kind).alias("id"), "at", "v").write.mode("append").parquet(founders := founders or fresh_path(spark, "founders"))
        sent = spark.sparkContext.broadcast(groups)
        last = int(at.max())

        def still_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                rows, dims, parts = unit_rows(batch.column("v"))
                for m in parts:
                    here = rows[dims == m.shape[1]]
                    for f in sent.value:
                        if len(f) and f.shape[1] == m.shape[1]:
                            for lo in range(0, len(m), ROWS):
                                keep[here[lo : lo + ROWS]] &= np.round(m[lo : lo + ROWS] @ f.T, DIGITS).max(axis=1) < floor
                yield batch.filter(pa.array(keep))

        pending = written(pending.where(F.col("at") > last).mapInArrow(still_open, pending.schema), "in-order-open")
        used.append(pending)
    if founders is None:
        return every.select("id", F.lit("add").alias("action"), F.col("id").alias("concept_id"), F.lit(0.0).alias("score"))
    held = spark.read.parquet(founders)
    rest = every.join(held.select("id"), "id", "left_anti")
    near = nearest(rest, held, 1, floor, earlier=True).select(F.col("query_id").alias("id"), F.lit("map").alias("action"), F.col("id").alias("concept_id"), "score")
    out = written(near.unionByName(held.select("id", F.lit("add").alias("action"), F.col("id").alias("concept_id"), F.lit(None).cast("double").alias("score"))), "in-order-decisions")
    for df in used:
        removed(df)
    removed(held)
    return out


def decide(terms: DataFrame, known: DataFrame, term: str = "term", known_name: str = "name", known_id: str = "id") -> DataFrame:
    """``terms`` with ``action`` (map or add) and ``mapped_to_uuid``: a literal match in lower case maps, else a new id is added.

    This is the deterministic stand-in for a model that decides; of several matches the
    least id counts.
    """
    names = known.groupBy(F.lower(known_name).alias("_n")).agg(F.min(known_id).alias("_id"))
    found = terms.join(names, F.lower(term) == F.col("_n"), "left")
    action = F.when(F.col("_id").isNotNull(), F.lit("map")).otherwise(F.lit("add"))
    return found.select(*terms.columns, action.alias("action"), F.coalesce(F.col("_id").cast("string"), stable_id(F.col(term))).alias("mapped_to_uuid"))


def decide_one_by_one(terms: Iterable[tuple[str, str]], known: dict[str, str], provider: Callable[[str, dict[str, str]], str | None] | None = None) -> list[tuple[str, str, str]]:
    """Sequential decisions in which a term added at one step is known at the next: ``(term, uuid, action)``.

    ``provider(term, known)`` names the concept to map to, or None to add one; without it a
    literal match in lower case maps.  Each step depends on all before it, so this runs on
    the driver, for interactive lists; ``decide`` works on a snapshot of any size.
    """
    out = []
    for term, new_id in terms:
        held = known.get(term.lower()) if provider is None else provider(term, known)
        action = "add" if held is None else "map"
        held = new_id if held is None else held
        known.setdefault(term.lower(), held)
        out.append((term, held, action))
    return out


class MutableStore:
    """An order-dependent vector store on the driver: what is added or changed at one step is found at the next.

    Holds ``(term, synonyms, vector)`` by id, for interactive lists; ``top_k`` and
    ``upserted_store`` are the operations on tables.
    """

    def __init__(self, embed: Callable[[str], list[float]], entries: Iterable[tuple[str, str]] = ()):
        self.embed, self.held = embed, {}
        for uuid, term in entries:
            self.add(uuid, term)

    def _put(self, uuid: str, term: str, synonyms: list[str]) -> None:
        v = np.asarray(self.embed("\n".join([term, *synonyms])), dtype=float)
        self.held[uuid] = (term, synonyms, v / (np.linalg.norm(v) or 1.0))

    def add(self, uuid: str, term: str) -> None:
        self._put(uuid, term, [])

    def map(self, uuid: str, term: str) -> None:
        """The term becomes a synonym, unless it is one already, and the entry is embedded anew."""
        name, synonyms, _ = self.held[uuid]
        if term != name and term not in synonyms:
            self._put(uuid, name, [*synonyms, term])

    def search(self, term: str, k: int = 4, floor: float = 0.3) -> list[tuple[str, float]]:
        v = np.asarray(self.embed(term), dtype=float)
        v = v / (np.linalg.norm(v) or 1.0)
        scored = sorted(((uuid, float(v @ x)) for uuid, (_, _, x) in self.held.items()), key=lambda p: (-p[1], p[0]))
        return [(u, s) for u, s in scored[:k] if s >= floor]


def decide_in_turn(terms: Iterable[tuple[str, str]], store: MutableStore, provider: Callable[[str, list[tuple[str, float]]], str | None], k: int = 4, floor: float = 0.3) -> list[tuple[str, str, str]]:
    """The full loop: retrieve, let the provider choose a retrieved id or None, then map or add in the store; ``(term, uuid, action)``."""
    out = []
    for term, new_id in terms:
        chosen = provider(term, store.search(term, k, floor))
        if chosen is None:
            store.add(new_id, term)
            out.append((term, new_id, "add"))
        else:
            store.map(chosen, term)
            out.append((term, chosen, "map"))
    return out


def upserted_store(store: DataFrame, decisions: DataFrame) -> DataFrame:
    """The store after decisions ``(term, mapped_to_uuid, action)``: new concepts added, mapped terms appended to the synonyms.

    ``store`` has ``(id, term, synonyms, description)``.
    """
    mapped = decisions.where("action = 'map'").groupBy(F.col("mapped_to_uuid").alias("id")).agg(F.array_sort(F.collect_set("term")).alias("_more"))
    none = F.array().cast("array<string>")
    joined = store.join(mapped, "id", "left")
    synonyms = F.aggregate(F.coalesce("_more", none), F.coalesce("synonyms", none), with_synonym)
    old = joined.select("id", "term", synonyms.alias("synonyms"), "description")
    new = decisions.where("action = 'add'").groupBy(F.col("mapped_to_uuid").alias("id")).agg(F.min("term").alias("term")).join(store.select("id"), "id", "left_anti")
    out = old.unionByName(new.select("id", "term", none.alias("synonyms"), F.lit("").alias("description")))
    return out.withColumn("page_content", document_text(F.col("term"), F.col("synonyms"), F.col("description"), F.col("id").cast("string")))
