"""The three whole flows: consolidation, matching of a source, and term extraction from texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import providers, scalars as s
from ..operators import batching, checks, graph, merge, reconcile, retrieval, text
from ..sources import readers, writers




@dataclass
class Catalogue:
    """What a consolidation makes; all parts are lazy."""

    nodes: DataFrame
    edges: DataFrame
    dictionary: DataFrame
    counters: DataFrame
    repeated_labels: DataFrame
    repeated_accessions: DataFrame


def _terms(lines: DataFrame) -> DataFrame:
    raw = F.col("_raw")
    return lines.select(
        *[F.get_json_object(raw, f"$.{k}").alias(k) for k in schemas.MANDATORY_TERM_KEYS], s.scalar_or_list(raw, "$.metadata.gtc_id").alias("gtc_id"),
        F.get_json_object(raw, "$.metadata.gsd_id").alias("gsd_id"), "_source", "_source_rank", "_line", "_raw",
    )


def source_content(raw: Column) -> Column:
    """The record of a source as it stands in the dictionary: eleven keys that are always there, two that may be."""
    one = lambda k: F.get_json_object(raw, f"$.metadata.{k}")
    many = lambda k: s.flatten_json_list(F.coalesce(one(k), F.lit("[]")))
    filled = lambda c: F.when(F.size(c) > 0, c)
    lists = ("gtc_id", "exact_synonyms", "evidence", "publication", "db_xref")
    plain = ("gsd_id", "classification", "definition", "description", "iupac_condensed", "raw_term")
    return F.struct(*[one(k).alias(k) for k in plain], *[many(k).alias(k) for k in lists], *[filled(s.content_list(one(k))).alias(k) for k in ("function", "disease_association")])


def consolidated(spark: SparkSession, root: str, order: Sequence[str], compat: bool = False) -> Catalogue:
    """Reads the queue below ``root``, fails on records that break the rules, and merges."""
    term_files, edge_files = readers.processing_queue(spark, root, order)
    term_lines, edge_lines = readers.numbered_lines(spark, term_files), readers.numbered_lines(spark, edge_files)
    checks.require_clean(checks.term_violations(term_lines))
    terms = _terms(term_lines)
    nodes = merge.merge_concepts(terms, compat)
    edges = readers.read_jsonl(spark, edge_files, schemas.EDGE, readers.PERMISSIVE)
    merged = merge.merge_edges(edges, compat)
    records = terms.select("src_uuid", source_content(F.col("_raw")).alias("content"), "_source_rank", "_line")
    return Catalogue(
        nodes, merged, graph.assemble_dictionary(nodes, merged, records), merge.merge_counters(terms), checks.repeated_labels(nodes), checks.repeated_accessions(nodes)
    )


def write_catalogue(spark: SparkSession, made: Catalogue, folder: str, when: str | None = None) -> dict[str, str]:
    """Moves earlier documents to a backup and writes nodes, edges and the dictionary under names with a time stamp."""
    stamp = when or writers.stamp()
    writers.backed_up(spark, folder, when=stamp)
    paths = {k: f"{folder}/{k}{stamp}.json" for k in ("master_nodes", "master_edges", "dictionary")}
    edges = made.edges.select("subj", "pred", "obj", "comment", "_source_rank", "_line")
    ordered = made.dictionary.join(made.nodes.select("term_uuid", "_created"), "term_uuid")
    nodes, linked = (made.nodes, ["_created"]), (edges, ["_source_rank", "_line"])
    writers.write_ordered(spark, paths["master_nodes"], nodes)
    writers.write_ordered(spark, paths["master_edges"], linked)
    writers.write_ordered(spark, paths["dictionary"], '{"nodes":', (ordered, ["_created"]), ',"edges":', linked, "}", keep_nulls=True)
    return paths


def indexed(concepts: DataFrame, provider: Callable = providers.hashed_embedding) -> DataFrame:
    """Vector documents of concepts ``(id, term, synonyms, description)``."""
    docs = concepts.withColumn("page_content", s.document_text(F.col("term"), F.col("synonyms"), F.col("description"), F.col("id")))
    return providers.embedded(docs, "page_content", provider=provider)


def candidates(terms: DataFrame, store: DataFrame, k: int = 4, floor: float = 0.3, provider: Callable = providers.hashed_embedding) -> DataFrame:
    """The nearest concepts of each term ``(term)``: ``(term, id, score, rank)``."""
    asked = providers.embedded(terms.select("term").distinct(), "term", provider=provider)
    return retrieval.top_k(asked.withColumnRenamed("term", "query_id"), store, k, floor).withColumnRenamed("query_id", "term")


def matched(originals: DataFrame, concepts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decisions on the terms of a source ``(normalized_term)``, the rows with their concepts, and the store afterwards."""
    asked = originals.where(s.is_kept(F.col("normalized_term")) & (F.col("normalized_term") != "")).select(s.ustrip(F.col("normalized_term")).alias("term")).distinct()
    decided = retrieval.decide(asked, concepts, known_name="term", known_id="id")
    decisions = decided.select(F.col("term").alias("source_term"), "mapped_to_uuid", "action")
    rows = reconcile.require_reconciled(originals, decisions, F.lit(0))
    return decisions, rows.withColumn("term_uuid", s.ensure_prefix(F.col("term_uuid"), schemas.CONCEPT_PREFIX)), retrieval.upserted_store(concepts, decided)


def extracted(texts: DataFrame, names: tuple[str, ...], provider: Callable = providers.dictionary_entities) -> DataFrame:
    """Mentions in texts ``(document_id, text)`` that pass the filters, each with its sentence."""
    chunked = text.chunks(texts, "document_id").select(F.col("id").alias("chapter"), "chunk_id", "chunk", "at")
    hits = providers.entities(chunked, "chunk_id", "chunk", names, provider)
    kept = text.kept_mentions(hits).join(chunked, F.col("id") == F.col("chunk_id"))
    sentence = text.mention_sentence(F.col("chunk"), text.sentence_spans(F.col("chunk")), F.col("start_pos").cast("int"), F.col("end_pos").cast("int"))
    return kept.select("term", "start_pos", "end_pos", "similarity", sentence.alias("term_in_sentence"), F.struct("chapter", F.col("chunk_id").alias("uuid"), F.col("at").alias("source_line")).alias("metadata"))


def summarized(mentions: DataFrame, keep: Callable = providers.retain_by_length, normalize: Callable = providers.normalize_by_case, summarize: Callable = providers.summarize_first) -> DataFrame:
    """Mentions grouped by term, filtered and normalised in batches by the providers, and summarised by normalised term.

    ``(glycan_term, exact_synonyms, classification, description, original_terms, error)``;
    unreadable answers count as kept terms and as their own normal form, and as a summary
    without synonyms, of the tag ``Others``, described as ``ERROR``.  Terms are normalised in
    batches along one order over all of them.
    """
    grouped = text.mention_groups(mentions, "term", "term_in_sentence", F.col("metadata"), "start_pos")
    batches = batching.fixed_batches(grouped.select("original_term"), ["original_term"], 5).groupBy("batch").agg(F.array_sort(F.collect_list("original_term")).alias("terms"))

    def lines(answers: DataFrame, schema: str, fallback) -> DataFrame:
        split = answers.select(F.explode(F.split(s.unfenced(F.col("answer")), "\n")).alias("line")).where("line <> ''")
        return split.select(s.parsed_or(F.col("line"), schema, fallback).alias("r")).select("r.*")

    error = F.struct(F.col("line").alias("original_term"), F.lit("error").alias("decision"))
    verdicts = lines(providers.answered(batches, "terms", "answer", keep), "original_term string, decision string", error)
    held = grouped.join(verdicts.where("decision = 'remove'").select("original_term").distinct(), "original_term", "left_anti")
    again = batching.adaptive_batches(held.select("original_term"), None, ["original_term"], "original_term").groupBy("batch").agg(F.array_sort(F.collect_list("original_term")).alias("terms"))
    own = F.struct(F.col("line").alias("normalized_term"), F.array("line").alias("original_terms"))
    normal = lines(providers.answered(again, "terms", "answer", normalize), "normalized_term string, original_terms array<string>", own)
    named = normal.select("normalized_term", F.explode("original_terms").alias("original_term")).join(held, "original_term")
    rows = named.select("normalized_term", "original_term", F.array("original_term").alias("terms"), F.array_join("term_in_sentence", " ").alias("d"))
    runs = batching.summarized_runs(rows, ["normalized_term"], ["original_term"], "normalized_term", "terms", "d")
    answers = providers.answered(runs, ["normalized_term", "distinct_terms", "descriptions"], "answer", summarize)
    failed = F.struct(F.array().cast("array<string>").alias("exact_synonyms"), F.lit("Others").alias("classification"), F.lit("ERROR").alias("description"))
    parsed = answers.withColumn("r", s.parsed_or(F.col("answer"), "exact_synonyms array<string>, classification string, description string", failed))
    return parsed.select(F.col("normalized_term").alias("glycan_term"), "r.exact_synonyms", "r.classification", "r.description", F.col("nested").alias("original_terms"), F.col("answer_error").alias("error"))
