"""Related-term graph and the assembled dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import ustrip
from ..schemas import PLACEHOLDER, RELATED


def symmetric_adjacency(edges: DataFrame, nodes: DataFrame, predicate: str = RELATED, order: tuple[str, ...] = ("_source_rank", "_line")) -> DataFrame:
    """Rows ``(term_uuid, related)``: labels of neighbours both ways, first met first.

    Only edges of the predicate whose two ends are nodes with a label count; an edge to
    itself gives its own label once.
    """
    labels = nodes.where("lbl <> ''").select("term_uuid", "lbl")
    own, other = labels.select(F.col("term_uuid").alias("subj"), F.col("lbl").alias("subj_lbl")), labels.select(F.col("term_uuid").alias("obj"), F.col("lbl").alias("obj_lbl"))
    held = edges.where(F.col("pred") == predicate).join(own, "subj").join(other, "obj")
    there = held.select(F.col("subj").alias("term_uuid"), F.col("obj_lbl").alias("lbl"), F.struct(*order, F.lit(0).alias("way")).alias("o"))
    back = held.select(F.col("obj").alias("term_uuid"), F.col("subj_lbl").alias("lbl"), F.struct(*order, F.lit(1).alias("way")).alias("o"))
    first = there.unionByName(back).groupBy("term_uuid", "lbl").agg(F.min("o").alias("o"))
    return first.groupBy("term_uuid").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "lbl"))), lambda x: x["lbl"]).alias("related"))


def related_edges(terms: DataFrame, related: str = "related", term: str = "term", uuid: str = "term_uuid", order: str = "_line") -> DataFrame:
    """An edge from the concept of each named related term; unknown ones get a placeholder."""
    known = terms.groupBy(F.col(term).alias("_name")).agg(F.max_by(uuid, order).alias("_uuid"))
    asked = terms.where(F.col(related).isNotNull())
    found = asked.join(known, asked[related] == F.col("_name"), "left")
    comment = F.format_string("%s is a related synonym of %s", F.col(related), F.col(term))
    return found.select(F.coalesce("_uuid", F.lit(PLACEHOLDER)).alias("subj"), F.lit(RELATED).alias("pred"), F.col(uuid).alias("obj"), comment.alias("comment"), F.col(order).alias("_line"))


def first_match(rows: DataFrame, lookup: DataFrame, key: str, order: str | list[str], lookup_key: str | None = None) -> DataFrame:
    """``rows`` with the fields of the first matching ``lookup`` row as struct ``matched``; null without one."""
    order = [order] if isinstance(order, str) else order
    lookup_key = lookup_key or key
    rest = [c for c in lookup.columns if c != lookup_key]
    first = lookup.groupBy(F.col(lookup_key).alias(key)).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("matched"))
    return rows.join(first, key, "left")


def assemble_dictionary(nodes: DataFrame, edges: DataFrame, terms: DataFrame) -> DataFrame:
    """One row for each node: ``(term_uuid, lbl, sources)``; every source has the record it came from as ``src_content``.

    ``terms`` has ``(src_uuid, content struct, _source_rank, _line)``; of several records of a
    source the first in the queue counts.  Related terms are part of the content.
    """
    each = nodes.select("term_uuid", "lbl", F.posexplode("sources").alias("at", "s")).select("term_uuid", "lbl", "at", "s.*")
    found = first_match(each, terms.select("src_uuid", "content", "_source_rank", "_line"), "src_uuid", ["_source_rank", "_line"])
    near = found.join(symmetric_adjacency(edges, nodes), "term_uuid", "left")
    content = F.struct(F.coalesce("related", F.array().cast("array<string>")).alias("related_synonyms"), F.col("matched.content").alias("record"))
    source = F.struct("src_lbl", "src", "src_uuid", content.alias("src_content"))
    listed = near.groupBy("term_uuid", "lbl").agg(F.array_sort(F.collect_list(F.struct("at", source.alias("s")))).alias("l"))
    return listed.select("term_uuid", "lbl", F.transform("l", lambda x: x["s"]).alias("sources"))


def stripped_edges(edges: DataFrame) -> DataFrame:
    """Edges as the master keeps them: without the cross-reference."""
    return edges.select(*[ustrip(F.col(c)).alias(c) for c in ("subj", "pred", "obj")], "comment")
