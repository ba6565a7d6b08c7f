"""Ordered multi-source merges of concepts and edges.

Precedence is data: rows carry ``_source_rank`` (place of their file in the queue) and
``_line``.  One aggregation replaces reading and rewriting a master once for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions.scalars import is_kept, ustrip
from ..schemas import DISCARD



def usable_terms(terms: DataFrame) -> DataFrame:
    """Rows with stripped keys; those without a concept or marked as discarded go."""
    keys = ("term", "xref", "term_uuid", "src_uuid")
    out = terms.withColumns({k: ustrip(F.coalesce(F.col(k), F.lit(""))) for k in keys})
    return out.where((F.col("term_uuid") != "") & is_kept(F.col("term")))


_STATE = ("ord", "source", "lbl", "lbl_ord", "gsd", "gsd_ord", "lists", "n")


def concept_states(terms: DataFrame) -> DataFrame:
    """What is to be known of the rows of each ``(term_uuid, src_uuid)``; states of more rows fold into one."""
    ids = F.filter(F.coalesce("gtc_id", F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    order = F.struct("_source_rank", "_line")
    rows = usable_terms(terms).select("term_uuid", "term", "xref", "src_uuid", ids.alias("ids"), F.nullif("gsd_id", F.lit("")).alias("gsd"), order.alias("ord"))
    source = F.struct(F.col("term").alias("src_lbl"), F.col("xref").alias("src"), "src_uuid")
    # a row is the state of itself
    return folded_states(rows.select(
        "term_uuid", "src_uuid", "ord", source.alias("source"), F.nullif("term", F.lit("")).alias("lbl"), F.when(F.col("term") != "", F.col("ord")).alias("lbl_ord"),
        "gsd", F.when(F.col("gsd").isNotNull(), F.col("ord")).alias("gsd_ord"), F.array(F.struct("ord", F.lit(0).alias("pos"), "ids")).alias("lists"), F.lit(1).cast("long").alias("n"),
    ))


def folded_states(states: DataFrame) -> DataFrame:
    """One state for each ``(term_uuid, src_uuid)``, of all its states in whatever order they came.

    Its lists are the ids of the first row as they are, then each further id by the place where
    it came first.  Places are least by ``(term_uuid, src_uuid, id)`` before a state gathers
    them, so what is held is as many ids as there are different ones, however often they come.
    """
    key = ["term_uuid", "src_uuid"]
    facts = [F.min_by("source", "ord").alias("source"), F.min_by("lbl", "lbl_ord").alias("lbl"), F.max_by("gsd", "gsd_ord").alias("gsd"), F.min("first").alias("first"),
             F.min("ord").alias("ord"), F.min("lbl_ord").alias("lbl_ord"), F.max("gsd_ord").alias("gsd_ord"), F.sum("n").alias("n")]
    places = F.flatten(F.transform("lists", lambda x: F.transform(x["ids"], lambda i, k: F.struct(x["ord"].alias("ord"), (x["pos"] + k).alias("pos"), i.alias("id")))))
    each = states.select(*key, *[c for c in _STATE if c != "lists"], F.get("lists", 0).alias("first"), F.posexplode_outer(places).alias("at", "place"))
    once = F.coalesce("at", F.lit(0)) == 0  # a state counts with the first of its ids
    each = each.withColumns({c: F.when(once, F.col(c)) for c in ("ord", "lbl_ord", "gsd_ord", "first", "n")})
    by_id = each.groupBy(*key, F.col("place.id").alias("id")).agg(F.min(F.struct("place.ord", "place.pos")).alias("seen"), *facts)
    further = F.when(F.col("id").isNotNull(), F.struct("seen.ord", "seen.pos", F.array("id").alias("ids")))
    folded = by_id.groupBy(*key).agg(F.collect_list(further).alias("further"), *facts)
    new = F.filter("further", lambda x: (x["ord"] > F.col("ord")) | ~F.array_contains(F.col("first.ids"), F.get(x["ids"], 0)))
    return folded.withColumn("lists", F.concat(F.array("first"), F.array_sort(new))).select(*key, *_STATE)


def concepts_of(states: DataFrame, compat: bool = False) -> DataFrame:
    """The nodes of ``merge_concepts`` from states."""
    whole = states.groupBy("term_uuid").agg(
        F.min("ord").alias("_created"), F.min_by("lbl", "lbl_ord").alias("lbl"), F.max_by("gsd", "gsd_ord").alias("gsd"), F.max("gsd_ord").alias("gsd_ord"),
        F.array_sort(F.flatten(F.collect_list("lists"))).alias("lists"), F.array_sort(F.collect_list(F.struct("ord", "source"))).alias("sources"), F.sum("n").alias("n"),
    )
    creator = F.get(F.col("lists"), 0)["ids"]
    rest = F.flatten(F.transform(F.slice("lists", 2, F.greatest(F.size("lists") - 1, F.lit(0))), lambda x: x["ids"]))
    later = F.when(F.col("gsd_ord") > F.col("_created"), F.col("gsd"))
    gsd = F.when(F.col("n") > 1, F.coalesce(later, F.lit(""))) if compat else F.col("gsd")
    return whole.select(
        F.coalesce("lbl", F.lit("")).alias("lbl"), "term_uuid", F.concat(creator, F.array_except(rest, creator)).alias("gtc_id"), gsd.alias("gsd_id"),
        F.transform("sources", lambda s: s["source"]).alias("sources"), "_created",
    )


def merge_concepts(terms: DataFrame, compat: bool = False) -> DataFrame:
    """One node for each ``term_uuid``: ``(lbl, term_uuid, gtc_id, gsd_id, sources, _created)``.

    The label is the first non-empty term.  Ids come in order: the creator's as they are,
    later ones when new.  ``gsd_id`` is the last non-empty one; in compatible mode the
    creator's own is lost, and nodes seen once have none (null: the key is absent) while
    nodes updated without one have ``""``.  Sources are unique by ``src_uuid``, first come
    first.  A node holds all its sources, so a group is as large as its output row.
    """
    return concepts_of(concept_states(terms), compat)


class MergeCounts:
    """Counters of a merge, taken while its rows pass; there once an action over the nodes has ended."""

    def __init__(self, sources: int, rows: Observation, nodes: Observation):
        self.sources, self.rows, self.nodes = sources, rows, nodes

    def get(self) -> list[tuple[int, int, int, int]]:
        """``(source rank, skipped, created, updated)`` of each source."""
        rows, nodes = self.rows.get, self.nodes.get
        made = [(r, rows[f"skipped_{r}"], nodes[f"created_{r}"], rows[f"used_{r}"] - nodes[f"created_{r}"]) for r in range(self.sources)]
        return [x for x in made if x[1] or x[2] or x[3]]


def merge_observed(terms: DataFrame, sources: int, compat: bool = False) -> tuple[DataFrame, MergeCounts]:
    """``merge_concepts`` and its counters in one pass over the rows of ``sources`` ranks.

    What is skipped is counted where it is dropped, and a source has created the nodes whose
    first row is its own.  A stage that runs again after a loss may count its rows again:
    ``merge_counters`` is the exact count, for a second scan.
    """
    rank = F.col("_source_rank")
    uuid, term = (ustrip(F.coalesce(F.col(k), F.lit(""))) for k in ("term_uuid", "term"))
    used = (uuid != "") & is_kept(term)
    seen, made = Observation(), Observation()
    counted = [F.count_if(~used & (rank == r)).alias(f"skipped_{r}") for r in range(sources)] + [F.count_if(used & (rank == r)).alias(f"used_{r}") for r in range(sources)]
    nodes = merge_concepts(terms.observe(seen, *counted), compat)
    created = [F.count_if(F.col("_created._source_rank") == r).alias(f"created_{r}") for r in range(sources)]
    return nodes.observe(made, *created), MergeCounts(sources, seen, made)


def merge_counters(terms: DataFrame) -> DataFrame:
    """For each source: rows skipped, concepts created, rows that updated one."""
    keys = ("term", "term_uuid")
    rows = terms.withColumns({k: ustrip(F.coalesce(F.col(k), F.lit(""))) for k in keys})
    used = (F.col("term_uuid") != "") & is_kept(F.col("term"))
    first = F.row_number().over(Window.partitionBy("term_uuid", used).orderBy("_source_rank", "_line")) == 1
    return (
        rows.select("_source_rank", used.alias("used"), first.alias("first")).groupBy("_source_rank")
        .agg(F.count_if(~F.col("used")).alias("skipped"), F.count_if(F.col("used") & F.col("first")).alias("created"), F.count_if(F.col("used") & ~F.col("first")).alias("updated"))
    )


def merge_edges(edges: DataFrame, compat: bool = False, key: tuple[str, ...] = ("subj", "pred", "obj")) -> DataFrame:
    """Edges in order of precedence without repeats, and without those whose comment marks them as discarded.

    In compatible mode an edge is a repeat only of earlier sources, so repeats within the
    source that has it first survive; else only its first row stays.
    """
    rows = edges.withColumns({k: ustrip(F.coalesce(F.col(k), F.lit(""))) for k in (*key, "comment")}).where(F.col("comment") != DISCARD)
    if compat:
        # the least rank is combined before its shuffle and joined back, so a much repeated edge is no hot window
        least = rows.groupBy(*key).agg(F.min("_source_rank").alias("_source_rank"))
        return rows.join(least, [*key, "_source_rank"], "left_semi")
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct("_source_rank", "_line")).alias("x"))
    return best.select(*key, "x.*")


def last_wins(rows: DataFrame, key: str, value: str, order: Column, strip: bool = True) -> DataFrame:
    """The last non-empty value of each non-empty key: ``(key, value)``."""
    clean = ustrip if strip else (lambda c: c)
    k, v = clean(F.coalesce(F.col(key), F.lit(""))), clean(F.coalesce(F.col(value), F.lit("")))
    return rows.select(k.alias(key), v.alias(value), order.alias("_o")).where((F.col(key) != "") & (F.col(value) != "")).groupBy(key).agg(F.max_by(value, "_o").alias(value))


def union_by_precedence(*sources: DataFrame) -> DataFrame:
    """All rows, each with the place of its source."""
    out = None
    for rank, df in enumerate(sources):
        df = df.withColumn("_source_rank", F.lit(rank))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
