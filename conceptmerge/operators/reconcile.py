"""Reconciliation of source records with mapping decisions, complete in both directions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import ustrip
from ..schemas import DISCARD
from .merge import last_wins


class ReconcileFailed(ValueError):
    """Records without a decision, or decisions without a record; carries the matched rows."""

    def __init__(self, message: str, partial: DataFrame):
        super().__init__(message)
        self.partial = partial


def _prepared(originals: DataFrame, term: str) -> DataFrame:
    return originals.withColumn("_key", ustrip(F.coalesce(F.col(term), F.lit("")))).where("_key <> ''")


def reconciled(originals: DataFrame, decisions: DataFrame, order: Column, term: str = "normalized_term", source_term: str = "source_term", uuid: str = "mapped_to_uuid") -> DataFrame:
    """``originals`` with ``term_uuid`` and ``_status``: matched, unmatched or discarded; rows without a term go."""
    known = last_wins(decisions, source_term, uuid, order).select(F.col(source_term).alias("_key"), F.col(uuid).alias("_uuid"))
    rows = _prepared(originals, term).join(known, "_key", "left")
    gone = F.col("_key") == DISCARD
    status = F.when(gone, "discarded").when(F.col("_uuid").isNotNull(), "matched").otherwise("unmatched")
    return rows.select(*originals.columns, F.when(~gone, F.col("_uuid")).alias("term_uuid"), status.alias("_status"))


def unmatched_originals(originals: DataFrame, decisions: DataFrame, order: Column, term: str = "normalized_term", source_term: str = "source_term", uuid: str = "mapped_to_uuid") -> DataFrame:
    """Distinct terms that no decision covers."""
    known = last_wins(decisions, source_term, uuid, order).select(F.col(source_term).alias("_key"))
    return _prepared(originals, term).where(F.col("_key") != DISCARD).join(known, "_key", "left_anti").select(F.col("_key").alias("term")).distinct()


def unmatched_decisions(originals: DataFrame, decisions: DataFrame, order: Column, term: str = "normalized_term", source_term: str = "source_term", uuid: str = "mapped_to_uuid") -> DataFrame:
    """Decided terms that no record has."""
    known = last_wins(decisions, source_term, uuid, order).select(F.col(source_term).alias("_key"))
    return known.join(_prepared(originals, term).select("_key"), "_key", "left_anti").select(F.col("_key").alias("term"))


def reconcile_summary(originals: DataFrame, decisions: DataFrame, order: Column, **names: str) -> DataFrame:
    """One row of counts: total, discarded, active, matched, and unmatched both ways."""
    done = reconciled(originals, decisions, order, **names)
    status = lambda *kinds: F.col("_status").isin(*kinds).cast("long")
    left = done.select(
        F.lit(1).alias("total"), status("discarded").alias("discarded"), status("matched", "unmatched").alias("active"), status("matched").alias("matched"),
        status("unmatched").alias("unmatched_originals"), F.lit(0).alias("unmatched_decisions"),
    )
    zero = [F.lit(0).alias(c) for c in left.columns[:-1]]
    both = left.unionByName(unmatched_decisions(originals, decisions, order, **names).select(*zero, F.lit(1).alias("unmatched_decisions")))
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in left.columns])


def require_reconciled(originals: DataFrame, decisions: DataFrame, order: Column, **names: str) -> DataFrame:
    """The matched and discarded rows, or ``ReconcileFailed`` naming the first terms without a partner."""
    done = reconciled(originals, decisions, order, **names)
    left = [r["term"] for r in unmatched_originals(originals, decisions, order, **names).orderBy("term").limit(5).collect()]
    right = [r["term"] for r in unmatched_decisions(originals, decisions, order, **names).orderBy("term").limit(5).collect()]
    if left or right:
        raise ReconcileFailed(f"records without a decision: {left}; decisions without a record: {right}", done)
    return done.drop("_status")


def match_sample(rows: DataFrame, order: list[str], n: int = 3, uuid: str = "term_uuid") -> DataFrame:
    """Of the first ``n`` rows along the order those that were matched: a report to look at."""
    return rows.orderBy(*order).limit(n).where(F.col(uuid).isNotNull())
