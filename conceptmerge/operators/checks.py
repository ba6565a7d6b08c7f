"""Checks of records before and after a merge; each gives its violations as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import missing_keys, ustrip
from ..schemas import CONCEPT_PREFIX, MANDATORY_EDGE_KEYS, MANDATORY_TERM_KEYS, SOURCE_PREFIX


class RecordsRejected(ValueError):
    """Raised by ``require_clean``; names the first violations."""


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their count ``n``."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def duplicated_rows(rows: DataFrame, *key: str) -> DataFrame:
    """The rows behind ``duplicate_keys``, each with ``n``."""
    return rows.join(duplicate_keys(rows, *key), list(key))


def prefix_violations(rows: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """A row ``(…, column, value)`` for each value without the prefix of its column."""
    found = F.filter(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), (~F.coalesce(F.col(c).startswith(p), F.lit(False))).alias("bad")) for c, p in prefixes.items()]),
        lambda x: x["bad"],
    )
    return rows.withColumn("_v", F.explode(found)).select(*rows.columns, "_v.column", "_v.value")


def key_violations(rows: DataFrame, raw: str, keys: Sequence[str]) -> DataFrame:
    """Rows whose JSON is malformed (``missing`` null) or lacks mandatory keys."""
    return rows.withColumn("missing", missing_keys(F.col(raw), keys)).where(F.col("missing").isNull() | (F.size("missing") > 0))


def _violation(rule: Column, value: Column) -> list[Column]:
    return [F.col("_source"), F.col("_line"), rule.alias("rule"), value.cast("string").alias("value")]


def term_violations(lines: DataFrame) -> DataFrame:
    """All violations of term lines (``_raw, _source, _line``): ``(_source, _line, rule, value)``.

    A blank line is malformed; ``term_uuid`` is unique within a file, ``src_uuid`` over all.
    """
    return _violations(lines, MANDATORY_TERM_KEYS, {"term_uuid": CONCEPT_PREFIX, "src_uuid": SOURCE_PREFIX}, {"term_uuid": ["_source"], "src_uuid": []})


def edge_violations(lines: DataFrame) -> DataFrame:
    return _violations(lines, MANDATORY_EDGE_KEYS, {"subj": CONCEPT_PREFIX, "obj": CONCEPT_PREFIX}, {})


def _violations(lines: DataFrame, keys: Sequence[str], prefixes: dict[str, str], unique: dict[str, list[str]]) -> DataFrame:
    parsed = lines.select("_source", "_line", "_raw", missing_keys(F.col("_raw"), keys).alias("_missing"), *[F.get_json_object("_raw", f"$.{k}").alias(k) for k in keys])
    bad = parsed.where(F.col("_missing").isNull()).select(*_violation(F.lit("malformed"), F.col("_raw")))
    lacking = parsed.where(F.size("_missing") > 0).select(*_violation(F.lit("missing key"), F.array_join("_missing", ",")))
    whole = parsed.where(F.size("_missing") == 0)
    prefix = prefix_violations(whole, prefixes).select(*_violation(F.concat(F.lit("prefix of "), F.col("column")), F.col("value")))
    out = bad.unionByName(lacking).unionByName(prefix)
    for column, scope in unique.items():
        twice = duplicated_rows(whole, *scope, column)
        out = out.unionByName(twice.select(*_violation(F.lit(f"repeated {column}"), F.col(column))))
    return out


def row_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("_source").agg(F.count("*").alias("n"))


def require_clean(violations: DataFrame, shown: int = 5) -> None:
    """Raises with the first violations, if there are any."""
    first = violations.orderBy("_source", "_line", "rule").limit(shown).collect()
    if first:
        raise RecordsRejected("; ".join(f"{r['_source']}:{r['_line']}: {r['rule']} ({r['value']})" for r in first))


def repeated_labels(nodes: DataFrame) -> DataFrame:
    """Stripped labels of more than one node, with the nodes' ids and, if ``nodes`` has ``sources``, each node's ``src_uuid`` list beside its id."""
    label = ustrip(F.coalesce(F.col("lbl"), F.lit("")))
    held = nodes.withColumn("lbl", label).where("lbl <> ''")
    sources = [F.array_sort(F.collect_list(F.struct("term_uuid", F.col("sources.src_uuid").alias("src_uuids")))).alias("sources")] if "sources" in nodes.columns else []
    return held.groupBy("lbl").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("term_uuid")).alias("term_uuids"), *sources).where("n > 1")


def repeated_accessions(nodes: DataFrame) -> DataFrame:
    """Accessions of more than one node, with the ids of the nodes' sources."""
    held = nodes.where("gsd_id <> ''")
    return held.groupBy("gsd_id").agg(F.count("*").alias("n"), F.array_sort(F.flatten(F.collect_list("sources.src_uuid"))).alias("src_uuids")).where("n > 1")
