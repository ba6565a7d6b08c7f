"""The corpus pipeline: documents pass the stages in order, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from conceptmerge.llm import contamination, nearcopies, packing, pii, quality, queries
from conceptmerge.llm.staging import dropped, staged, unused


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below 0.7 go.  It learns from all labels (at most the documented number)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit_quality(docs, labels)
    score, predicted = unused(docs, "score", "predicted")
    judged = quality.scored(docs, model, score=score, predicted=predicted)
    return judged.where(F.col(predicted) == 1).select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 0.8 or more of their five-word shingles stays: that of the smallest id.

    SimHash fingerprints find the close copies, MinHash fingerprints the rest; shingles decide.
    """
    return nearcopies.near_copies_removed(docs, width=5, least=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths or more of a benchmark item go."""
    return contamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in every text; the number of characters follows."""
    out = pii.replaced(docs, queries.PII_KEY)
    return out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is tokenised and packed into sequences of at most 2048 tokens."""
    return packing.packed(docs, queries.tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("pii surrogates", pii_surrogates),
    ("packing", packed),
]

#: No SQL: SimHash, a fitted classifier and a tokenizer are beyond it; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last.  What a stage wrote goes once the next has read it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        dropped(before)
    return docs
