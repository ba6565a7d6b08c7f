"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .alignment import alignments
from .classlm import document_scores
from .contamination import contaminated
from .neighbours import linked_vectors
from .packing import packed
from .pii import replaced
from .preferences import preference_examples, turn_lists, with_curtailed_answer
from .quality import fit_quality, scored
from .repeats import passages_removed
from .sharding import sharded
from .simhash import simhash_components
from .survivorship import Field, golden_records
from .warc import capture_histories

#: The key of the registered query; a deployment passes its own secret.
PII_KEY = "a key for tests"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = fit_quality(docs, _table(spark, sf_dir, "labels"), ~held_out)
    return scored(docs.select("doc_id", "text", held_out.alias("held_out")), model).select("doc_id", "held_out", "score", "predicted")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_examples(with_curtailed_answer(turn_lists(_table(spark, sf_dir, "conversations"))))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages_removed(_table(spark, sf_dir, "documents")).drop("kept_text")


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return document_scores(_table(spark, sf_dir, "documents"), held_out)


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = replaced(docs, PII_KEY, entities_col="entities")
    return out.select("doc_id", "text", F.size("entities").alias("n_entities"), "entities")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(_table(spark, sf_dir, "embeddings"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = capture_histories(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"), tokenizer_path())


#: The shop's sources by falling trust, and how each field of its golden record is chosen.
CLIENT_SOURCES = ("crm", "web", "store", "partner")
CLIENT_FIELDS = (
    Field("name", ("name",), "longest"), Field("email", ("email",), "trusted"), Field("segment", ("segment",), "recent"),
    Field("balance", ("balance",), "within", of="segment"), Field("address", ("city", "nation_id"), "fullest"),
)


def op11_golden_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = golden_records(_table(spark, sf_dir, "clients"), CLIENT_FIELDS, CLIENT_SOURCES)
    return found.withColumn("balance", F.floor(F.col("balance") * 100 + 0.5).cast("long")).withColumnRenamed("balance", "balance_cents")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``bytes``: sizes near equal; equal texts, null and empty ones among them, stay together."""
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    docs = docs.select("doc_id", "text", (F.octet_length("text") + 16).cast("long").alias("size"), F.crc32("text").alias("text_crc32"))
    found = sharded(docs, 40, F.col("size"), F.col("text"), carried=["doc_id", "size", "text_crc32"])
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(_table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_warc_index": op5_warc_index,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_packing": op7_packing,
    "op8_preference_format": op8_preference_format,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_class_lm": op10_class_lm,
    "op11_golden_records": op11_golden_records,
    "op12_sharding": op12_sharding,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op5_warc_index": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
        FROM f""",
    "op6_benchmark_decontamination": """
        WITH w AS (
            SELECT 'd' AS side, doc_id AS id, text FROM documents
            UNION ALL SELECT 'i', item_id, text FROM benchmark),
        words AS (
            SELECT side, id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM w),
        shingles AS (
            SELECT DISTINCT side, id, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)::BIGINT), lambda i: array_to_string(ws[i : i + 4], ' '))) AS s
            FROM words WHERE len(ws) > 0),
        sizes AS (SELECT id, count(*) AS n_shingles FROM shingles WHERE side = 'i' GROUP BY id),
        shared AS (
            SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
            FROM shingles d JOIN shingles i ON d.s = i.s AND d.side = 'd' AND i.side = 'i' GROUP BY ALL)
        SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
        FROM shared JOIN sizes ON sizes.id = item_id WHERE n_shared * 5 >= n_shingles * 4""",
    "op8_preference_format": """
        WITH t AS (
            SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations),
        l AS (SELECT *, max(i) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS last FROM t),
        b AS (SELECT *, CASE WHEN i = last THEN split_part(text, '. ', 1) ELSE text END AS other FROM l),
        n AS (SELECT *, coalesce(min(i) FILTER (other <> text) OVER (PARTITION BY conv_id) - 1, count(*) OVER (PARTITION BY conv_id)) AS k FROM b),
        r AS (
            SELECT *, '<|im_start|>' || replace(role, '<|', '< |') || chr(10) AS head,
                   replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body, replace(other, '<|', '< |') || '<|im_end|>' || chr(10) AS short FROM n),
        m AS (
            SELECT *, CASE WHEN role = 'assistant' THEN length(head) || ':0,' || length(body) || ':1' ELSE length(head || body) || ':0' END AS mb,
                   CASE WHEN role = 'assistant' THEN length(head) || ':0,' || length(short) || ':1' ELSE length(head || short) || ':0' END AS ms FROM r)
        SELECT conv_id, max(k)::INTEGER AS n_prompt_turns,
               coalesce(string_agg(head || body, '' ORDER BY i) FILTER (i <= k), '') AS prompt,
               coalesce(string_agg(head || body, '' ORDER BY i) FILTER (i > k), '') AS chosen,
               coalesce(string_agg(head || short, '' ORDER BY i) FILTER (i > k), '') AS rejected,
               coalesce(string_agg(mb, ',' ORDER BY i) FILTER (i > k), '') AS chosen_mask,
               coalesce(string_agg(ms, ',' ORDER BY i) FILTER (i > k), '') AS rejected_mask
        FROM m GROUP BY conv_id""",
    "op11_golden_records": """
        WITH r AS (
            SELECT coalesce(master_id, client_id) AS cluster_id, client_id, updated_at, nation_id,
                   CASE source WHEN 'crm' THEN 0 WHEN 'web' THEN 1 WHEN 'store' THEN 2 WHEN 'partner' THEN 3 ELSE 4 END AS rank,
                   CASE WHEN regexp_full_match(name, '[\x20\x09-\x0D]*') THEN NULL ELSE name END AS name,
                   CASE WHEN regexp_full_match(email, '[\x20\x09-\x0D]*') THEN NULL ELSE email END AS email,
                   CASE WHEN regexp_full_match(city, '[\x20\x09-\x0D]*') THEN NULL ELSE city END AS city,
                   CASE WHEN regexp_full_match(segment, '[\x20\x09-\x0D]*') THEN NULL ELSE segment END AS segment,
                   CASE WHEN isfinite(balance) THEN balance END AS balance
            FROM clients),
        s AS (
            SELECT *, updated_at IS NULL OR updated_at < max(updated_at) OVER (PARTITION BY cluster_id) - INTERVAL 1440 HOUR AS stale,
                   first_value(segment IGNORE NULLS) OVER (
                       PARTITION BY cluster_id ORDER BY updated_at DESC NULLS LAST, rank, client_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS chosen
            FROM r),
        o AS (
            SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY updated_at DESC NULLS LAST, rank, client_id) AS recent,
                   row_number() OVER (PARTITION BY cluster_id ORDER BY stale, rank, updated_at DESC NULLS LAST, client_id) AS trusted,
                   row_number() OVER (PARTITION BY cluster_id ORDER BY length(name) DESC NULLS LAST, stale, rank, updated_at DESC NULLS LAST, client_id) AS longest,
                   row_number() OVER (
                       PARTITION BY cluster_id ORDER BY segment IS DISTINCT FROM chosen, updated_at DESC NULLS LAST, rank, client_id) AS inside,
                   row_number() OVER (
                       PARTITION BY cluster_id ORDER BY (city IS NULL)::INT + (nation_id IS NULL)::INT, stale, rank, updated_at DESC NULLS LAST, client_id) AS fullest
            FROM s)
        SELECT cluster_id, count(*) AS n_records, count(*) FILTER (stale) AS n_stale,
               arg_min(name, longest) AS name, arg_min(email, trusted) FILTER (email IS NOT NULL) AS email,
               arg_min(segment, recent) FILTER (segment IS NOT NULL) AS segment, max(city) FILTER (fullest = 1) AS city, max(nation_id) FILTER (fullest = 1) AS nation_id,
               floor(100 * (arg_min(balance, inside) FILTER (balance IS NOT NULL)) + 0.5)::BIGINT AS balance_cents,
               arg_min(client_id, longest) FILTER (name IS NOT NULL) AS name_from, arg_min(client_id, trusted) FILTER (email IS NOT NULL) AS email_from,
               arg_min(client_id, recent) FILTER (segment IS NOT NULL) AS segment_from, arg_min(client_id, inside) FILTER (balance IS NOT NULL) AS balance_from,
               max(client_id) FILTER (fullest = 1 AND (city IS NOT NULL OR nation_id IS NOT NULL)) AS address_from
        FROM o GROUP BY cluster_id""",
}
