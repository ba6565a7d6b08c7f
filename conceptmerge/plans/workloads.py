"""Registered queries of the core engine with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import providers, scalars as s
from ..operators import batching, checks, graph, merge, reconcile, retrieval, text
from ..schemas import RELATED
from ..sources import readers, writers
from ..sources.scratch import fresh_path
from ..streaming import buckets, upsert

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL counterpart."""
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(c: str, sep: str = "|"):
    return F.array_join(c, sep)


# --- merges ---------------------------------------------------------------------------------

def _part_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "part").select(
        F.col("p_name").alias("term_uuid"), F.col("p_type").alias("term"), F.col("p_brand").alias("xref"), F.col("p_brand").alias("src_uuid"),
        F.array("p_type").alias("gtc_id"), F.col("p_size").cast("string").alias("gsd_id"), (F.col("p_size") % 3).alias("_source_rank"), F.col("p_partkey").alias("_line"),
    )


_MERGED = """
    WITH t AS ({rows}),
    o AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY r, l) AS i FROM t),
    ids AS (SELECT u, string_agg(g, '|' ORDER BY i) AS gtc_id FROM (SELECT u, g, min(i) AS i FROM o WHERE g <> '' GROUP BY u, g) GROUP BY u),
    src AS (SELECT u, string_agg(s, '|' ORDER BY i) AS sources, count(*) AS n_sources FROM (SELECT u, s, min(i) AS i FROM o GROUP BY u, s) GROUP BY u),
    n AS (SELECT u, arg_min(term, i) AS lbl, {gsd} AS gsd_id FROM o GROUP BY u)
    SELECT n.u AS term_uuid, lbl, coalesce(gtc_id, '') AS gtc_id, gsd_id, sources, n_sources
    FROM n JOIN src USING (u) LEFT JOIN ids USING (u)"""


def _flat_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.select("term_uuid", "lbl", _joined("gtc_id").alias("gtc_id"), "gsd_id", F.array_join("sources.src_uuid", "|").alias("sources"), F.size("sources").cast("long").alias("n_sources"))


@query(_MERGED.format(rows="SELECT p_name AS u, p_type AS term, p_type AS g, p_brand AS s, p_size::VARCHAR AS d, p_size % 3 AS r, p_partkey AS l FROM part",
                      gsd="CASE WHEN count(*) > 1 THEN coalesce(arg_max(d, i) FILTER (i > 1), '') END"))
def merge_ordered_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_nodes(merge.merge_concepts(_part_terms(spark, sf_dir), compat=True))


@query(_MERGED.format(rows="""SELECT s_nationkey::VARCHAR AS u, s_name AS term, '' AS g, 'supplier' AS s, s_name AS d, 0 AS r, s_suppkey AS l FROM supplier
        UNION ALL SELECT c_nationkey::VARCHAR, c_name, '', c_mktsegment, c_name, 1, c_custkey FROM customer""", gsd="arg_max(d, i)"))
def merge_multi_source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    def terms(df, key, name, source, order):
        return df.select(F.col(key).cast("string").alias("term_uuid"), F.col(name).alias("term"), source.alias("xref"), source.alias("src_uuid"), F.array().cast("array<string>").alias("gtc_id"), F.col(name).alias("gsd_id"), F.col(order).alias("_line"))

    both = merge.union_by_precedence(
        terms(_t(spark, sf_dir, "supplier"), "s_nationkey", "s_name", F.lit("supplier"), "s_suppkey"), terms(_t(spark, sf_dir, "customer"), "c_nationkey", "c_name", F.col("c_mktsegment"), "c_custkey")
    )
    return _flat_nodes(merge.merge_concepts(both))


@query("""
    WITH t AS (SELECT p_size % 3 AS r, p_partkey AS l, p_name AS u, p_size % 10 <> 0 AS used FROM part),
    o AS (SELECT *, row_number() OVER (PARTITION BY u, used ORDER BY r, l) = 1 AS first FROM t)
    SELECT r AS source_rank, count(*) FILTER (NOT used) AS skipped, count(*) FILTER (used AND first) AS created, count(*) FILTER (used AND NOT first) AS updated FROM o GROUP BY r""")
def merge_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "part").select(
        F.when(F.col("p_size") % 10 == 0, "[DISCARD]").otherwise(F.col("p_type")).alias("term"), F.col("p_name").alias("term_uuid"), (F.col("p_size") % 3).alias("_source_rank"), F.col("p_partkey").alias("_line")
    )
    return merge.merge_counters(rows).withColumnRenamed("_source_rank", "source_rank")


@query(ORACLES["merge_counters"])
def merge_counters_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of the merge from its own pass, whose nodes are written meanwhile."""
    rows = _t(spark, sf_dir, "part").select(
        F.when(F.col("p_size") % 10 == 0, "[DISCARD]").otherwise(F.col("p_type")).alias("term"), F.col("p_name").alias("term_uuid"), F.col("p_brand").alias("xref"), F.col("p_brand").alias("src_uuid"),
        F.array("p_type").alias("gtc_id"), F.col("p_size").cast("string").alias("gsd_id"), (F.col("p_size") % 3).alias("_source_rank"), F.col("p_partkey").alias("_line"),
    )
    nodes, counts = merge.merge_observed(rows, 3)
    nodes.write.parquet(fresh_path(spark, "nodes"))
    return spark.createDataFrame(counts.get(), "source_rank int, skipped long, created long, updated long")


def _item_edges(spark: SparkSession, sf_dir: str, labelled: bool = False) -> DataFrame:
    rank = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    p, q = ("P", "S") if labelled else ("", "")
    return _t(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(p), F.col("l_partkey").cast("string")).alias("subj"), F.lit(RELATED).alias("pred"), F.concat(F.lit(q), F.col("l_suppkey").cast("string")).alias("obj"),
        F.col("l_linestatus").alias("comment"), rank.alias("_source_rank"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_line"),
    )


_EDGES = """
    SELECT l_partkey::VARCHAR AS subj, 'has_related_synonym' AS pred, l_suppkey::VARCHAR AS obj, l_linestatus AS comment,
           CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS source_rank, l_orderkey * 10 + l_linenumber AS line FROM lineitem"""


@query(f"SELECT * FROM ({_EDGES}) QUALIFY source_rank = min(source_rank) OVER (PARTITION BY subj, pred, obj)")
def edges_dedupe_prior_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_edges(_item_edges(spark, sf_dir), compat=True).select("subj", "pred", "obj", "comment", F.col("_source_rank").alias("source_rank"), F.col("_line").alias("line"))


@query(f"SELECT subj, pred, obj, min(source_rank) AS source_rank FROM ({_EDGES}) GROUP BY subj, pred, obj")
def edges_dedupe_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_edges(_item_edges(spark, sf_dir)).select("subj", "pred", "obj", F.col("_source_rank").alias("source_rank"))


@query("SELECT o_custkey::VARCHAR AS customer, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY o_custkey")
def last_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("customer"), F.col("o_orderstatus").alias("status"), "o_orderdate", "o_orderkey")
    return merge.last_wins(orders, "customer", "status", F.struct("o_orderdate", "o_orderkey"))


@query("SELECT client_id, arg_max(city, change_id) AS city, max(change_id) AS change_id, count(*) AS n_changes FROM client_changes WHERE city IS NOT NULL AND client_id IS NOT NULL GROUP BY client_id")
def append_log_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes appended to a log in four batches, each of them twice as after a failure; the last of each client counts, and no row counts twice."""
    changes = _t(spark, sf_dir, "client_changes").where("city is not null and client_id is not null").select("change_id", "client_id", "city")
    folder = fresh_path(spark, "log")
    for batch in (2, 0, 3, 1):
        rows = changes.where(F.col("change_id") % 4 == batch)
        writers.append_batch(rows, folder, batch)
        writers.append_batch(rows, folder, batch)
    log = writers.read_log(spark, folder, changes.schema)
    return log.groupBy("client_id").agg(F.max_by("city", "change_id").alias("city"), F.max("change_id").alias("change_id"), F.count("*").alias("n_changes"))


@query("SELECT 0 AS source_rank, s_nationkey AS nation, count(*) AS n FROM supplier GROUP BY ALL UNION ALL SELECT 1, c_nationkey, count(*) FROM customer GROUP BY ALL")
def union_by_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = merge.union_by_precedence(_t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")), _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")))
    return both.groupBy(F.col("_source_rank").alias("source_rank"), "nation").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderstatus")
    return orders.where("o_orderstatus = 'F'").select("custkey").subtract(orders.where("o_orderstatus = 'O'").select("custkey"))


_COMMENTED = "CASE WHEN l_linenumber % 5 = 0 THEN '[DISCARD]' WHEN l_linenumber % 3 = 0 THEN ' seen ' ELSE l_linestatus END"


@query(f"""
    WITH e AS (SELECT trim(' ' || l_partkey || ' ') AS subj, l_suppkey::VARCHAR AS obj, trim({_COMMENTED}) AS comment,
               CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS r, l_orderkey * 10 + l_linenumber AS l FROM lineitem),
    k AS (SELECT * FROM e WHERE comment <> '[DISCARD]')
    SELECT subj, 'has_related_synonym' AS pred, obj, arg_min(comment, (r, l)) AS comment FROM k GROUP BY subj, obj""")
def edges_discarded_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges whose comment discards them go before repeats are looked for, so a later edge takes the place of a discarded first."""
    rank = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    edges = _t(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" ")).alias("subj"), F.lit(RELATED).alias("pred"), F.col("l_suppkey").cast("string").alias("obj"),
        F.expr(_COMMENTED).alias("comment"), rank.alias("_source_rank"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_line"), F.lit("x").alias("xref"),
    )
    return graph.stripped_edges(merge.merge_edges(edges))


# --- graph ----------------------------------------------------------------------------------

@query("""
    WITH n AS (SELECT 'P' || p_partkey AS id, p_name AS lbl FROM part UNION ALL SELECT 'S' || s_suppkey, s_name FROM supplier),
    e AS (SELECT 'P' || l_partkey AS a, 'S' || l_suppkey AS b, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS r, l_orderkey * 10 + l_linenumber AS l FROM lineitem),
    w AS (SELECT a AS id, b AS o, r, l, 0 AS way FROM e JOIN n ON n.id = a UNION ALL SELECT b, a, r, l, 1 FROM e),
    f AS (SELECT w.id, n.lbl, min((r, l, way)) AS m FROM w JOIN n ON n.id = w.o GROUP BY ALL)
    SELECT id AS term_uuid, count(*) AS n, string_agg(lbl, '|' ORDER BY m, lbl) AS related FROM f GROUP BY id""")
def adjacency_symmetric(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = _t(spark, sf_dir, "part"), _t(spark, sf_dir, "supplier")
    nodes = part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("term_uuid"), F.col("p_name").alias("lbl")).unionByName(
        supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("term_uuid"), F.col("s_name").alias("lbl"))
    )
    out = graph.symmetric_adjacency(_item_edges(spark, sf_dir, labelled=True), nodes)
    return out.select("term_uuid", F.size("related").cast("long").alias("n"), _joined("related").alias("related"))


_RELATED = "CASE WHEN p_size % 7 = 0 THEN 'unknown ' || p_name WHEN p_size % 2 = 0 THEN p_name END"


@query(f"""
    WITH t AS (SELECT p_name AS term, 'GSD:' || p_partkey AS u, {_RELATED} AS related, p_partkey AS l FROM part),
    k AS (SELECT term, arg_max(u, l) AS u FROM t GROUP BY term)
    SELECT coalesce(k.u, '[PLACEHOLDER]') AS subj, 'has_related_synonym' AS pred, t.u AS obj, related || ' is a related synonym of ' || t.term AS comment
    FROM t LEFT JOIN k ON k.term = t.related WHERE related IS NOT NULL""")
def collect_related_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = _t(spark, sf_dir, "part").select(F.col("p_name").alias("term"), F.concat(F.lit("GSD:"), F.col("p_partkey").cast("string")).alias("term_uuid"), F.expr(_RELATED).alias("related"), F.col("p_partkey").alias("_line"))
    return graph.related_edges(terms).drop("_line")


@query("""
    SELECT o_orderkey, p AS first_part, q AS first_quantity FROM orders LEFT JOIN (
        SELECT l_orderkey, arg_min(l_partkey, k) AS p, arg_min(l_quantity, k) AS q
        FROM (SELECT *, (l_linenumber, l_partkey, l_suppkey, l_quantity) AS k FROM lineitem) GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def first_match_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey"))
    items = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    out = graph.first_match(orders, items, "o_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "l_orderkey")
    return out.select("o_orderkey", F.col("matched.l_partkey").alias("first_part"), F.col("matched.l_quantity").alias("first_quantity"))


@query("""
    WITH c AS (SELECT c_nationkey AS k, arg_min(c_name, c_custkey) AS customer FROM customer GROUP BY 1),
    r AS (SELECT a.r_name AS name, b.r_name AS near FROM region a, region b WHERE abs(a.r_regionkey - b.r_regionkey) = 1)
    SELECT r_name AS region, n_name AS nation, customer, (SELECT string_agg(near, '|' ORDER BY near) FROM r WHERE r.name = r_name) AS related
    FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN c ON k = n_nationkey""")
def dictionary_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation = _t(spark, sf_dir, "region"), _t(spark, sf_dir, "nation")
    entry = F.struct(F.col("n_name").alias("src_lbl"), F.col("n_name").alias("src"), F.col("n_nationkey").cast("string").alias("src_uuid"))
    nodes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_regionkey").cast("string").alias("term_uuid"), F.col("r_name").alias("lbl")).agg(F.array_sort(F.collect_list(entry)).alias("sources"))
    key = F.col("r_regionkey")
    edges = region.where(key < 4).select(key.cast("string").alias("subj"), F.lit(RELATED).alias("pred"), (key + 1).cast("string").alias("obj"), F.lit(0).alias("_source_rank"), key.alias("_line"))
    terms = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("src_uuid"), F.struct("c_name").alias("content"), F.lit(0).alias("_source_rank"), F.col("c_custkey").alias("_line"))
    out = graph.assemble_dictionary(nodes, edges, terms).select("lbl", F.explode("sources").alias("s"))
    return out.select(F.col("lbl").alias("region"), F.col("s.src_lbl").alias("nation"), F.col("s.src_content.record.c_name").alias("customer"), F.array_join(F.array_sort("s.src_content.related_synonyms"), "|").alias("related"))


# --- checks ---------------------------------------------------------------------------------

@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def qc_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT doc_id, n FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1")
def qc_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("mark"))
    return checks.duplicated_rows(marked, "mark").select("doc_id", "n")


@query("""
    SELECT c_custkey, 'c_name' AS "column", c_name AS value FROM customer WHERE NOT starts_with(c_name, 'Customer#0000001')
    UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer WHERE NOT starts_with(c_mktsegment, 'B')""")
def qc_prefix_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return checks.prefix_violations(rows, {"c_name": "Customer#0000001", "c_mktsegment": "B"}).select("c_custkey", "column", "value")


_BROKEN = "CASE WHEN event_id % 7 = 0 THEN substr(props, 2) WHEN event_id % 5 = 0 THEN replace(props, '\"k\"', '\"z\"') ELSE props END"


@query(f"""
    SELECT event_id, CASE WHEN json_valid(raw) THEN 'k' END AS missing FROM (SELECT event_id, {_BROKEN} AS raw FROM events)
    WHERE NOT json_valid(raw) OR NOT list_contains(json_keys(CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END), 'k')""")
def qc_mandatory_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", F.expr(_BROKEN).alias("raw"))
    return checks.key_violations(rows, "raw", ["k"]).select("event_id", F.array_join("missing", ",").alias("missing"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def qc_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_counts(_t(spark, sf_dir, "documents").select(F.col("source").alias("_source"))).withColumnRenamed("_source", "source")


@query("SELECT p_name AS lbl, count(*) AS n, string_agg(p_partkey::VARCHAR, '|' ORDER BY p_partkey::VARCHAR) AS term_uuids FROM part GROUP BY p_name HAVING count(*) > 1")
def qc_repeated_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _t(spark, sf_dir, "part").select(F.col("p_name").alias("lbl"), F.col("p_partkey").cast("string").alias("term_uuid"))
    return checks.repeated_labels(nodes).withColumn("term_uuids", _joined("term_uuids"))


@query("""
    SELECT p_name AS lbl, string_agg(p_partkey || ':' || p_brand, '|' ORDER BY p_partkey::VARCHAR) AS sources FROM part GROUP BY p_name HAVING count(*) > 1""")
def qc_repeated_label_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated labels with each node's sources beside its id."""
    source = F.array(F.struct(F.col("p_brand").alias("src_uuid")))
    nodes = _t(spark, sf_dir, "part").select(F.concat(F.lit(" "), F.col("p_name")).alias("lbl"), F.col("p_partkey").cast("string").alias("term_uuid"), source.alias("sources"))
    each = F.transform("sources", lambda x: F.concat(x["term_uuid"], F.lit(":"), F.array_join(x["src_uuids"], ",")))
    return checks.repeated_labels(nodes).select("lbl", F.array_join(each, "|").alias("sources"))


@query("""
    SELECT p_brand AS gsd_id, count(*) AS n, string_agg(p_partkey::VARCHAR, '|' ORDER BY p_partkey::VARCHAR) AS src_uuids FROM part GROUP BY 1 HAVING count(*) > 1""")
def qc_repeated_accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _t(spark, sf_dir, "part").select(F.col("p_brand").alias("gsd_id"), F.array(F.struct(F.col("p_partkey").cast("string").alias("src_uuid"))).alias("sources"))
    return checks.repeated_accessions(nodes).withColumn("src_uuids", _joined("src_uuids"))


# --- reconciliation -------------------------------------------------------------------------

def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _t(spark, sf_dir, "documents")
    ending = F.when(F.col("lang") == "en", "\n").otherwise(" elsewhere\n")
    name = F.when(F.col("doc_id") % 10 == 0, "[DISCARD]").otherwise(F.concat(F.lit(" doc"), F.col("doc_id").cast("string"), ending))
    about = F.when(F.col("quality") == 1, "doc").otherwise("poor")
    decided = _t(spark, sf_dir, "labels").select(F.concat(about, F.col("doc_id").cast("string")).alias("source_term"), F.concat(F.lit("U"), F.col("doc_id").cast("string")).alias("mapped_to_uuid"), "doc_id")
    return docs.select("doc_id", name.alias("normalized_term")), decided


_SIDES = """
    WITH o AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '[DISCARD]' ELSE 'doc' || doc_id || CASE lang WHEN 'en' THEN '' ELSE ' elsewhere' END END AS t FROM documents),
    d AS (SELECT CASE quality WHEN 1 THEN 'doc' ELSE 'poor' END || doc_id AS t, 'U' || doc_id AS u FROM labels)"""


@query(_SIDES + " SELECT doc_id, CASE WHEN o.t <> '[DISCARD]' THEN u END AS term_uuid, CASE WHEN o.t = '[DISCARD]' THEN 'discarded' WHEN u IS NOT NULL THEN 'matched' ELSE 'unmatched' END AS status FROM o LEFT JOIN d USING (t)")
def reconcile_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconciled(*_sides(spark, sf_dir), F.col("doc_id")).select("doc_id", "term_uuid", F.col("_status").alias("status"))


@query(_SIDES + " SELECT DISTINCT t AS term FROM o WHERE t <> '[DISCARD]' AND t NOT IN (SELECT t FROM d)")
def reconcile_unmatched_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.unmatched_originals(*_sides(spark, sf_dir), F.col("doc_id"))


@query(_SIDES + " SELECT t AS term FROM d WHERE t NOT IN (SELECT t FROM o)")
def reconcile_unmatched_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.unmatched_decisions(*_sides(spark, sf_dir), F.col("doc_id"))


@query(_SIDES + """ SELECT count(*) AS total, count(*) FILTER (o.t = '[DISCARD]') AS discarded, count(*) FILTER (o.t <> '[DISCARD]') AS active, count(u) AS matched,
    count(*) FILTER (o.t <> '[DISCARD]' AND u IS NULL) AS unmatched_originals, (SELECT count(*) FROM d WHERE t NOT IN (SELECT t FROM o)) AS unmatched_decisions FROM o LEFT JOIN d USING (t)""")
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile_summary(*_sides(spark, sf_dir), F.col("doc_id"))


@query(_SIDES + " SELECT doc_id, u AS term_uuid FROM (SELECT o.doc_id, CASE WHEN o.t <> '[DISCARD]' THEN u END AS u FROM o LEFT JOIN d USING (t) ORDER BY o.doc_id LIMIT 3) WHERE u IS NOT NULL")
def reconcile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.match_sample(reconcile.reconciled(*_sides(spark, sf_dir), F.col("doc_id")), ["doc_id"]).select("doc_id", "term_uuid")


# --- retrieval ------------------------------------------------------------------------------

@query("""
    WITH m AS (
        SELECT q.vec_id AS query_id, v.vec_id AS id, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS score
        FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM m WHERE score >= 0.3)
    SELECT query_id, id, round(score, 6) AS score, rank::INTEGER AS rank FROM r WHERE rank <= 4""")
def topk_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    asked = store.where(F.col("id") % 20 == 0).withColumnRenamed("id", "query_id")
    return retrieval.top_k(asked, store, 4).withColumn("score", F.round("score", 6))


@query("""
    WITH RECURSIVE v AS (SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    r AS (
        SELECT 0::BIGINT AS i, []::STRUCT(id BIGINT, e DOUBLE[])[] AS f
        UNION ALL
        SELECT r.i + 1, CASE WHEN len(list_filter(r.f, lambda x: list_cosine_similarity(x.e, v.e) >= 0.6)) > 0 THEN r.f ELSE list_append(r.f, {'id': v.vec_id, 'e': v.e}) END
        FROM r JOIN v ON v.i = r.i + 1),
    f AS (SELECT x.id AS id, x.e AS e FROM (SELECT unnest(f) AS x FROM (SELECT f FROM r ORDER BY i DESC LIMIT 1))),
    n AS (
        SELECT v.vec_id AS id, f.id AS concept_id, round(list_cosine_similarity(v.e, f.e), 12) AS score FROM v JOIN f ON f.id < v.vec_id WHERE v.vec_id NOT IN (SELECT id FROM f)),
    b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, concept_id) AS k FROM n WHERE score >= 0.6)
    SELECT id, 'map' AS action, concept_id, round(score, 6) AS score FROM b WHERE k = 1 UNION ALL SELECT id, 'add', id, NULL FROM f""")
def decide_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector in the order of ids maps to the nearest concept founded before it within 0.6, or founds one."""
    out = retrieval.decide_in_order(_t(spark, sf_dir, "embeddings"), "vec_id", ["vec_id"], floor=0.6)
    return out.withColumn("score", F.round("score", 6))


@query("""
    WITH k AS (SELECT lower(p_name) AS n, min(p_partkey) AS id FROM part WHERE p_size <= 3 GROUP BY 1),
    t AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE p_name END AS term FROM part)
    SELECT p_partkey, CASE WHEN id IS NULL THEN 'add' ELSE 'map' END AS action, coalesce(id::VARCHAR, left(sha256(term), 32)) AS mapped_to_uuid FROM t LEFT JOIN k ON n = lower(term)""")
def decide_map_or_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _t(spark, sf_dir, "part")
    terms = part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("term"))
    known = part.where("p_size <= 3").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    return retrieval.decide(terms, known).select("p_partkey", "action", "mapped_to_uuid")


@query("""
    WITH m AS (SELECT c_nationkey AS id, list_sort(list_distinct(list(c_mktsegment))) AS more FROM customer GROUP BY 1)
    SELECT s_suppkey::VARCHAR AS id, s_name AS term, CASE WHEN more IS NULL THEN '' ELSE array_to_string(more, '|') END AS synonyms FROM supplier LEFT JOIN m ON m.id = s_suppkey
    UNION ALL SELECT 'new' || r_regionkey, r_name, '' FROM region""")
def vector_store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("term"), F.array().cast("array<string>").alias("synonyms"), F.lit("").alias("description"))
    mapped = _t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("term"), F.col("c_nationkey").cast("string").alias("mapped_to_uuid"), F.lit("map").alias("action"))
    added = _t(spark, sf_dir, "region").select(F.col("r_name").alias("term"), F.concat(F.lit("new"), F.col("r_regionkey").cast("string")).alias("mapped_to_uuid"), F.lit("add").alias("action"))
    return retrieval.upserted_store(store, mapped.unionByName(added)).select("id", "term", _joined("synonyms").alias("synonyms"))


# --- text -----------------------------------------------------------------------------------

@query("""
    SELECT doc_id, (i - 1)::INTEGER AS at, part AS sentence FROM (
        SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (
            SELECT doc_id, string_split(regexp_replace(text, '\\.\\s+', '.' || chr(1), 'g'), chr(1)) AS parts FROM documents)) WHERE part <> ''""")
def sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.sentences(_t(spark, sf_dir, "documents").select("doc_id", "text"))


@query("""
    WITH p AS (SELECT doc_id, text, strpos(text, ' the ') AS pos FROM documents WHERE contains(text, ' the ')),
    h AS (SELECT doc_id, regexp_extract(left(text, pos), '(?s)^(?:.*\\.\\s+)?(.*)$', 1) AS head, substr(text, pos + 1) AS tail FROM p)
    SELECT doc_id, trim(head || CASE WHEN regexp_matches(tail, '(?s)\\.\\s') THEN regexp_extract(tail, '(?s)^(.*?\\.)\\s', 1) ELSE tail END, E' \\n\\t\\r') AS sentence FROM h""")
def mention_in_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text").where(F.col("text").contains(" the "))
    at = F.instr("text", " the ")
    return docs.select("doc_id", text.mention_sentence(F.col("text"), text.sentence_spans(F.col("text")), at, at + 3).alias("sentence"))


@query("""
    WITH p AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i, len(parts) AS n FROM (SELECT doc_id, string_split(text, ' the ') AS parts FROM documents)),
    m AS (SELECT doc_id, sum(length(part) + 5) OVER (PARTITION BY doc_id ORDER BY i) - 4 AS a, i, n FROM p),
    q AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (
        SELECT doc_id, string_split(regexp_replace(text, '\\.(\\s+)', '.' || chr(1) || '\\1', 'g'), chr(1)) AS parts FROM documents)),
    b AS (SELECT doc_id, part, i, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) AS e, (i < count(*) OVER (PARTITION BY doc_id))::INTEGER AS blank FROM q),
    s AS (SELECT doc_id, e - CASE WHEN i = 1 THEN length(part) ELSE length(ltrim(part, E' \\n\\t\\r\\f')) END AS s, e + blank AS e FROM b)
    SELECT m.doc_id, a::INTEGER AS start_pos, min(s.s)::INTEGER AS s, arg_min(s.e, s.s)::INTEGER AS e
    FROM m LEFT JOIN s ON s.doc_id = m.doc_id AND s.s < s.e AND s.s < m.a + 3 AND s.e > m.a WHERE m.i < m.n GROUP BY m.doc_id, a""")
def mentions_in_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mention of ``the`` in every document with its sentence, by a join of ranges between the two tables."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    found = text.occurrences(docs, "doc_id", "text", " the ")
    mentions = found.select(F.col("id").alias("doc_id"), (F.col("start_pos") + 1).alias("start_pos"), (F.col("end_pos") - 1).alias("end_pos"))
    spans = docs.select(F.col("doc_id").alias("id"), F.explode(text.sentence_spans(F.col("text"))).alias("x")).select("id", "x.*")
    return text.first_overlaps(mentions, spans, "doc_id").drop("end_pos")


#: Terms that a filter must tell apart, dealt to the parts in turn.
_SPECIMENS = (
    "MUC1", "muc16 core", "galectin-3", "Galectin", "lectins", "selectin", "integrin", "albumin", "transferrin", "IgG", "igm", "Antibodies", "anti glycan", "anti-glycans", "sialyltransferase",
    "β-galactosidase", "glycosidase", "glycosidases x", "hexosaminidase", "mannosidases", "GlycA", "M2BPGi", "GP12", "GP1234", "UDP-Gal", "cmp-Neu5Ac", "ADP-ribose", "α2-3 sialyl", "β1→4", "b1-4",
    "C18:1", "c18:1", "C10:2", "multivalent", "vertebrate glycan", "plants", "fungal-like", "nonreducing end", "cell surface", "synthetically", "linkage", "cross-linkage x", "linkages", "n-glycan", "O-Glycans",
    "gag", "GAGs", "proteoglycan", "glycoform", "trisaccharide", "Glycan Motif", "Dol-P-Man", "ogt", "gh", "index", "sugar", "chain", "human milk glycan", "Lewis x", " core 2 ", "H", "xy", "",
)


@query(r"""
    WITH s AS (SELECT """ + repr(list(_SPECIMENS)).replace('"', "'") + r""" AS l),
    t AS (SELECT unnest(string_split_regex(text, '\s+')) AS term FROM documents UNION ALL SELECT l[p_partkey % len(l) + 1] FROM part, s),
    c AS (SELECT term, count(*) AS n FROM t GROUP BY term),
    w AS (SELECT trim(term) AS term, n, CASE WHEN n % 7 = 0 THEN 'x' WHEN n % 5 = 0 THEN '-1' ELSE '0' END AS s FROM c WHERE regexp_full_match(term, '[ A-Za-z0-9:>αβ→-]*'))
    SELECT term, n FROM w WHERE s = '0' AND length(term) >= 3
      AND NOT regexp_matches(term, '(?i)\b(MUC[0-9]+|galectin-?[0-9]*|lectins?|integrins?|albumin|transferrin|igg|iga|igm|antibody|antibodies|anti[- ]?glycans?|GlycA|M2BPGi|GP[0-9]{1,3}|hexosaminidases?|mannosidases?)\b')
      AND NOT regexp_matches(term, '(?i)(transferase|glycosidase|transferases|glycosidases)\b') AND NOT regexp_matches(term, '(?i)linkage\b')
      AND NOT regexp_matches(term, '(?i)\b(UDP|GDP|CMP)-[A-Z0-9]') AND NOT regexp_matches(term, '(?i)\b(multivalent|vertebrate|bacterial|plant|fungal|nonreducing|cell surface|synthetic)')
      AND NOT regexp_matches(term, '(^|[^0-9A-Za-z_αβ])[αβ][1-9](-|→)[1-9]($|[^0-9A-Za-z_αβ])') AND NOT regexp_matches(term, '\bC[1-9][1-9]:[1-9]\b')
      AND NOT regexp_full_match(lower(term), '(n-|o-|n-linked |o-linked |)glycans?|(n-|o-|)glycan structures?|glycan (motif|epitope)s?|carbohydrates?|(mono|di|tri|oligo|poly)saccharides?|glycosylations?|glycoforms?|glycoconjugates?|glycoproteins?|glycosidic bonds?|glycolipids?|gags?|glycosaminoglycans?|(proteo|peptido)glycans?|gts?|ghs?|(sial|neuramin)idases?|ogts?|ogas?|dol-p-man|mannac-6-p')""")
def mention_exclusion_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _t(spark, sf_dir, "documents").select(F.explode(F.split("text", r"\s+")).alias("term"))
    dealt = _t(spark, sf_dir, "part").select(F.get(F.array(*map(F.lit, _SPECIMENS)), (F.col("p_partkey") % len(_SPECIMENS)).cast("int")).alias("term"))
    terms = words.unionByName(dealt).groupBy("term").agg(F.count("*").alias("n"))
    start = F.when(F.col("n") % 7 == 0, "x").when(F.col("n") % 5 == 0, "-1").otherwise("0")
    spans = terms.where(F.col("n").isNotNull() & F.when(F.col("n") > 0, F.col("term").rlike(r"\A[ A-Za-z0-9:>αβ→-]*\z"))).select("term", "n", start.alias("start_pos"), F.col("n").alias("end_pos"))
    return text.kept_mentions(spans).select("term", "n")


@query(r"""
    WITH p AS (SELECT doc_id, regexp_extract_all(text, '(?s)(.*?\.\s+|.+$)') AS parts FROM documents),
    u AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM p),
    a AS (SELECT doc_id, i, part, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM u)
    SELECT doc_id, (i - 1)::INTEGER AS at, (stop - length(part))::INTEGER AS s,
           CASE WHEN regexp_matches(part, '(?s)\.\s+$') THEN stop - length(part) + length(regexp_replace(part, '\s+$', '')) + 1 ELSE stop END::INTEGER AS e FROM a WHERE part <> ''""")
def sentence_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").where(F.length("text") > 0)
    return docs.select("doc_id", F.posexplode(text.sentence_spans(F.col("text"))).alias("at", "x")).select("doc_id", "at", "x.s", "x.e")


@query("""
    WITH n AS (SELECT row_number() OVER (ORDER BY doc_id) AS processed, sum(length(text) % 4) OVER (ORDER BY doc_id) AS hits FROM documents)
    SELECT processed, hits::BIGINT AS hits FROM n WHERE processed % 10 = 0 OR processed = (SELECT count(*) FROM documents)""")
def extraction_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _t(spark, sf_dir, "documents").select("doc_id", (F.length("text") % 4).alias("hits"))
    return text.progress(chunks, ["doc_id"], "hits")


@query("""
    SELECT event_id, coalesce(nullif(CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN event_type END, ''), 'id' || event_id) AS uuid,
           CASE event_id % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.25 ELSE 0 END::DOUBLE AS score FROM events""")
def coalesced_alternates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 3
    uuid = F.when(k == 0, "").when(k == 1, F.col("event_type"))
    raw = F.when(k == 0, '{"score": 0.5, "confidence": 0.9}').when(k == 1, '{"confidence": 0.25}').otherwise('{"text": "t"}')
    return _t(spark, sf_dir, "events").select("event_id", text.first_filled(uuid, F.concat(F.lit("id"), F.col("event_id").cast("string"))).alias("uuid"), text.score_of(raw).alias("score"))


@query("""
    WITH RECURSIVE d AS (SELECT doc_id AS id, text AS t, length(text) AS n FROM documents WHERE text <> ''),
    c AS (
        SELECT id, t, n, 0 AS k, 0::BIGINT AS start FROM d
        UNION ALL
        SELECT id, t, n, k + 1, coalesce(
            CASE WHEN strpos(v, s1) > 0 AND low + strpos(v, s1) + 1 < stop THEN low + strpos(v, s1) + 1 END, CASE WHEN strpos(v, s2) > 0 AND low + strpos(v, s2) < stop THEN low + strpos(v, s2) END,
            CASE WHEN strpos(v, '. ') > 0 AND low + strpos(v, '. ') + 1 < stop THEN low + strpos(v, '. ') + 1 END, CASE WHEN strpos(v, ', ') > 0 AND low + strpos(v, ', ') + 1 < stop THEN low + strpos(v, ', ') + 1 END,
            CASE WHEN strpos(v, ' ') > 0 AND low + strpos(v, ' ') < stop THEN low + strpos(v, ' ') END, low)
        FROM (SELECT *, greatest(start + 1, stop - 200) AS low, substr(t, greatest(start + 1, stop - 200) + 1, stop - greatest(start + 1, stop - 200)) AS v FROM (SELECT *, CASE WHEN start + 1000 >= n THEN n ELSE start + 1000 - coalesce(
            CASE WHEN strpos(w, s1) > 0 THEN strpos(w, s1) - 1 END, CASE WHEN strpos(w, s2) > 0 THEN strpos(w, s2) - 1 END, CASE WHEN strpos(w, ' .') > 0 THEN strpos(w, ' .') - 1 END,
            CASE WHEN strpos(w, ' ,') > 0 THEN strpos(w, ' ,') - 1 END, CASE WHEN strpos(w, ' ') > 0 THEN strpos(w, ' ') - 1 END, 0) END AS stop
            FROM (SELECT *, reverse(substr(t, start + 501, 500)) AS w, chr(10) || chr(10) AS s1, chr(10) AS s2 FROM c)) WHERE stop < n))
    SELECT id, k AS at, substr(t, start + 1, stop - start) AS chunk, left(sha256(id || chr(1) || k), 32) AS chunk_id FROM (SELECT *, CASE WHEN start + 1000 >= n THEN n ELSE start + 1000 - coalesce(
            CASE WHEN strpos(w, s1) > 0 THEN strpos(w, s1) - 1 END, CASE WHEN strpos(w, s2) > 0 THEN strpos(w, s2) - 1 END, CASE WHEN strpos(w, ' .') > 0 THEN strpos(w, ' .') - 1 END,
            CASE WHEN strpos(w, ' ,') > 0 THEN strpos(w, ' ,') - 1 END, CASE WHEN strpos(w, ' ') > 0 THEN strpos(w, ' ') - 1 END, 0) END AS stop
            FROM (SELECT *, reverse(substr(t, start + 501, 500)) AS w, chr(10) || chr(10) AS s1, chr(10) AS s2 FROM c))""")
def chunk_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.chunks(_t(spark, sf_dir, "documents"), "doc_id")


@query("SELECT p_name AS term, string_agg(p_type, '|' ORDER BY p_partkey) AS sentences, string_agg(p_brand, '|' ORDER BY p_partkey) AS brands FROM part GROUP BY p_name")
def mention_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = text.mention_groups(_t(spark, sf_dir, "part"), "p_name", "p_type", F.struct("p_brand"), "p_partkey")
    return out.select(F.col("original_term").alias("term"), _joined("term_in_sentence").alias("sentences"), F.array_join("metadata.p_brand", "|").alias("brands"))


@query("""
    WITH f AS (SELECT doc_id, left(text, 35) AS a, right(text, 36) AS b FROM documents),
    c AS (SELECT doc_id, CASE WHEN contains(a, ' ') THEN left(a, length(a) - strpos(reverse(a), ' ')) ELSE a END AS a, CASE WHEN contains(b, ' ') THEN substr(b, strpos(b, ' ') + 1) ELSE b END AS b FROM f)
    SELECT doc_id, 'https://example.org/' || doc_id || '/#:~:text=' || replace(url_encode(a), '%2F', '/') || ',' || replace(url_encode(CASE WHEN ends_with(b, '.') THEN left(b, length(b) - 1) ELSE b END), '%2F', '/') AS link FROM c""")
def deep_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", s.deep_link(F.lit("https://example.org/"), F.col("doc_id").cast("string"), F.col("text")).alias("link"))


@query("SELECT p_partkey, url_encode(p_name || ' / ' || p_type || '*~') AS strict, replace(url_encode(p_name || ' / ' || p_type || '*~'), '%2F', '/') AS loose FROM part")
def percent_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.concat("p_name", F.lit(" / "), "p_type", F.lit("*~"))
    return _t(spark, sf_dir, "part").select("p_partkey", s.percent_encoded(c, keep_slash=False).alias("strict"), s.percent_encoded(c).alias("loose"))


@query("""
    SELECT p_partkey, 'Term: ' || p_name || chr(10) || 'Exact Synonyms: ["' || p_type || '","' || p_brand || '"]' || chr(10) || 'Description: ' || chr(10) || 'Term UUID: ' || p_partkey AS document,
           p_name AS term, p_type || '|' || p_brand AS synonyms, p_partkey::VARCHAR AS uuid FROM part""")
def template_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _t(spark, sf_dir, "part").select("p_partkey", s.document_text(F.col("p_name"), F.array("p_type", "p_brand"), F.lit(None).cast("string"), F.col("p_partkey").cast("string")).alias("document"))
    d = s.parsed_document(F.col("document"))
    return made.select("p_partkey", "document", d["term"].alias("term"), F.array_join(d["synonyms"], "|").alias("synonyms"), d["uuid"].alias("uuid"))


# --- batches and runs -----------------------------------------------------------------------

@query("SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // 5 AS batch FROM part")
def batch_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.fixed_batches(_t(spark, sf_dir, "part").select("p_partkey"), ["p_partkey"], 5)


@query("SELECT p_partkey FROM part QUALIFY row_number() OVER (ORDER BY p_partkey) BETWEEN 11 AND 40")
def line_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.line_slice(_t(spark, sf_dir, "part").select("p_partkey"), ["p_partkey"], 11, 40)


@query("""
    WITH RECURSIVE r AS (SELECT p_brand, p_partkey, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i, lag(p_name) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS before FROM part),
    f AS (
        SELECT p_brand, p_partkey, i, 0::BIGINT AS batch, 1 AS n FROM r WHERE i = 1
        UNION ALL
        SELECT r.p_brand, r.p_partkey, r.i, CASE WHEN stays THEN batch ELSE batch + 1 END, CASE WHEN stays THEN n + 1 ELSE 1 END
        FROM (SELECT r.*, f.batch, f.n, (f.n < 5 OR (f.n < 12 AND left(lower(r.p_name), 4) = left(lower(r.before), 4))) AS stays FROM r JOIN f ON r.p_brand = f.p_brand AND r.i = f.i + 1) r)
    SELECT p_brand, p_partkey, batch FROM f""")
def batch_adaptive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.adaptive_batches(_t(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name"), "p_brand", ["p_partkey"], "p_name").select("p_brand", "p_partkey", "batch")


@query("""
    WITH RECURSIVE r AS (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name, p_partkey) AS i, lag(p_name) OVER (ORDER BY p_name, p_partkey) AS before FROM part),
    f AS (
        SELECT p_partkey, i, 0::BIGINT AS batch, 1 AS n FROM r WHERE i = 1
        UNION ALL
        SELECT r.p_partkey, r.i, CASE WHEN stays THEN batch ELSE batch + 1 END, CASE WHEN stays THEN n + 1 ELSE 1 END
        FROM (SELECT r.*, f.batch, f.n, (f.n < 5 OR (f.n < 12 AND left(lower(r.p_name), 4) = left(lower(r.before), 4))) AS stays FROM r JOIN f ON r.i = f.i + 1) r)
    SELECT p_partkey, batch FROM f""")
def batch_adaptive_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.adaptive_batches(_t(spark, sf_dir, "part").select("p_partkey", "p_name"), None, ["p_name", "p_partkey"], "p_name").select("p_partkey", "batch")


_RUNS = """
    WITH m AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM m)"""


@query(_RUNS + " SELECT user_id, run::BIGINT AS run, event_type, count(*) AS n, min(event_id) AS least FROM r GROUP BY ALL")
def run_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = batching.runs(_t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type")
    return rows.groupBy("user_id", "run", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("least"))


@query(_RUNS + """ , g AS (SELECT user_id, run, event_type, list(props ORDER BY ts, event_id) AS p, string_agg(event_id::VARCHAR, chr(10) ORDER BY ts, event_id) AS descriptions FROM r GROUP BY ALL)
    SELECT user_id, run::BIGINT AS run, array_to_string(list_sort(list_distinct(list_append(p, event_type))), '|') AS distinct_terms, len(p) AS n_nested, descriptions FROM g""")
def summarized_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", F.array("event_type", "props").alias("terms"), F.col("event_id").cast("string").alias("d"))
    out = batching.summarized_runs(rows, ["user_id"], ["ts", "event_id"], "event_type", "terms", "d")
    return out.select("user_id", "run", F.array_join(F.array_sort("distinct_terms"), "|").alias("distinct_terms"), F.size("nested").cast("long").alias("n_nested"), "descriptions")


# --- scalars --------------------------------------------------------------------------------

@query("""
    SELECT c_custkey, 'SEG:' || c_mktsegment AS segment, c_name AS name, 'a' || chr(10) || 'b' || chr(13) || c_custkey AS code, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END AS listed,
           CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS named, c_mktsegment AS stripped FROM customer""")
def scalar_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name"))
    return _t(spark, sf_dir, "customer").select(
        "c_custkey", s.ensure_prefix(F.col("c_mktsegment"), "SEG:").alias("segment"), s.ensure_prefix(F.col("c_name"), "Customer#").alias("name"),
        s.unescape_breaks(F.concat(F.lit("a\\nb\\r"), F.col("c_custkey").cast("string"))).alias("code"), F.size(s.as_list(some)).alias("listed"), s.blank_to_null(some).alias("named"),
        s.ustrip(F.concat(F.lit("  "), "c_mktsegment", F.lit("\n"))).alias("stripped"),
    )


@query("""
    SELECT c_custkey, c_name AS term, '[ERROR]' AS xref, 'GSD:' || c_custkey AS term_uuid, 'SRC:' || c_custkey AS src_uuid, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS gtc_id,
           CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS definition FROM customer WHERE c_custkey % 4 <> 0""")
def format_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    raw = F.to_json(F.struct(
        F.when(key % 4 == 0, "[DISCARD]").otherwise(F.col("c_name")).alias("name"), F.concat(F.lit("GSD:"), key.cast("string")).alias("term_uuid"), F.concat(F.lit("SRC:"), key.cast("string")).alias("src_uuid"),
        F.when(key % 2 == 0, F.col("c_mktsegment")).alias("gtc_id"), F.when(key % 5 == 0, "").otherwise(F.col("c_mktsegment")).alias("definition"),
    ))
    lines = _t(spark, sf_dir, "customer").select(raw.alias("_raw"), F.lit("customer").alias("_source"), F.lit(0).alias("_source_rank"), key.alias("_line"))
    out = readers.formatted_terms(lines, {"term": "name"})
    return out.select(F.col("_line").alias("c_custkey"), "term", "xref", "term_uuid", "src_uuid", F.array_join("metadata.gtc_id", "|").alias("gtc_id"), F.col("metadata.definition").alias("definition"))


@query("SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag) || list(l_linestatus))), '|') AS flags FROM lineitem GROUP BY l_orderkey")
def flatten_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(s.distinct_members(F.collect_set(F.array("l_returnflag", "l_linestatus")))), "|").alias("flags"))


@query("""
    WITH g AS (SELECT l_orderkey, list(l_partkey ORDER BY l_partkey) AS a, list(l_suppkey ORDER BY l_suppkey) FILTER (l_returnflag = 'N') AS b FROM lineitem GROUP BY 1)
    SELECT l_orderkey, coalesce(array_to_string(list_transform(range(1, coalesce(least(len(a), len(b)), 0) + 1), lambda i: a[i] || '-' || b[i]), '|'), '') AS pairs FROM g""")
def zip_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("a"), F.array_sort(F.collect_list(F.when(F.col("l_returnflag") == "N", F.col("l_suppkey")))).alias("b"))
    pairs = F.transform(text.zipped(F.col("a"), F.col("b")), lambda p: F.concat(p["a"].cast("string"), F.lit("-"), p["b"].cast("string")))
    return g.select("l_orderkey", F.array_join(pairs, "|").alias("pairs"))


@query("""
    SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 'P:' || (CASE WHEN event_id % 3 = 1 THEN event_type ELSE '' END) || '|:' || event_type END AS contents, 'x|y|' || event_type || '|z' AS flat FROM events""")
def struct_list_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    mixed = (
        F.when(F.col("event_id") % 3 == 1, F.concat(F.lit('[{"src":"P","content":"'), e, F.lit('"},"'), e, F.lit('"]')))
        .when(F.col("event_id") % 3 == 2, F.concat(F.lit('[{"src":"P"},"'), e, F.lit('"]'))).otherwise(F.concat(F.lit('"'), e, F.lit('"')))
    )
    nested = F.concat(F.lit('["x",["y",["'), e, F.lit('"]],"z"]'))
    out = F.transform(s.content_list(mixed), lambda x: F.concat(x["src"], F.lit(":"), x["content"]))
    return _t(spark, sf_dir, "events").select("event_id", F.array_join(out, "|").alias("contents"), F.array_join(s.flatten_json_list(nested), "|").alias("flat"))


@query(f"SELECT event_id, CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.k')::INTEGER END AS k FROM (SELECT event_id, {_BROKEN} AS raw FROM events) WHERE json_valid(raw)")
def json_ingest_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", F.expr(_BROKEN).alias("raw")).where(F.json_object_keys("raw").isNotNull())
    return rows.select("event_id", F.from_json("raw", "k int")["k"].alias("k"))


@query(f"""
    WITH l AS (SELECT CASE WHEN event_id % 11 = 0 THEN '' ELSE {_BROKEN} END AS raw, event_id FROM events)
    SELECT mode, coalesce(k, -1) AS k, count(*) AS n FROM (
        SELECT 'permissive' AS mode, json_extract_string(CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END, '$.k')::INTEGER AS k FROM l WHERE json_valid(raw)
        UNION ALL SELECT 'checked', CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.k')::INTEGER END FROM l
        UNION ALL SELECT 'strict', json_extract_string(CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END, '$.k')::INTEGER FROM l WHERE json_valid(raw)
        UNION ALL SELECT 'raising', json_extract_string(CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END, '$.k')::INTEGER FROM l WHERE json_valid(raw)) GROUP BY ALL""")
def jsonl_scan_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the events as line files, sound ones apart, and reads them back in each mode."""
    rows = _t(spark, sf_dir, "events").select(F.when(F.col("event_id") % 11 == 0, "").otherwise(F.expr(_BROKEN)).alias("raw"))
    sound = F.json_object_keys("raw").isNotNull()
    root = fresh_path(spark, "jsonl")
    rows.repartition(8).write.text(f"{root}/all")
    rows.where(sound).repartition(8).write.text(f"{root}/sound")
    out = None
    for mode in (readers.PERMISSIVE, readers.CHECKED, readers.STRICT, readers.RAISING):
        lines = readers.read_jsonl(spark, f"{root}/{'all' if mode in (readers.PERMISSIVE, readers.CHECKED) else 'sound'}/*.txt", "k int", mode)
        one = lines.groupBy(F.coalesce("k", F.lit(-1)).alias("k")).agg(F.count("*").alias("n")).select(F.lit(mode).alias("mode"), "k", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id % 16 ORDER BY event_id) AS line, (user_id % 16)::INTEGER AS source_rank FROM events")
def numbered_line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of sixteen line files with its number and the place of its file, from one scan that shuffles no line."""
    events = _t(spark, sf_dir, "events").select((F.col("user_id") % 16).alias("part"), "event_id", F.to_json(F.struct("user_id", "event_id")).alias("value"))
    root = fresh_path(spark, "lines")
    events.repartition(16, "part").sortWithinPartitions("part", "event_id").select("part", "value").write.partitionBy("part").text(root)
    held_parts = sorted(r["part"] for r in events.select("part").distinct().collect())  # sixteen at most
    lines = readers.numbered_lines(spark, [f"{root}/part={i}" for i in held_parts])
    held = F.from_json("_raw", "user_id long, event_id long")
    return lines.select(held["user_id"].alias("user_id"), held["event_id"].alias("event_id"), F.col("_line").alias("line"), F.element_at(F.lit(held_parts).cast("array<int>"), F.col("_source_rank") + 1).alias("source_rank"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'Others' ELSE event_type END AS classification FROM events")
def code_fence_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit('{"classification":"'), "event_type", F.lit('"}'))
    answer = F.when(F.col("event_id") % 7 == 0, "no json").when(F.col("event_id") % 2 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    parsed = s.parsed_or(answer, "classification string", F.struct(F.lit("Others").alias("classification")))
    return _t(spark, sf_dir, "events").select("event_id", parsed["classification"].alias("classification"))


@query("""
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING' ELSE c_mktsegment || '|BUILDING' END AS synonyms, ' (also known as: ' || c_mktsegment || ')' AS hint,
           c_mktsegment AS word, c_mktsegment = 'BUILDING' OR left(c_mktsegment, 4) = 'AUTO' AS alike FROM customer""")
def append_synonym(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return _t(spark, sf_dir, "customer").select(
        "c_custkey", F.array_join(s.with_synonym(F.array(segment), F.lit("BUILDING")), "|").alias("synonyms"), s.synonym_hint(F.array(segment)).alias("hint"),
        s.first_word(F.concat(F.lit(" "), segment, F.lit(" and more"))).alias("word"), (s.same_prefix(segment, F.lit("BUILDING")) | s.same_prefix(segment, F.lit("Autographs"))).alias("alike"),
    )


# --- providers and streams ------------------------------------------------------------------

@query()
def provider_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return providers.embedded(_t(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name")


@query()
def provider_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = batching.fixed_batches(_t(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_partkey"], 5).groupBy("batch").agg(F.array_sort(F.collect_list("p_name")).alias("terms"))
    answers = providers.answered(batches, "terms", "answer", providers.retain_by_length)
    lines = answers.select("batch", F.explode(F.split(s.unfenced(F.col("answer")), "\n")).alias("line"))
    fallback = F.struct(F.col("line").alias("original_term"), F.lit("error").alias("decision"))
    return lines.select("batch", s.parsed_or(F.col("line"), "original_term string, decision string", fallback).alias("r")).select("batch", "r.*")


class _NationService:
    """A stand-in for a service that knows the nations: some keys are never answered, some only when asked again."""

    def __init__(self, names: dict[str, str]):
        self.names, self.asked = names, set()

    def __call__(self, key: str) -> str | None:
        if int(key) % 7 == 3:
            raise ConnectionError(f"no answer for {key}")
        if int(key) % 5 == 1 and key not in self.asked:
            self.asked.add(key)
            raise TimeoutError(key)
        return self.names.get(key)


@query("""
    WITH k AS (SELECT DISTINCT nation_id AS k FROM clients WHERE nation_id IS NOT NULL UNION SELECT DISTINCT nation_id FROM vendors WHERE nation_id IS NOT NULL UNION SELECT 99)
    SELECT k::VARCHAR AS key, CASE WHEN k % 7 <> 3 THEN n_name END AS value, CASE WHEN k % 7 = 3 THEN 'ConnectionError: no answer for ' || k END AS error,
           CASE WHEN k % 7 = 3 THEN 3 WHEN k % 5 = 1 THEN 2 ELSE 1 END AS tries FROM k LEFT JOIN nation ON n_nationkey = k""")
def resolved_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation that clients or vendors name is asked for once; failures are rows with their error."""
    names = {str(r["n_nationkey"]): r["n_name"] for r in _t(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()}  # 25 rows at every size
    used = _t(spark, sf_dir, "clients").select("nation_id").unionByName(_t(spark, sf_dir, "vendors").select("nation_id")).unionByName(spark.range(1).select(F.lit(99).alias("nation_id")))
    return providers.resolved(used, "nation_id", lambda: _NationService(names), tries=3, wait=0.01)


@query("""
    SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n FROM events GROUP BY ALL""")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return upsert.windowed_counts(events, "ts", "event_type").select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(event_id) FILTER (true) IS NOT NULL AS seen, max((ts, event_id))[2] AS event_id FROM events GROUP BY user_id")
def incremental_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, dealt to eight files, as a stream of a file a batch, each merged into the buckets its users fall into; the final state."""
    whole = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    target = fresh_path(spark, "upsert")
    whole.repartition(8).write.parquet(f"{target}/arrived")
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{target}/arrived")
    table = upsert.latest_table(spark, f"{target}/state", ["user_id"], ["ts", "event_id"], buckets=32)
    upsert.upsert_stream(stream, table, f"{target}/progress").awaitTermination()
    return table.read().select("user_id", "event_type", F.lit(True).alias("seen"), "event_id")


@query(ORACLES["merge_ordered_upsert"])
def incremental_master_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same master from batches that arrive out of order and one that comes twice; each rewrites the buckets it touches."""
    terms = _part_terms(spark, sf_dir)
    table = buckets.BucketTable(spark, fresh_path(spark, "master"), ["term_uuid"], merge.folded_states, buckets=32)
    for number, part in enumerate((4, 1, 5, 0, 3, 2)):
        arrived = merge.concept_states(terms.where(F.pmod(F.xxhash64("term_uuid", "_line"), F.lit(6)) == part))
        table.merge(arrived, number)
        table.merge(arrived, number)
    return _flat_nodes(merge.concepts_of(table.read(), compat=True))
