"""Operators on hand-made rows with the results that their rules give."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptmerge.functions import providers, scalars as s
from conceptmerge.operators import batching, checks, graph, merge, nearest, reconcile, retrieval, text
from conceptmerge.schemas import RELATED

TERMS = "term string, xref string, term_uuid string, src_uuid string, gtc_id array<string>, gsd_id string, _source_rank int, _line long"


def terms(spark):
    return spark.createDataFrame(
        [
            (" alpha ", "SRC:A", "GSD:1", "SRC:a1", ["G1", "G1"], "ID1", 0, 1),
            ("[DISCARD]", "SRC:A", "GSD:9", "SRC:a2", None, None, 0, 2),
            ("alfa", "SRC:B", "GSD:1", "SRC:b1", ["G2"], "ID2", 1, 1),
            ("beta", "SRC:B", "GSD:2", "SRC:b2", None, "ID3", 1, 2),
            ("alpha", "SRC:C", "GSD:1", "SRC:c1", ["G1", "G3", ""], None, 2, 1),
        ],
        TERMS,
    )


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_ordered_merge(spark):
    got = {r["term_uuid"]: r for r in merge.merge_concepts(terms(spark), compat=True).collect()}
    a, b = got["GSD:1"], got["GSD:2"]
    assert set(got) == {"GSD:1", "GSD:2"}
    assert (a["lbl"], a["gtc_id"], a["gsd_id"]) == ("alpha", ["G1", "G1", "G2", "G3"], "ID2")
    assert [(x["src_lbl"], x["src_uuid"]) for x in a["sources"]] == [("alpha", "SRC:a1"), ("alfa", "SRC:b1"), ("alpha", "SRC:c1")]
    assert (b["lbl"], b["gtc_id"], b["gsd_id"]) == ("beta", [], None)
    plain = {r["term_uuid"]: r["gsd_id"] for r in merge.merge_concepts(terms(spark)).collect()}
    assert plain == {"GSD:1": "ID2", "GSD:2": "ID3"}


def test_merge_counters(spark):
    got = {r["_source_rank"]: (r["skipped"], r["created"], r["updated"]) for r in merge.merge_counters(terms(spark)).collect()}
    assert got == {0: (1, 1, 0), 1: (0, 1, 1), 2: (0, 0, 1)}


def test_edge_merge(spark):
    rows = [("x", "p", "y", "first", 0, 1), ("x", "p", "y", "again", 0, 2), ("x", "p", "z", "[DISCARD]", 0, 3), ("x", "p", "y", "late", 1, 1), ("y", "p", "x", "rev", 1, 3)]
    edges = spark.createDataFrame(rows, "subj string, pred string, obj string, comment string, _source_rank int, _line long")
    comments = lambda df: [r["comment"] for r in df.orderBy("_source_rank", "_line").collect()]
    assert comments(merge.merge_edges(edges, compat=True)) == ["first", "again", "rev"]
    assert comments(merge.merge_edges(edges)) == ["first", "rev"]


def test_symmetric_adjacency(spark):
    nodes = spark.createDataFrame([("GSD:1", "a"), ("GSD:2", "b"), ("GSD:3", "c")], "term_uuid string, lbl string")
    pairs = [("1", "2", RELATED), ("2", "1", RELATED), ("3", "3", RELATED), ("1", "3", RELATED), ("1", "8", RELATED), ("2", "3", "other")]
    edges = spark.createDataFrame([(f"GSD:{a}", p, f"GSD:{b}", 0, i) for i, (a, b, p) in enumerate(pairs)], "subj string, pred string, obj string, _source_rank int, _line int")
    assert {r["term_uuid"]: r["related"] for r in graph.symmetric_adjacency(edges, nodes).collect()} == {"GSD:1": ["b", "c"], "GSD:2": ["a"], "GSD:3": ["c", "a"]}


def test_related_edges(spark):
    rows = [("a", "GSD:1", None, 1), ("b", "GSD:2", "a", 2), ("c", "GSD:3", "zzz", 3), ("d", "GSD:4", None, 4), ("a", "GSD:5", None, 5)]
    got = graph.related_edges(spark.createDataFrame(rows, "term string, term_uuid string, related string, _line int")).collect()
    assert {(r["subj"], r["obj"]) for r in got} == {("GSD:5", "GSD:2"), ("[PLACEHOLDER]", "GSD:3")}


def test_reconcile(spark):
    decisions = spark.createDataFrame([("a", "u1", 1), (" a ", "u2", 2), ("b", "u3", 3), ("", "u4", 4), ("c", "", 5)], "source_term string, mapped_to_uuid string, n int")
    originals = spark.createDataFrame([(" a",), ("b",), ("[DISCARD]",), ("",), ("d",)], "normalized_term string")
    got = {r["normalized_term"]: (r["term_uuid"], r["_status"]) for r in reconcile.reconciled(originals, decisions, F.col("n")).collect()}
    assert got == {" a": ("u2", "matched"), "b": ("u3", "matched"), "[DISCARD]": (None, "discarded"), "d": (None, "unmatched")}
    assert [r["term"] for r in reconcile.unmatched_originals(originals, decisions, F.col("n")).collect()] == ["d"]
    assert reconcile.unmatched_decisions(originals, decisions, F.col("n")).count() == 0
    with pytest.raises(reconcile.ReconcileFailed, match="d"):
        reconcile.require_reconciled(originals, decisions, F.col("n"))
    assert reconcile.require_reconciled(originals.where("normalized_term <> 'd'"), decisions, F.col("n")).count() == 3


def test_violations(spark):
    good = '{"term":"t","xref":"x","term_uuid":"GSD:%s","src_uuid":"SRC:%s"}'
    lines = [
        ("f", 1, good % (1, 1)), ("f", 2, "{broken"), ("f", 3, ""), ("f", 4, '{"term":"t","term_uuid":"GSD:7","src_uuid":"SRC:7"}'),
        ("f", 5, good.replace("GSD:", "") % (2, 2)), ("f", 6, good.replace("SRC:", "") % (3, 3)), ("f", 7, good % (1, 4)), ("g", 1, good % (1, 5)), ("g", 2, good % (8, 5)),
    ]
    df = spark.createDataFrame(lines, "_source string, _line long, _raw string")
    got = {(r["_source"], r["_line"], r["rule"]) for r in checks.term_violations(df).collect()}
    assert got == {
        ("f", 2, "malformed"), ("f", 3, "malformed"), ("f", 4, "missing key"), ("f", 5, "prefix of term_uuid"), ("f", 6, "prefix of src_uuid"),
        ("f", 1, "repeated term_uuid"), ("f", 7, "repeated term_uuid"), ("g", 1, "repeated src_uuid"), ("g", 2, "repeated src_uuid"),
    }
    with pytest.raises(checks.RecordsRejected, match="f:1"):
        checks.require_clean(checks.term_violations(df))
    checks.require_clean(checks.term_violations(df.where("_line = 1 and _source = 'f'")))
    edge = spark.createDataFrame([("f", 1, '{"subj":"[PLACEHOLDER]","pred":"p","obj":"GSD:1","xref":"","comment":""}')], "_source string, _line long, _raw string")
    assert [r["rule"] for r in checks.edge_violations(edge).collect()] == ["prefix of subj"]


def test_sentences_and_mentions(spark):
    t = F.lit("Core two is branched.  It carries fucose. Sialic caps end here")
    assert [(p["s"], p["e"]) for p in one(spark, text.sentence_spans(t))] == [(0, 22), (23, 42), (42, 62)]
    assert one(spark, text.mention_sentence(t, text.sentence_spans(t), F.lit(34), F.lit(40))) == "It carries fucose."
    rows = [("ab", 0, 2), ("Glycan", 0, 6), ("sialyltransferase", 0, 17), ("β1-4", 0, 4), ("core 1", 5, 5), ("core 2", 3, 9), ("  ", 0, 3), ("Lewis x", 0, 7)]
    df = spark.createDataFrame(rows, "term string, start_pos int, end_pos int")
    assert sorted(r["term"] for r in text.kept_mentions(df).collect()) == ["Lewis x", "core 2"]


def test_exclusions_as_they_are_fixed(spark):
    drop = ["MUC1", "GlycA", "M2BPGi", "α2-3 sialyl", "β1→4", "n-glycan", "gag", "vertebrate", "plant", "fungal", "nonreducing", "glycoform", "proteoglycan", "trisaccharide", "anti glycan", "β-galactosidases x glycosidase", "cross-linkage"]
    keep = ["index", "sugar", "chain", "human milk glycan", "selectin", "linkages", "GP1234", "c18:1", "b1-4"]
    df = spark.createDataFrame([(t, "0", "9") for t in drop + keep], "term string, start_pos string, end_pos string")
    assert sorted(r["term"] for r in text.kept_mentions(df).collect()) == sorted(keep)
    spans = spark.createDataFrame([("a term", s, e) for s, e in ((0, 0), (-1, 4), (3, 2), (None, 4), (2, 8))], "term string, start_pos int, end_pos int")
    assert text.kept_mentions(spans).count() == 1


def test_spans_of_a_long_text(spark):
    df = spark.range(1).select(F.repeat(F.lit("One more sentence. "), 100_000).alias("t"))
    got = df.select(text.sentence_spans(F.col("t")).alias("x")).select(F.size("x"), F.element_at("x", -1)["s"]).first()
    assert tuple(got) == (100_000, 99_999 * 19)


def test_alternates_and_remote_lookups():
    from conceptmerge.functions.providers import RemoteLookups

    calls = []

    def get(url):
        calls.append(url)
        if "gtcid2seqs" in url:
            return 200, [{"wurcs": "W/2 1"}] if url.endswith("G1") else []
        return (200, {"IUPACcondensed": "Gal", "id": None if "empty" in url else "G9"}) if "bad" not in url else (500, None)

    r = RemoteLookups(get, "https://example.org/")
    assert (r.sequence_of("G1"), r.sequence_of("G2")) == ("Gal", "") and calls[1].endswith("/W%2F2%201")
    assert (r.accession_of("Gal(b1-4)"), r.accession_of("empty"), r.accession_of_code("bad")) == ("G9", "No GlyTouCan ID found", "Error: 500")


def test_decisions_in_turn():
    store = retrieval.MutableStore(lambda t: [float("gal" in t.lower()), float("man" in t.lower()), 0.1], [("u1", "Gal")])
    choose = lambda term, found: found[0][0] if found and found[0][1] > 0.9 else None
    got = retrieval.decide_in_turn([("galactose", "n1"), ("mannose", "n2"), ("Man", "n3")], store, choose)
    assert got == [("galactose", "u1", "map"), ("mannose", "n2", "add"), ("Man", "n2", "map")] and store.held["u1"][1] == ["galactose"]


def test_batches_along_one_order(spark):
    """The parallel fold equals a plain loop, whatever the partitions."""
    import random

    draw = random.Random(2)
    terms = [draw.choice(["alpha", "alphb", "beta", "betx", None]) for _ in range(3000)]
    want, batch, n = [], -1, 0
    for i, t in enumerate(terms):
        before = terms[i - 1] if i else None
        like = t is not None and before is not None and t[:4] == before[:4]
        n, batch = (n + 1, batch) if n and (n < 5 or (like and n < 12)) else (1, batch + 1)
        want.append(batch)
    df = spark.createDataFrame(list(enumerate(terms)), "i int, t string")
    got = {r["i"]: r["batch"] for r in batching.adaptive_batches(df, None, ["i"], "t").collect()}
    assert [got[i] for i in range(3000)] == want


def test_lists_at_any_depth(spark):
    deep = "[" * 30 + '"x", {"a": [1, 2]}, 3.50' + "]" * 30
    assert one(spark, s.flatten_json_list(F.lit(deep))) == ["x", '{"a":[1,2]}', "3.50"]
    assert [one(spark, s.flatten_json_list(F.lit(x))) for x in ('["a",null,"b"]', "plain", "[broken [", "[]")] == [["a", "b"], ["plain"], ["[broken ["], []]


def test_chunks():
    t = "".join(f"Sentence number {i} is here. " for i in range(200))
    got = text.chunk_text(t)
    assert all(0 < len(c) <= 1000 for c in got) and got[0] + t[len(got[0]) :] == t
    assert all(c in t for c in got) and t.endswith(got[-1])
    covered = 0
    for c in got:
        at = t.find(c)
        assert covered - 200 <= at <= covered
        covered = max(covered, at + len(c))
    assert covered == len(t)
    assert text.chunk_text("") == [] and text.chunk_text("x" * 2500)[0] == "x" * 1000


def test_links_and_encoding(spark):
    assert one(spark, s.percent_encoded(F.lit("a b/c~-*(d)"))) == "a%20b/c~-%2A%28d%29"
    assert one(spark, s.percent_encoded(F.lit("a b/c"), keep_slash=False)) == "a%20b%2Fc"
    assert one(spark, s.deep_link(F.lit("b/"), F.lit("ch99"), F.lit("short text."))).endswith("ch99/#:~:text=short,text")
    assert one(spark, s.deep_link(F.lit("b/"), F.lit("ch99"), F.lit("nospace"))).endswith("text=nospace,nospace")
    assert one(spark, s.ustrip(F.lit(" a\n"))) == "a"


def test_scalars(spark):
    assert one(spark, s.ensure_prefix(F.lit("SRC:1"), "SRC:")) == "SRC:1"
    assert one(spark, s.unescape_breaks(F.lit("a\\nb"))) == "a\nb"
    raw = F.lit('{"a":null,"b":["x",""],"c":"y"}')
    assert one(spark, s.key_or_default(raw, "a")) is None and one(spark, s.key_or_default(raw, "z")) == "[ERROR]"
    assert one(spark, s.scalar_or_list(raw, "$.b")) == ["x"] and one(spark, s.scalar_or_list(raw, "$.c")) == ["y"] and one(spark, s.scalar_or_list(raw, "$.q")) == []
    assert one(spark, s.flatten_json_list(F.lit('[["x"],["y",["z"]]]'))) == ["x", "y", "z"]
    assert [(r["src"], r["content"]) for r in one(spark, s.content_list(F.lit('[{"src":"P"},"free text"]')))] == [("P", ""), ("", "free text")]
    assert one(spark, s.content_list(F.lit("text"))) is None
    fallback = F.struct(F.lit("none").alias("a"))
    assert one(spark, s.parsed_or(F.lit('```json\n{"a":"b"}\n```'), "a string", fallback))["a"] == "b"
    assert one(spark, s.parsed_or(F.lit("sorry"), "a string", fallback))["a"] == "none"
    assert one(spark, s.with_synonym(F.array(F.lit("a")), F.lit("a"))) == ["a"]
    zipped = one(spark, text.zipped(F.array(F.lit(1), F.lit(2), F.lit(3)), F.array(F.lit("a"), F.lit("b"))))
    assert [tuple(z) for z in zipped] == [(1, "a"), (2, "b")]


def test_batches_and_runs(spark):
    names = ["alpha", "beta", "core 1", "core 2", "Core 3", "core 4", "CORE 5", "delta", *[f"sialyl {i}" for i in range(20)]]
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate(names)], "p int, i int, t string")
    got = batching.adaptive_batches(df, "p", ["i"], "t").groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == [7, 12, 9]
    fixed = batching.fixed_batches(spark.range(12), ["id"], 5).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in fixed] == [5, 5, 2]
    assert [r["id"] for r in batching.line_slice(spark.range(20), ["id"], 3, 5).orderBy("id").collect()] == [2, 3, 4]
    keys = spark.createDataFrame([(0, i, k) for i, k in enumerate([None, "", "a", "a", "b", "a"])], "p int, i int, k string")
    runs = batching.runs(keys, ["p"], ["i"], "k").groupBy("run", "k").count().orderBy("run").collect()
    assert [(r["k"], r["count"]) for r in runs] == [("a", 2), ("b", 1), ("a", 1)]


def test_retrieval(spark):
    store = spark.createDataFrame([("s1", [1.0, 0.0]), ("s2", [1.0, 1.0]), ("s3", [0.0, 1.0]), ("s4", [-1.0, 0.0]), ("s5", [2.0, 0.0]), ("s0", [0.0, 0.0])], "id string, embedding array<float>")
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<float>")
    names = lambda k: [r["id"] for r in retrieval.top_k(asked, store, k).orderBy("rank").collect()]
    assert names(2) == ["s1", "s5"] and names(4) == ["s1", "s5", "s2"]
    assert retrieval.decide_one_by_one([("A", "n1"), ("a", "n2")], {}) == [("A", "n1", "add"), ("a", "n1", "map")]


def test_dictionary(spark):
    nodes = spark.createDataFrame([("GSD:1", "a", [("a", "SRC:A", "SRC:1"), ("b", "SRC:B", "SRC:2")])], "term_uuid string, lbl string, sources array<struct<src_lbl:string,src:string,src_uuid:string>>")
    edges = spark.createDataFrame([("GSD:1", RELATED, "GSD:1", 0, 1)], "subj string, pred string, obj string, _source_rank int, _line int")
    records = spark.createDataFrame([("SRC:1", ("late",), 1, 1), ("SRC:1", ("first",), 0, 9)], "src_uuid string, content struct<definition:string>, _source_rank int, _line int")
    sources = graph.assemble_dictionary(nodes, edges, records).first()["sources"]
    assert [x["src_uuid"] for x in sources] == ["SRC:1", "SRC:2"]
    assert sources[0]["src_content"]["record"]["definition"] == "first" and sources[1]["src_content"]["record"] is None
    assert sources[0]["src_content"]["related_synonyms"] == ["a"]


def test_providers(spark):
    df = spark.createDataFrame([(1, "The core structure and Core")], "i int, t string")
    got = providers.entities(df, "i", "t", ("core",)).collect()
    assert [(r["term"], r["start_pos"]) for r in got] == [("core", 4), ("Core", 23)]
    v = providers.embedded(df, "t").first()["embedding"]
    assert abs(sum(x * x for x in v) - 1) < 1e-5
    look = providers.Lookups({"G1": "WURCS"})
    assert providers.looked_up(spark.createDataFrame([("G1",), ("G2",)], "a string"), "a", "s", look.sequence_of).orderBy("a").collect()[0]["s"] == "WURCS"


@pytest.mark.parametrize("compat", [True, False])
def test_states_fold_in_any_order(spark, compat):
    rng = random.Random(2)
    rows = [
        (rng.choice("abc"), rng.choice(["x", "", "y"]), "s", rng.choice("pq"), [rng.choice(["1", "2", "3", "", None]) for _ in range(rng.randrange(4))], rng.choice([None, "", "g1", "g2"]), rng.randrange(3), i)
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "term_uuid string, term string, xref string, src_uuid string, gtc_id array<string>, gsd_id string, _source_rank int, _line int")
    nodes = lambda x: sorted(map(str, x.collect()))
    state = None
    for part in (3, 0, 2, 1):
        new = merge.concept_states(df.where(F.col("_line") % 4 == part))
        state = merge.folded_states(new if state is None else state.unionByName(new))
    assert nodes(merge.concepts_of(state, compat)) == nodes(merge.merge_concepts(df, compat))


def test_states_hold_an_id_once_and_keep_the_order_of_a_row(spark):
    schema = "term_uuid string, term string, xref string, src_uuid string, gtc_id array<string>, gsd_id string, _source_rank int, _line int"
    rows = [("u", "t", "s", "p", ["1", "1"] if i == 0 else ["z", "1", "a"], None, 0, i) for i in range(300)]
    df = spark.createDataFrame(rows, schema)
    states = merge.concept_states(df)
    for _ in range(3):
        assert [[tuple(x["ids"]) for x in r["lists"]] for r in states.collect()] == [[("1", "1"), ("z",), ("a",)]]
        assert merge.concepts_of(states).first()["gtc_id"] == ["1", "1", "z", "a"] and states.first()["n"] == 300
        states = merge.folded_states(states)
    # rows of one place lose nothing
    same = spark.createDataFrame([("u", "t", "s", "p", ["1"], None, 0, 7), ("u", "t", "s", "p", ["2"], None, 0, 7)], schema)
    assert merge.concepts_of(merge.concept_states(same)).first()["gtc_id"] == ["1", "2"]


def vectors(spark, n, dims=6, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    rows = [(i, (centres[i % 5] + 0.6 * rng.normal(size=dims)).tolist()) for i in range(n)]
    rows += [(n, rows[3][1]), (n + 1, [2 * x for x in rows[3][1]]), (n + 2, None), (n + 3, [0.0] * dims), (n + 4, []), (n + 5, [math.nan] * dims), (n + 6, [1.0, 2.0]), (n + 7, [2.0, 4.0]), (n + 8, [1.0, None])]
    return spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5), rows


def plain_cosine(a, b):
    if not a or not b or len(a) != len(b) or None in a or None in b:
        return None
    a, b = np.array(a), np.array(b)
    with np.errstate(all="ignore"):
        x = a @ b / np.sqrt((a @ a) * (b @ b))
    return round(float(x), 12) if np.isfinite(x) else None


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k_against_all_pairs(spark, block):
    df, rows = vectors(spark, 150)
    got = [tuple(r) for r in retrieval.top_k(df.withColumnRenamed("id", "query_id"), df, 4, 0.3, store_rows_a_block=block).orderBy("query_id", "rank").collect()]
    want = []
    for q, a in rows:
        scored = sorted((-s, i) for i, b in rows if (s := plain_cosine(a, b)) is not None and s >= 0.3)
        want += [(q, i, -s, k) for k, (s, i) in enumerate(scored[:4], 1)]
    assert [(q, i, k) for q, i, _, k in got] == [(q, i, k) for q, i, _, k in want] and np.allclose([x[2] for x in got], [x[2] for x in want])
    assert retrieval.top_k(df.limit(0).withColumnRenamed("id", "query_id"), df, 4).count() == 0 == retrieval.top_k(df.withColumnRenamed("id", "query_id"), df.limit(0), 4).count()


@pytest.mark.parametrize("prefix", [1, 9, 4096])
def test_decisions_in_order_against_a_loop(spark, prefix):
    df, rows = vectors(spark, 60)
    founders, want = [], []
    for i, v in rows:
        near = sorted((-s, f) for f, b in founders if (s := plain_cosine(v, b)) is not None and s >= 0.8)
        want.append((i, "map", near[0][1]) if near else (i, "add", i))
        if not near:
            founders.append((i, v))
    got = retrieval.decide_in_order(df, "id", ["id"], floor=0.8, prefix=prefix)
    assert sorted((r["id"], r["action"], r["concept_id"]) for r in got.collect()) == want
    assert retrieval.decide_in_order(df.limit(0), "id", ["id"]).count() == 0


def test_nearest_takes_few_vectors_at_a_time(spark, monkeypatch):
    df, rows = vectors(spark, 60)
    asked = df.withColumnRenamed("id", "query_id")
    whole = sorted(map(tuple, retrieval.top_k(asked, df, 4).collect()))
    decided = sorted(map(str, retrieval.decide_in_order(df, "id", ["id"], floor=0.8).collect()))
    kind = type(df)
    plain = kind.mapInArrow

    def watched(self, f, schema, *more):
        def run(batches):
            def seen():
                for b in batches:
                    if "asked" in b.schema.names and b.num_rows > 1:
                        raise AssertionError(f"{b.num_rows} pairs of blocks at once")
                    yield b

            return f(seen())

        return plain(self, run, schema, *more)

    monkeypatch.setattr(kind, "mapInArrow", watched)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, retrieval.top_k(asked, df, 4, store_rows_a_block=3).collect())) == whole
    monkeypatch.setattr(nearest, "ROWS", 3)
    monkeypatch.setattr(retrieval, "ROWS", 3)
    assert sorted(map(tuple, retrieval.top_k(asked, df, 4).collect())) == whole
    assert sorted(map(str, retrieval.decide_in_order(df, "id", ["id"], floor=0.8, prefix=9).collect())) == decided
    assert len(decided) == len(rows) and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


@pytest.mark.parametrize("width", [3, 2048])
def test_first_overlaps_against_all_pairs(spark, width):
    rng = random.Random(4)
    spans = [(d, a, a + rng.randrange(12)) for d in (1, 2, None) for a in range(0, 60, 5)]
    mentions = [(d, a, a + rng.randrange(9), "extra") for d in (1, 2, 3, None) for a in range(0, 70, 3)] + [(1, 5, 6, "again"), (1, 5, 6, "again"), (1, 9, 2, "bad"), (1, None, 3, "bad")]
    got = text.first_overlaps(spark.createDataFrame(mentions, "id int, start_pos int, end_pos int, s_ string"), spark.createDataFrame(spans, "id int, s int, e int"), width=width)
    want = []
    for d, a, b, x in mentions:
        hits = [(s, e) for i, s, e in spans if d is not None and i == d and a is not None and a <= b and s < e and s < b and e > a]
        want.append((d, a, b, x, *(min(hits) if hits else (None, None))))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_occurrences(spark):
    df = spark.createDataFrame([(1, "é the the the x"), (2, None), (3, "none"), (4, "a. the ")], "id int, text string")
    assert sorted(map(tuple, text.occurrences(df, "id", "text", " the ").collect())) == [(1, 1, 6), (1, 9, 14), (4, 2, 7)]


def test_spans_and_places_are_made_without_objects(spark):
    import pyarrow as pa

    texts = pa.array([None, "", "One. Two.\n Three", " ", "é. x."])
    got = text._span_lists(texts)
    assert got.to_pylist() == [None, [], [{"s": 0, "e": 5}, {"s": 5, "e": 10}, {"s": 11, "e": 16}], [{"s": 0, "e": 1}], [{"s": 0, "e": 3}, {"s": 3, "e": 5}]]
    assert isinstance(got, pa.ListArray) and text._span_lists(texts[1:]).to_pylist() == got.to_pylist()[1:] and text._span_lists(texts[:0]).to_pylist() == []
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts.to_pylist())], "i int, t string")
    assert [r["x"] and [tuple(p) for p in r["x"]] for r in df.orderBy("i").select(text.sentence_spans(F.col("t")).alias("x")).collect()] == [x and [(p["s"], p["e"]) for p in x] for x in got.to_pylist()]


class Flaky:
    def __init__(self, down):
        self.down, self.asked = down, {}

    def __call__(self, key):
        self.asked[key] = self.asked.get(key, 0) + 1
        if key == "bad" or self.asked[key] <= self.down.get(key, 0):
            raise OSError(key)
        return {"none": None}.get(key, key.upper())


def test_lookups_are_tried_again_and_failures_are_rows(spark):
    df = spark.createDataFrame([("a",), ("slow",), ("bad",), ("a",), (None,), ("none",)], "k string")
    got = providers.resolved(df, "k", lambda: Flaky({"slow": 2}), tries=3, wait=0.001, calls_a_second=1000, tasks=2)
    assert sorted(map(tuple, got.collect()), key=str) == [("a", "A", None, 1), ("bad", None, "OSError: bad", 3), ("none", None, None, 1), ("slow", "SLOW", None, 3)]

    def down():
        raise ConnectionError("down")

    assert {r["error"] for r in providers.resolved(df, "k", down, tries=2, wait=0.001).collect()} == {"ConnectionError: down"}


def test_counters_of_the_merges_own_pass(spark):
    nodes, counts = merge.merge_observed(terms(spark), 4)
    assert nodes.count() == merge.merge_concepts(terms(spark)).count()
    assert {r: tuple(x) for r, *x in counts.get()} == {0: (1, 1, 0), 1: (0, 1, 1), 2: (0, 0, 1)}


def plain_batches(terms):
    out, n, i = [], -1, 0
    while i < len(terms):
        n, size = n + 1, 0
        while i < len(terms) and size < 12 and (size < 5 or terms[i][:4].lower() == terms[i - 1][:4].lower()):
            out.append(n)
            size, i = size + 1, i + 1
    return out


@pytest.mark.parametrize("rows_a_batch", ["3", "10000"])
def test_adaptive_batches_carry_on_over_arrow_batches(spark, rows_a_batch):
    rng = random.Random(7)
    rows = sorted(f"{rng.choice(['alpha', 'Alph', 'beta', 'gamma', 'delta'])}{rng.randrange(10**6):06d}" for _ in range(300))
    df = spark.createDataFrame([(t, i % 3) for i, t in enumerate(rows)], "term string, p int").repartition(4)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, rows_a_batch)
    try:
        whole = [r["batch"] for r in batching.adaptive_batches(df, None, ["term"], "term").orderBy("term").collect()]
        parts = {r["term"]: r["batch"] for r in batching.adaptive_batches(df, "p", ["term"], "term").collect()}
        assert batching.adaptive_batches(df.limit(0), None, ["term"], "term").count() == 0 == batching.adaptive_batches(df.limit(0), "p", ["term"], "term").count()
    finally:
        spark.conf.set(setting, before)
    assert whole == plain_batches(rows)
    for p in range(3):
        mine = rows[p::3]
        assert [parts[t] for t in mine] == plain_batches(mine)


def test_nested_lists_of_any_depth_stay_in_the_engine(spark):
    deep = "[" * 300 + '"x"' + "]" * 300
    rows = [
        ('["x",["y",["z"]],"[1]"]', ["x", "y", "z", "[1]"]), ('[1.50,[1e5,-2.0E+3,7],[true,null,{"a":[1.50,"b]"]}]]', ["1.50", "1e5", "-2.0E+3", "7", "true", '{"a":[1.50,"b]"]}']), ("[[[[]]]]", []),
        ('[1.5"]', ['[1.5"]']), ('["a \\" 2.5, [", ["é"]]', ['a " 2.5, [', "é"]), (deep, ["x"]), ("plain 1.50", ["plain 1.50"]), (None, None), ("[]", []), ("  [1, 2]", ["1", "2"]), ("", [""]),
        ("[" + ",".join(["[1]"] * 2000) + "]", ["1"] * 2000),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string").select("i", s.flatten_json_list(F.col("t")).alias("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    got = {r["i"]: r["v"] for r in df.collect()}
    for i, (t, want) in enumerate(rows):
        assert got[i] == want, (t, got[i])
