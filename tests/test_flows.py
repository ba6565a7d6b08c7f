"""The whole flows on small files and tables."""

import json

import pytest
from pyspark.sql import functions as F

from conceptmerge.operators.checks import RecordsRejected
from conceptmerge.plans import flows


def put(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")


def term(n, uuid, src, **meta):
    return {"term": n, "xref": "SRC:X", "term_uuid": f"GSD:{uuid}", "src_uuid": f"SRC:{src}", "metadata": meta}


def edge(a, b, comment="c"):
    return {"subj": f"GSD:{a}", "pred": "has_related_synonym", "obj": f"GSD:{b}", "xref": "", "comment": comment}


def test_consolidation(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    put(raw / "src_one" / "terms.jsonl", term("alpha", 1, "a", gtc_id="G1", exact_synonyms=[["x"], ["y"]]), term("beta", 2, "b"))
    put(raw / "src_two" / "terms.jsonl", term("alfa", 1, "c", gsd_id="ID", function=[{"src": "P"}, "free"]))
    put(raw / "src_two" / "archive" / "terms.jsonl", term("old", 9, "z"))
    put(raw / "src_two" / "edges.jsonl", edge(1, 2), edge(1, 2), edge(2, 1, "[DISCARD]"))
    made = flows.consolidated(spark, str(raw), ["one", "two"])
    out.mkdir()
    (out / "master_old.json").write_text("[]")
    paths = flows.write_catalogue(spark, made, str(out), when="_t")
    assert (out / "backup" / "backup_t" / "master_old.json").exists()
    read = lambda k: json.loads(spark.read.text(paths[k], wholetext=True).first()[0])
    nodes, edges, whole = read("master_nodes"), read("master_edges"), read("dictionary")
    assert [(n["lbl"], n["gtc_id"], [x["src_uuid"] for x in n["sources"]]) for n in nodes] == [("alpha", ["G1"], ["SRC:a", "SRC:c"]), ("beta", [], ["SRC:b"])]
    assert nodes[0]["gsd_id"] == "ID" and "gsd_id" not in nodes[1]
    assert edges == [{"subj": "GSD:1", "pred": "has_related_synonym", "obj": "GSD:2", "comment": "c"}]
    first = whole["nodes"][0]
    record = first["sources"][0]["src_content"]["record"]
    assert record["exact_synonyms"] == ["x", "y"] and record["definition"] is None and first["sources"][0]["src_content"]["related_synonyms"] == ["beta"]
    assert first["sources"][1]["src_content"]["record"]["function"] == [{"src": "P", "content": ""}, {"src": "", "content": "free"}]
    put(raw / "src_one" / "terms.jsonl", {"term": "t"})
    with pytest.raises(RecordsRejected, match="missing key"):
        flows.consolidated(spark, str(raw), ["one", "two"])


def test_matching(spark):
    concepts = spark.createDataFrame([("GSD:1", "alpha", ["a one"], "first"), ("GSD:2", "beta", [], "")], "id string, term string, synonyms array<string>, description string")
    originals = spark.createDataFrame([("Alpha ",), ("gamma",), ("[DISCARD]",)], "normalized_term string")
    decisions, rows, store = flows.matched(originals, concepts)
    assert {(r["source_term"], r["action"]) for r in decisions.collect()} == {("Alpha", "map"), ("gamma", "add")}
    assert all(r["term_uuid"] is None or r["term_uuid"].startswith("GSD:") for r in rows.collect()) and rows.count() == 3
    assert store.count() == 3 and store.where("id = 'GSD:1'").first()["synonyms"] == ["a one", "Alpha"]
    near = flows.candidates(spark.createDataFrame([("alpha a one first",)], "term string"), flows.indexed(concepts), floor=0.0).orderBy("rank").first()
    assert near["id"] == "GSD:1"


def test_extraction(spark):
    texts = spark.createDataFrame([("ch1", "The lewis x antigen is old. A Lewis X epitope and core fucose are parts of an N-linked type. Glycan is generic.")], "document_id string, text string")
    mentions = flows.extracted(texts, ("Lewis x", "core fucose", "glycan"))
    assert sorted(r["term"] for r in mentions.collect()) == ["Lewis X", "core fucose", "lewis x"]
    got = {r["glycan_term"]: r for r in flows.summarized(mentions).collect()}
    assert got["lewis x"]["exact_synonyms"] == ["Lewis X"] and got["lewis x"]["original_terms"] == [["Lewis X"], ["lewis x"]] and set(got) == {"lewis x", "core fucose"}
    assert got["core fucose"]["classification"] == "N-Linked Type" and got["core fucose"]["error"] is None


def test_a_provider_that_fails_is_told_from_one_that_answers_nonsense(spark):
    texts = spark.createDataFrame([("ch1", "The lewis x antigen is old. Core fucose is older.")], "document_id string, text string")
    mentions = flows.extracted(texts, ("Lewis x", "core fucose"))

    def summarize(term, originals, descriptions):
        if term == "lewis x":
            raise TimeoutError("no answer")
        return "nonsense"

    got = {r["glycan_term"]: (r["classification"], r["description"], r["exact_synonyms"], r["error"]) for r in flows.summarized(mentions, summarize=summarize).collect()}
    assert got == {"lewis x": ("Others", "ERROR", [], "TimeoutError: no answer"), "core fucose": ("Others", "ERROR", [], None)}


def test_terms_are_batched_along_one_order(spark):
    """Batches go over the first letter of a term: eleven terms are batches of five, five and one, not of their letters."""
    names = tuple(f"{c}{c}{c}{c} term" for c in "abcdefghijk")
    texts = spark.createDataFrame([("ch1", ". ".join(names) + ".")], "document_id string, text string")

    def normalize(terms):
        return "\n".join(json.dumps({"normalized_term": f"{len(terms)} of {terms[0]}", "original_terms": terms}) for _ in [0])

    got = sorted(r["glycan_term"] for r in flows.summarized(flows.extracted(texts, names), normalize=normalize).collect())
    assert got == ["1 of kkkk term", "5 of aaaa term", "5 of ffff term"]
