"""Scans, sinks and streams over small files."""

import json

import pytest
from pyspark.sql import functions as F

from conceptmerge.sources import readers, writers
from conceptmerge.streaming import upsert


def lines(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(rows) + "\n", encoding="utf-8")
    return str(path)


def test_scan_modes(spark, tmp_path):
    p = lines(tmp_path / "terms.jsonl", "# note", '{"term":"a"}', "", "{bad", '{"term":"é"}')
    read = lambda mode, **how: readers.read_jsonl(spark, p, "term string", mode, **how)
    assert [(r["term"], r["_line"]) for r in read("permissive").orderBy("_line").collect()] == [("a", 2), ("é", 5)]
    assert read("checked").count() == 5
    with pytest.raises(Exception, match="malformed line"):
        read("strict", comments=True).collect()
    q = lines(tmp_path / "b.jsonl", '{"term":"a"}', "")
    assert readers.read_jsonl(spark, q, "term string", "strict").count() == 1
    with pytest.raises(Exception, match="malformed line"):
        readers.read_jsonl(spark, q, "term string", "raising").collect()
    assert readers.read_large_jsonl(spark, q, "term string").count() == 1


def test_queue(spark, tmp_path):
    for rel in ("src_b/terms.jsonl", "src_a/terms.jsonl", "src_a/archive/terms.jsonl", "src_a/edges.jsonl", "other/terms.jsonl"):
        lines(tmp_path / rel, "{}")
    terms, edges = readers.processing_queue(spark, str(tmp_path), ["a", "b"])
    assert [t.split("/")[-2] for t in terms] == ["src_a", "src_b"] and len(edges) == 1


def test_documents(spark, tmp_path):
    assert readers.read_json_array(spark, str(tmp_path / "none.json"), "a int").count() == 0
    (tmp_path / "e.json").write_text("")
    assert readers.read_json_array(spark, str(tmp_path / "e.json"), "a int").count() == 0
    (tmp_path / "l.json").write_text('[{"a":1},\n{"a":2}]')
    assert [r["a"] for r in readers.read_json_array(spark, str(tmp_path / "l.json"), "a int").orderBy("_at").collect()] == [1, 2]
    (tmp_path / "ch1.txt").write_text("one\ntwo")
    assert readers.read_texts(spark, str(tmp_path)).first()["document_id"] == "ch1"
    with pytest.raises(FileNotFoundError):
        readers.read_texts(spark, str(tmp_path), "zz*.txt")
    (tmp_path / "t.tsv").write_text("#label\tid\nx\t1\n")
    assert readers.read_tsv(spark, str(tmp_path / "t.tsv")).columns == ["label", "id"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, None, "é"), (1, "x", "b")], "i int, n string, t string")
    doc = writers.array_document(df, ["i"]).first()["value"]
    assert json.loads(doc) == [{"i": 1, "n": "x", "t": "b"}, {"i": 2, "t": "é"}]
    whole = json.loads(writers.dictionary_document(df, df.where("i > 5"), ["i"], ["i"]).first()["value"])
    assert whole["nodes"][1] == {"i": 2, "n": None, "t": "é"} and whole["edges"] == []
    out = str(tmp_path / "o")
    writers.write_jsonl(df, out)
    writers.write_jsonl(df, out, append=True)
    assert spark.read.json(out).count() == 4
    (tmp_path / "m" / "x").mkdir(parents=True)
    (tmp_path / "m" / "master.json").write_text("[]")
    moved = writers.backed_up(spark, str(tmp_path / "m"), when="_1")
    assert len(moved) == 1 and (tmp_path / "m" / "backup" / "backup_1" / "master.json").exists()
    assert writers.backed_up(spark, str(tmp_path / "m")) == []


def test_stream_equals_batch(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id", (F.col("id") * 2).alias("v"))
    df.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    table = upsert.latest_table(spark, str(tmp_path / "state"), ["k"], ["id"], buckets=4)
    upsert.upsert_stream(stream, table, str(tmp_path / "progress")).awaitTermination()
    assert table.versions()[-1] >= 4
    assert sorted(map(tuple, table.read().select("k", "id", "v").collect())) == sorted(map(tuple, upsert.latest(df, ["k"], ["id"]).select("k", "id", "v").collect()))


def test_a_batch_rewrites_its_buckets_alone(spark, tmp_path):
    table = upsert.latest_table(spark, str(tmp_path / "t"), ["k"], ["o"], buckets=8)
    rows = lambda *x: spark.createDataFrame(list(x), "k string, o int, v string")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert len(table.merge(rows(*[(f"k{i}", 1, "old") for i in range(50)], (None, 1, "none")), 0)) == 8
    before = table.manifest(0)["places"]
    touched = table.merge(rows(("k1", 2, "new"), ("k1", 0, "late")), 1)
    after = table.manifest(1)["places"]
    assert len(touched) == 1 and {b for b in after if after[b] != before[b]} == {str(touched[0])}
    state = {r["k"]: r["v"] for r in table.read().collect()}
    assert len(state) == 51 and state["k1"] == "new" and state["k2"] == "old" and state[None] == "none"
    assert table.merge(rows(("k2", 9, "replayed")), 1) == [] and {r["k"]: r["v"] for r in table.read().collect()} == state
    assert {r["k"]: r["v"] for r in table.read(0).collect()}["k1"] == "old"
    assert table.merge(rows(), 2) == [] and table.versions() == [1, 2] and table.read().count() == 51
    with pytest.raises(ValueError, match="hash_bucket"):
        table.merge(rows().withColumn("Hash_Bucket", F.lit(1)), 3)


def test_failed_and_old_attempts_go(spark, tmp_path):
    table = upsert.latest_table(spark, str(tmp_path / "t"), ["k"], ["o"], buckets=2)
    for n in range(5):
        table.merge(spark.createDataFrame([(i, n) for i in range(10)], "k int, o int"), n)
        lost = tmp_path / "t" / "data" / f"{n}-lost" / "hash_bucket=0"
        lost.mkdir(parents=True)
    table.merge(spark.createDataFrame([(1, 9)], "k int, o int"), 7)
    used = {p for v in table.versions() for p in table.manifest(v)["places"].values()}
    assert {f"data/{p.parent.name}/{p.name}" for p in (tmp_path / "t" / "data").glob("*/hash_bucket=*")} == used and table.versions() == [4, 7]
    assert sorted(map(tuple, table.read().collect())) == sorted([(i, 4) for i in range(10) if i != 1] + [(1, 9)])


def test_line_numbers_without_a_shuffle_of_lines(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    a = lines(tmp_path / "a b.txt", *[f"a{i}" for i in range(3000)])
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "many").mkdir()
    for k in range(5):
        lines(tmp_path / "many" / f"{k}.txt", *[f"{k}-{i}" for i in range(40)], "")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    try:
        paths = [str(tmp_path / "many"), a, str(tmp_path / "empty.txt")]
        df = readers.numbered_lines(spark, paths)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any("Exchange" in p and "value#" in p for p in plan.split("\n")), plan
        got = [tuple(r) for r in df.orderBy("_source_rank", "_raw", "_line").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(paths[0], 0, i + 1, f"{k}-{i}") for k in range(5) for i in range(40)] + [(paths[0], 0, 41, "")] * 5 + [(a, 1, i + 1, f"a{i}") for i in range(3000)]
    assert sorted(got) == sorted(want)
    twice = readers.numbered_lines(spark, [a, str(tmp_path / "*.txt"), a]).groupBy("_source_rank").count().collect()
    assert {r["_source_rank"]: r["count"] for r in twice} == {0: 3000, 1: 3000, 2: 3000}
    assert readers.numbered_lines(spark, []).count() == 0


def test_texts_have_ranks_of_sorted_names(spark, tmp_path):
    for name in ("ch10.txt", "ch2.txt", "ch1 b.txt", "no.txt"):
        (tmp_path / name).write_text(name)
    assert [(r["_rank"], r["document_id"], r["text"]) for r in readers.read_texts(spark, str(tmp_path)).orderBy("_rank").collect()] == [(0, "ch1 b", "ch1 b.txt"), (1, "ch10", "ch10.txt"), (2, "ch2", "ch2.txt")]


@pytest.mark.parametrize("keep_nulls", [True, False])
def test_ordered_parts_are_the_small_document(spark, tmp_path, keep_nulls):
    df = spark.range(5000).selectExpr("id % 700 as _o", "if(id % 3 = 0, null, id) as a", "concat('é\\n', id) as t", "array(id) as l").repartition(7)
    small = writers.array_document(df, ["_o"], keep_nulls).first()["value"]
    path = str(tmp_path / "d.json")
    for rows, want in ((df, small), (df.limit(0), "[]"), (df.where("t = 'é\n7'"), None)):
        writers.write_ordered(spark, path, (rows, ["_o"]), keep_nulls=keep_nulls)
        got = (tmp_path / "d.json").read_text()
        assert got == (want or writers.array_document(rows, ["_o"], keep_nulls).first()["value"])
    writers.write_ordered(spark, path, '{"nodes":', (df, ["_o"]), ',"edges":', (df.limit(0), ["_o"]), "}", keep_nulls=keep_nulls)
    assert (tmp_path / "d.json").read_text() == '{"nodes":' + small + ',"edges":[]}'
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["d.json"]


def test_a_batch_is_appended_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    log = str(tmp_path / "log")
    assert readers_of(spark, log) == []
    assert writers.append_batch(df, log, 0) and not writers.append_batch(df, log, 0) and writers.append_batch(df.limit(1), log, "x-1")
    df.write.parquet(f"{log}/rows/7-lost")
    assert readers_of(spark, log) == [(1, "a", "0"), (1, "a", "x-1"), (2, "b", "0")]


def readers_of(spark, log):
    return sorted(map(tuple, writers.read_log(spark, log, "k int, v string").collect()))
