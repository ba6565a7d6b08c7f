import os
from collections import defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conceptmerge.llm import packing, queries

from .test_contamination import brute as leaks
from .test_nearcopies import brute as near_copies

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def test_registry():
    names = entry.queries()
    assert [n for n in range(1, 11) if not any(x.startswith(f"op{n}_") for x in names)] == [] and "pipeline" in names


def test_stages_in_turn(spark, tmp_path):
    """Each stage on what the one before kept, against a plain version of the rule."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
        old = {r["doc_id"]: r["text"] for r in before.collect()}
        new = {r["doc_id"]: r["text"] for r in docs.collect()} if k < 4 else {}
        if k == 0:
            judged = [(labels[i] == 1) == (i in new) for i in old if i in labels]
            assert sum(judged) >= 0.97 * len(judged)
        elif k == 1:
            ids = sorted(old)
            least = {}
            for i, g in zip(ids, near_copies([old[i] for i in ids])):
                least.setdefault(g, i)
            assert sorted(new) == sorted(least.values())
        elif k == 2:
            assert set(old) - set(new) == {d for d, _ in leaks(list(old.items()), items)}
        elif k == 3:
            assert set(new) == set(old) and any(new[i] != old[i] for i in old)
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        else:
            ids = {i: packing.encoder(queries.tokenizer_path()).encode(t) for i, t in old.items()}
            tokens = defaultdict(int)
            for r in docs.collect():
                tokens[r["doc_id"]] += r["length"]
            assert dict(tokens) == {i: len(b) // 4 + 1 for i, b in ids.items()}
