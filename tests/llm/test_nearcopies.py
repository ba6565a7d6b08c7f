import itertools
import random

import corpus_pipeline
from conceptmerge.llm import nearcopies

from .conftest import ODD


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(texts, least=0.8, width=5):
    """The least position of each text's component."""
    sets = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        sets.append({" ".join(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set())
    group = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if jaccard(sets[i], sets[j]) >= least and group[i] != group[j]:
            low, high = sorted((group[i], group[j]))
            group = [low if g == high else g for g in group]
    return group


def altered(words, edits, draw):
    words = list(words)
    for i in draw.sample(range(len(words)), edits):
        words[i] = f"new{draw.randrange(10**9)}"
    return " ".join(words)


def corpus():
    """Copies with 0 to 12 of 200 words changed: similarities on both sides of 0.8."""
    draw = random.Random(3)
    out = []
    for _ in range(40):
        words = [f"w{draw.randrange(5000)}" for _ in range(200)]
        out += [altered(words, e, draw) for e in (0, 2, 4, 5, 6, 8, 12)]
    return out


def test_the_stage_links_by_jaccard_not_by_bits(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r["doc_id"] for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect())
    assert got == sorted(set(brute(texts)))


def test_large_buckets_lose_nothing(spark):
    """Stars first, then what is not connected pair by pair."""
    draw = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = [altered(base, draw.choice((1, 3, 5, 6)), draw) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = nearcopies.with_bands(docs, "doc_id", "text", 5)
    sets = nearcopies._hashed(marks.select("node", "doc_id").join(docs, "doc_id").select("node", "text"), 5)
    bands = marks.selectExpr("explode(keys) AS key", "node", "n")
    links = nearcopies.near_copy_links(bands, sets, 0.8, few=4, most=1, rounds=2)
    node = {r["doc_id"]: r["node"] for r in marks.collect()}
    up = {n: n for n in node.values()}
    for a, b in links.collect():
        up = {n: up[a] if u == up[b] else u for n, u in up.items()}
    group = brute(texts)
    assert len(set(up.values())) == len(set(group))
    assert all((up[node[i]] == up[node[j]]) == (group[i] == group[j]) for i, j in itertools.combinations(range(150), 2))


def test_odd_rows(spark, docs):
    rows = docs(ODD)
    got = nearcopies.near_copies_removed(rows)
    assert got.columns == rows.columns
    kept = [r["doc_id"] for r in got.collect()]
    assert sorted(x for x in kept if x is not None) == [1, 4, 5, 6, 7, 7] and kept.count(None) == 1
    assert nearcopies.near_copies_removed(docs([])).count() == 0


def test_clashing_column_names(spark):
    docs = spark.createDataFrame([(1, "one two three four five six", 1, 2, 3), (2, "one two three four five six", 4, 5, 6)], "doc_id long, text string, keep_id int, _a int, mark int")
    got = nearcopies.near_copies_removed(docs)
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == [(1, "one two three four five six", 1, 2, 3)]
