import random
import re

from conceptmerge.llm import contamination

from .conftest import ODD


def words(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def shingles(w, k):
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = {}
    for i, t in items:
        w = words(t)
        if not w:
            continue
        k = min(5, len(w))
        q = shingles(w, k)
        for d, x in docs:
            n = len(q & shingles(words(x), k))
            if n * 5 >= len(q) * 4 and (d, i) not in out or n * 5 >= len(q) * 4 and n / len(q) > out[d, i][1] / out[d, i][0]:
                out[d, i] = (len(q), n)
    return out


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_equals_brute_force(spark, docs):
    rng = random.Random(9)
    items = [(i, " ".join(f"q{rng.randrange(300)}" for _ in range(rng.randrange(1, 60)))) for i in range(30)] + [(90, None), (91, ""), (92, "q1 q2"), (7, "again the same id here"), (None, "no id at all is here")]
    rows = list(ODD)
    for d in range(100, 180):
        w = [f"z{rng.randrange(5000)}" for _ in range(rng.randrange(400))]
        if d % 2:
            passage = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randrange(3)):
                if passage:
                    passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() + rng.choice(["", ",", "!"]) for x in passage]
        rows.append((d, " ".join(w)))
    got = {(r["doc_id"], r["item_id"]): (r["n_shingles"], r["n_shared"]) for r in contamination.contaminated(docs(rows), items_table(spark, items)).collect()}
    assert got == brute(rows, items) and len(got) >= 15


def test_removal(spark, docs):
    rows = [(1, "x one two three four five six y"), (2, "nothing here"), (None, "one two three four five six"), (3, None)]
    items = items_table(spark, [(1, "One two three four five six")])
    kept = contamination.decontaminated(docs(rows), items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3] and kept.columns == ["doc_id", "text", "mark", "score"]
    assert contamination.decontaminated(docs(rows), items_table(spark, [])).count() == 4
    assert contamination.contaminated(docs([]), items).count() == 0


def test_clean_rows_without_an_id_of_their_own_stay(spark):
    rows = [(None, "x one two three four five six y"), (None, "clean text"), (7, "one two three four five six"), (7, "another clean text"), (8, None)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, bad_id int")
    kept = contamination.decontaminated(docs, items_table(spark, [(1, "One two three four five six")]))
    assert kept.columns == docs.columns and sorted(r["text"] or "" for r in kept.collect()) == ["", "another clean text", "clean text"]


def test_size_partitions_lose_nothing(spark, docs):
    """Items of one to a few hundred shingles, each in a document that holds hardly more than it, and in a long one."""
    rng = random.Random(4)
    items = [(n, " ".join(f"i{n}w{rng.randrange(9000)}" for _ in range(n + 4))) for n in (1, 2, 3, 7, 8, 9, 31, 64, 300)]
    rows = [(n, t) for n, t in items] + [(1000 + n, "a b c d e " * 400 + t + " f g h" * 300) for n, t in items]
    got = {(r["doc_id"], r["item_id"]) for r in contamination.contaminated(docs(rows), items_table(spark, items)).collect()}
    assert got == {(k, n) for n, _ in items for k in (n, 1000 + n)}
