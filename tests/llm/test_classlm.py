import collections
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from conceptmerge.llm import classlm

from .conftest import ODD

TEXTS = [(i, f"The cat{i % 5} sat on the mat{i % 3}. A dog{i} ran to the park{i % 4} and the cat{(i + 1) % 5} slept.") for i in range(60)]


def held(c="doc_id"):
    return F.crc32(F.col(c).cast("string")) % 7 == 2


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + [""]


def test_counts_and_base(docs):
    rows = TEXTS + ODD
    small = {"exchanged": 8, "groups": 5, "direct": 12, "classes": 6}
    got = classlm.document_scores(docs(rows), held(), **small).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter(w for i, t in rows if not out(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), out(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 5)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    unseen = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_every_word_has_a_class_and_emissions_sum_to_one(spark, docs):
    texts = docs(TEXTS).select("doc_id", "text")
    held, rest = classlm.learned(texts, classes=6, exchanged=8, groups=5, direct=12)
    counts = collections.Counter(w for _, t in TEXTS for w in words(t))
    table = {r["word"]: (r["c"], r["cls"]) for r in rest.collect()}
    near = {w.decode(): (int(held.counts[i]), int(held.class_of[i])) for w, i in held.place.items()}
    assert {w: c for w, (c, _) in (table | near).items()} == counts and len(near) == 13
    assert all(table[w] == near[w] for w in set(table) & set(near)) and len(table) == len(counts) - 8
    total = np.zeros(6)
    for w, (c, k) in (table | near).items():
        total[k] += (c - (held.discount if w else 0)) / held.mass[k]
    assert np.allclose(total[held.mass > 0], 1) and (held.n, held.v) == (sum(counts.values()), len(counts))


def test_score_equals_a_plain_model(spark, docs):
    """Transitions and emissions counted anew from the learned classes, in plain loops."""
    rows = TEXTS + ODD
    small = {"exchanged": 8, "groups": 5, "direct": 12, "classes": 6}
    table = docs(rows)
    inside = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    model, rest = classlm.learned(table.where(~F.coalesce(held(), F.lit(False))).select("doc_id", "text"), **small)
    cls = {r["word"]: r["cls"] for r in rest.collect()} | {w.decode(): int(model.class_of[i]) for w, i in model.place.items()}
    name = lambda w: classlm.tokens(w)[0].decode() if w else ""
    seen = collections.Counter(name(w) for i, t in rows if inside(i) for w in words(t))
    d, unk = model.discount, 6
    kinds = lambda w: [(0, 1.0)] if not w else [(cls[w], 1 - d / seen[w]), (unk, d / seen[w])]
    big = np.zeros((7, 7))
    for i, t in rows:
        if inside(i):
            got = [name(w) for w in words(t)]
            for x, y in zip(["", *got], got):
                for a, p in kinds(x):
                    for b, q in kinds(y):
                        big[a, b] += p * q
    share = (big.sum(0) + 1) / (big.sum() + 7)
    step = (big + 10 * share) / (big.sum(1, keepdims=True) + 10)
    assert np.allclose(step.sum(1), 1)
    mass = collections.Counter()
    for w, c in seen.items():
        mass[cls[w]] += c - (d if w else 0)

    def score(t):
        out, k = 0.0, 0
        for w in map(name, words(t)):
            now = cls[w] if w in seen else unk
            out += math.log10(step[k, now]) + (math.log10((seen[w] - (d if w else 0)) / mass[now]) if w in seen else 0.0)
            k = now
        return out

    want = sorted((str(i), round(score(t), 5)) for i, t in rows)
    assert sorted((str(r["doc_id"]), round(r["score"], 5)) for r in classlm.document_scores(table, held(), **small).collect()) == want


def test_exchange_finds_classes():
    """Words of two kinds that always alternate end up in two classes."""
    rng = np.random.default_rng(1)
    n = 21
    big = np.zeros((n, n))
    for _ in range(4000):
        a, b = 1 + rng.integers(10), 11 + rng.integers(10)
        big[a, b] += 1
        big[b, 1 + rng.integers(10)] += 1
    of = classlm.exchange(big, 3)
    assert len(set(of[1:11])) == 1 and len(set(of[11:])) == 1 and of[1] != of[11]


def test_no_training(docs):
    assert classlm.document_scores(docs([]), held()).count() == 0
    only = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = classlm.document_scores(docs([(i, "a b") for i in only]), held()).collect()
    assert [(r["n_known"], r["train_tokens"], r["n_tokens"]) for r in got] == [(0, 0, 3)] * 3


def test_places_of_words():
    got = classlm._places({b"": 0, b"a": 7}, [b"a", b"x", b"", b"a"], 65535, np.uint16)
    assert got.dtype == np.uint16 and got.tolist() == [7, 65535, 0, 7] and len(classlm._places({}, [], -1, np.int64)) == 0
