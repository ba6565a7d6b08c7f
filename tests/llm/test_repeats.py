import hashlib
import random
import re

import pytest

from conceptmerge.llm.repeats import PhraseAutomaton, passages_removed

from .conftest import ODD


def brute(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    rank = [float("inf") if i is None else i for i, _ in rows]
    first = {}
    for r, w in sorted(zip(rank, words), key=lambda x: x[0]):
        for j in range(len(w) - width + 1):
            first.setdefault(tuple(w[j : j + width]), r)
    out = []
    for r, w, (i, _) in zip(rank, words, rows):
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < r:
                gone[j : j + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((-1 if i is None else i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


@pytest.mark.parametrize("width,limits", [(13, {}), (13, {"phrases_a_shard": 3, "pieces_a_task": 4}), (13, {"phrases_a_shard": 50, "pieces_a_task": 9, "phrases_a_machine": 7}), (6, {"phrases_a_shard": 10_000})])
def test_equals_brute_force(docs, width, limits):
    rng = random.Random(width)
    shared = [[f"s{rng.randrange(50)}" for _ in range(rng.randrange(10, 70))] for _ in range(8)]
    rows = []
    for i in range(60):
        words = [f"u{i}x{rng.randrange(9999)}" for _ in range(rng.randrange(30))]
        for p in rng.sample(shared, 2):
            cut = rng.randrange(len(p))
            at = rng.randrange(len(words) + 1)
            words[at:at] = p[cut:] if rng.random() < 0.5 else p
        rows.append((rng.randrange(500), rng.choice([" ", "\n", "  "]).join(words)))
    rows += ODD + [(900, "la " * 40), (901, "la " * 20), (902, "é ü ñ " * 9), (903, "é ü ñ " * 7)]
    assert result(passages_removed(docs(rows), width=width, **limits)) == brute(rows, width)


def test_one_anchor_in_every_document(docs):
    """One line in all texts, with neighbours that some of them share: all phrases have one anchor."""
    rng = random.Random(8)
    line = "the same line of words stands in every text".split()
    rows = [(i, " ".join([f"a{rng.randrange(9)}" for _ in range(6)] + line + [f"b{rng.randrange(9)}" for _ in range(6)])) for i in range(80)]
    rows += [(i, " ".join([f"a{i % 7}"] * 6 + line + [f"b{i % 5}"] * 6)) for i in range(80, 160)]
    assert result(passages_removed(docs(rows).repartition(3), phrases_a_shard=10_000, phrases_a_machine=5, pieces_a_task=40)) == brute(rows, 13)


def test_all_ids_are_null(docs):
    rng = random.Random(9)
    rows = [(None, " ".join(f"w{rng.randrange(6)}" for _ in range(60))) for _ in range(40)] + [(None, "same " * 30)] * 20
    rows += [(3, rows[0][1]), (4, "same " * 15), (4, "same " * 15)]
    assert result(passages_removed(docs(rows))) == brute(rows, 13)


def test_no_rows(docs):
    assert passages_removed(docs([])).count() == 0


def test_automaton():
    a = PhraseAutomaton(2)
    a.add("x y z", [5, 7])
    a.ready()
    assert a.matches("q x y z x y") == [(1, 3, 5), (2, 4, 7), (4, 6, 5)]
    assert PhraseAutomaton(2).ready().matches("x y") == []
