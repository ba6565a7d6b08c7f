import random
import re

import numpy as np
import pytest
import xxhash

from conceptmerge.llm import simhash
from conceptmerge.llm.components import component_labels

from .conftest import ODD


def slow_fingerprint(text, width=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute(prints, radius):
    up = list(range(len(prints)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprint():
    for t in ["", None, "A b", "Ä b C d e", "x " * 50, "one\x0btwo three  four five\nsix", "é à ü ñ ß " * 4]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_components_equal_brute_force(docs):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(400)}" for _ in range(120)] for _ in range(12)]
    rows = []
    for i in range(140):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(90)}"
        rows.append((i * 3, " ".join(words)))
    rows += ODD
    got = simhash.simhash_components(docs(rows)).collect()
    prints = [slow_fingerprint(t) for _, t in rows]
    group = brute(prints, 4)
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min(x for x in (least.get(g), i) if x is not None) if (i is not None or least.get(g) is not None) else None
    want = sorted(((i is None, i or 0), p, (least[g] is None, least[g] or 0)) for (i, _), p, g in zip(rows, prints, group))
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["fp"] % 2**64, (r["component_id"] is None, r["component_id"] or 0)) for r in got) == want


@pytest.mark.parametrize("bucket", [8, 4096])
def test_links_of_crowded_fingerprints(spark, bucket):
    """Fingerprints a few bits apart fill single buckets; with a small bound these are refined and then compared in blocks."""
    rng = np.random.default_rng(5)
    centre = [int(x) for x in rng.integers(0, 2**63, 4)]
    prints = sorted({c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for c in centre for _ in range(60)})
    nodes = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in prints], "fp long")
    links = simhash.near_links(nodes, 4, bucket=bucket, levels=1)
    roots = {r["node"] % 2**64: r["root"] for r in component_labels(links).collect()}
    want = brute(prints, 4)
    got = [roots.get(p, p) for p in prints]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_thresholds_cover_the_radius():
    together = np.full((64, 64), 250)
    np.fill_diagonal(together, 500)
    for radius in (0, 3, 4, 7):
        parts = simhash.plan(1000, together, radius)
        assert sum(t + 1 for _, t in parts) == radius + 1
        assert len({b for g, _ in parts for b in g}) == sum(len(g) for g, _ in parts)


def test_components_of_chains_and_stars(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (None, 3), (7000, 7001), (7001, 7000)]
    roots = {}
    for r in component_labels(spark.createDataFrame(rows, "a long, b long")).collect():
        roots.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, roots.values())) == [2, 200, 301]
    assert component_labels(spark.createDataFrame([], "a long, b long")).count() == 0


def test_removal(docs):
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, (r["text"] or "")[:12]) for r in simhash.near_duplicates_removed(docs(ODD)).collect())
    assert (False, 1, "") in kept and not any(k[1] in (2, 3, 8) for k in kept)
    assert [k for k in kept if k[1] == 7] == [(False, 7, "another text"), (False, 7, "same words h")]
    assert simhash.near_duplicates_removed(docs([])).count() == 0
    assert simhash.near_duplicates_removed(docs(ODD)).columns == ["doc_id", "text", "mark", "score"]


@pytest.mark.parametrize("bucket", [8, 4096])
@pytest.mark.parametrize("chosen", [[0, 1, 1], [2, 1], [1, -1, 1, 0]])
def test_unequal_thresholds_lose_nothing(spark, monkeypatch, chosen, bucket):
    """Plans that only very many fingerprints get: parts with thresholds of their own, probed with flipped bits."""
    rng = np.random.default_rng(len(chosen))
    centre = [int(x) for x in rng.integers(0, 2**63, 6)]
    prints = sorted({c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for c in centre for _ in range(40)})

    def forced(n, together, radius):
        return [(g, t) for g, t in zip(simhash.correlated_parts(n, together, len(chosen)), chosen) if t >= 0]

    monkeypatch.setattr(simhash, "plan", forced)
    nodes = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in prints], "fp long")
    roots = {r["node"] % 2**64: r["root"] for r in component_labels(simhash.near_links(nodes, 4, bucket=bucket, levels=1)).collect()}
    got, want = [roots.get(p, p) for p in prints], brute(prints, 4)
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))
