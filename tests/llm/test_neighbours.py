import numpy as np
import pytest

from conceptmerge.llm.neighbours import linked_vectors, planted

KIND = "vec_id long, embedding array<float>, label int, node string"


def brute(rows, floor):
    sound = []
    for k, (_, v, label, _) in enumerate(rows):
        x = np.array([np.nan if a is None else a for a in (v or [])], dtype=np.float32).astype(np.float64)
        if label is not None and len(x) == 16 and np.isfinite(x).all() and x.any():
            sound.append((k, x / np.linalg.norm(x), label))
    near = {k: set() for k in range(len(rows))}
    for i, (a, x, p) in enumerate(sound):
        for b, y, q in sound[:i]:
            if p == q and x @ y >= floor:
                near[a].add(b)
                near[b].add(a)
    out = []
    for k, (vec_id, *_) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((vec_id, len(near[k]), min(ids) if ids else None, bool(ids) and vec_id == min(ids)))
    return sorted(out, key=str)


def table(seed, n=400):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, 16))
    rows = []
    for i in range(n):
        v = base[rng.integers(12)] + rng.standard_normal(16) * rng.choice([0.05, 0.2, 2.0])
        rows.append((int(i * 3 % 997), [float(x) for x in v.astype(np.float32)], int(rng.integers(3)), "x"))
    rows += [(5000 + i, rows[0][1], rows[0][2], "x") for i in range(30)]  # copies
    rows += [(6000, None, 1, "x"), (6001, [0.0] * 16, 1, "x"), (6002, [float("nan")] * 16, 1, "x"), (6003, [float("inf")] + [1.0] * 15, 1, "x"), (6004, [1.0, None] + [1.0] * 14, 1, "x"), (6005, [1.0] * 3, 1, "x")]
    rows += [(6006, rows[1][1], None, "x"), (None, rows[1][1], rows[1][2], "x"), (7, rows[2][1], rows[2][2], "x"), (7, rows[2][1], rows[2][2], "x"), (6007, [1e30 * x for x in rows[3][1]], rows[3][2], "x")]
    return rows


@pytest.mark.parametrize("limits", [{}, {"leaf_size": 4096, "block": 16}])
def test_exact_in_one_leaf(spark, limits):
    """Small labels are one leaf, in one block or in many: then nothing can be missed."""
    rows = table(1)
    got = [tuple(r) for r in linked_vectors(spark.createDataFrame(rows, KIND), **limits).collect()]
    assert sorted(got, key=str) == brute(rows, 0.93)


def test_recall_and_precision_of_a_deep_forest(spark):
    rows = table(2, 600)
    df = spark.createDataFrame(rows, KIND)
    got = sorted((tuple(r) for r in linked_vectors(df, leaf_size=16, spill_levels=2).collect()), key=str)
    want = brute(rows, 0.93)
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
    exact = {}
    for w in want:
        exact.setdefault(w[0], []).append(w[1])
    assert all(g[1] <= max(exact[g[0]]) for g in got)


def test_no_rows(spark):
    assert linked_vectors(spark.createDataFrame([], KIND)).count() == 0
    lone = linked_vectors(spark.createDataFrame([(1, None, None, "x")], KIND)).first()
    assert tuple(lone) == (1, 0, 1, True)


DOUBLES = "vec_id long, embedding array<double>, label int, node string"


def test_cosine_in_double_precision(spark):
    """A pair just above the floor, which floats would put below it."""
    c = 0.930000002
    rows = [(1, [1.0] + [0.0] * 15, 1, "x"), (2, [c, (1 - c * c) ** 0.5] + [0.0] * 14, 1, "x"), (3, [0.0, 0.0, 1.0] + [0.0] * 13, 1, "x"), (4, [0.0, 0.0, 0.929999999, (1 - 0.929999999**2) ** 0.5] + [0.0] * 12, 1, "x")]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in linked_vectors(spark.createDataFrame(rows, DOUBLES)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4)}


@pytest.mark.parametrize("lengths", [1, 4])
def test_vectors_of_every_length_meet_their_like(spark, lengths):
    rng = np.random.default_rng(6)
    rows, k = [], 0
    for n, dims in ((60, 8), (40, 2), (12, 5), (3, 1)):
        base = rng.standard_normal((3, dims))
        for _ in range(n):
            rows.append((k, (base[rng.integers(3)] + 0.1 * rng.standard_normal(dims)).tolist(), int(rng.integers(2)), "x"))
            k += 1
    got = {r["vec_id"]: r["n_links"] for r in linked_vectors(spark.createDataFrame(rows, DOUBLES).repartition(3), leaf_size=8, lengths=lengths).collect()}
    cos = lambda a, b: np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b))
    want = {i: sum(j != i and p == q and len(v) == len(w) and cos(v, w) >= 0.93 for j, w, q, _ in rows) for i, v, p, _ in rows}
    short = {i for i, v, *_ in rows if len(v) != 8}
    assert sum(got.values()) >= 0.97 * sum(want.values()) and all(got[i] <= want[i] for i in got)
    assert lengths > 1 or all(got[i] == want[i] for i in short)


def test_recall_is_reached_or_levels_go():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    trees, recall = planted(x, np.zeros(400, dtype=np.int64), [6], 0.93, 0.9999, 0, 0.0, 1, most_trees=2)
    assert recall >= 0.9999 and len(trees) <= 2 and len(trees[0].medians) < 6
