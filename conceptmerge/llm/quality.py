"""A quality classifier: a sparse ensemble of rules over text statistics.

Small trees are grown on bootstrap samples of labelled rows; every path from a root to a
node is a rule, a conjunction of thresholds on statistics.  A lasso-penalised logistic
regression weighs the rules and drops most.  What is left is compiled to one Spark column
expression, so scoring never leaves the JVM.

Statistics see the text alone: shares and means that do not depend on its language.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .staging import unused

#: ASCII punctuation that is not usual in sentences.
_SYMBOLS = "*#$%&|@^~=+<>\\_{}[]`/"

STATISTICS = (
    "words", "symbol_share", "shout_rate", "upper_share", "digit_share", "mean_word", "distinct_words", "distinct_lines",
    "words_a_line", "stops_a_word", "blank_share", "wide_words",
)


def statistics(text: Column) -> Column:
    """A struct of numbers about a text; null counts as empty, and empty texts have zeros."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n = F.greatest(F.char_length(t), F.lit(1)).cast("double")
    split = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    words = F.size(split).cast("double")
    per_word = F.greatest(words, F.lit(1.0))
    lines = F.split(t, "\n")
    n_lines = F.size(lines).cast("double")
    left = lambda drop: n - F.char_length(F.translate(t, drop, ""))
    at_least = lambda x: F.greatest(x, F.lit(0.0))
    made = {
        "words": F.log10(words + 1),
        "symbol_share": at_least(left(_SYMBOLS) / n),
        "shout_rate": at_least(left("!") / per_word),
        "upper_share": F.regexp_count(t, F.lit(r"\p{Lu}")) / n,
        "digit_share": at_least(left("0123456789") / n),
        "mean_word": n / per_word,
        "distinct_words": F.size(F.array_distinct(split)) / per_word,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "words_a_line": words / n_lines,
        "stops_a_word": at_least(left(".?") / per_word),
        "blank_share": at_least(left(" \n\t\r") / n),
        "wide_words": F.size(F.filter(split, lambda w: F.char_length(w) > 20)) / per_word,
    }
    return F.struct(*[made[k].cast("double").alias(k) for k in STATISTICS])


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(statistic, is above, threshold)``."""

    tests: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for f, above, at in self.tests:
            out &= (x[:, f] > at) == above
        return out

    def column(self, stats: str) -> Column:
        out = F.lit(True)
        for f, above, at in self.tests:
            c = F.col(f"{stats}.{STATISTICS[f]}")
            out = out & (c > at if above else c <= at)
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            z += weight * rule.holds(x)
        return 1 / (1 + np.exp(-z))

    def column(self, stats: str) -> Column:
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int, path: tuple = ()) -> list[Rule]:
    """The rules of one tree: all its paths but the empty one."""
    out = [Rule(path)] if path else []
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return out
    best = (1e-9, None)
    base = y.mean() * (1 - y.mean()) * len(y)
    for f in rng.choice(x.shape[1], size=max(2, x.shape[1] // 2), replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, s = x[order, f], np.cumsum(y[order])
        at = np.flatnonzero((v[1:] > v[:-1]) & (np.arange(1, len(v)) >= least) & (np.arange(1, len(v)) <= len(v) - least))
        if not len(at):
            continue
        n1 = at + 1.0
        p1, p2 = s[at] / n1, (s[-1] - s[at]) / (len(y) - n1)
        gain = base - p1 * (1 - p1) * n1 - p2 * (1 - p2) * (len(y) - n1)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (gain[k], (int(f), float((v[at[k]] + v[at[k] + 1]) / 2)))
    if best[1] is None:
        return out
    f, t = best[1]
    side = x[:, f] > t
    for above in (False, True):
        out += _grow(x[side == above], y[side == above], rng, depth - 1, least, (*path, (f, above, t)))
    return out


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 600) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty by accelerated proximal gradient steps; the intercept is free."""
    n, m = z.shape
    mean = z.mean(0)
    centred = z - mean
    step = 4 * n / (np.linalg.norm(centred, 2) ** 2 + n)
    p0 = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w, b = np.zeros(m), math.log(p0 / (1 - p0))
    v, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-(centred @ v + c))) - y
        nw = v - step * (centred.T @ r) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nb = c - step * r.mean()
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        if np.abs(nw - w).max(initial=0) + abs(nb - b) < 1e-7:
            w, b = nw, nb
            break
        w, b, t = nw, nb, nt
    return float(b - mean @ w), w


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 1e-3, seed: int = 7, draws: int = 4000) -> RuleModel:
    """The rule ensemble of labelled statistics; each tree sees at most ``draws`` of the rows.  With one class or no rows the score is that class's smoothed share."""
    if len(y) < 2 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(math.log(share / (1 - share)), ())
    rng = np.random.default_rng(seed)
    least = max(3, len(y) // 400)
    found: dict[Rule, None] = {}
    for _ in range(trees):
        pick = rng.integers(0, len(y), size=min(len(y), draws))
        found |= dict.fromkeys(_grow(x[pick], y[pick].astype(float), rng, depth, least))
    by_rows: dict[bytes, Rule] = {}
    for rule in sorted(found, key=lambda r: (len(r.tests), r.tests)):  # of rules that hold for the same rows the shortest stays
        by_rows.setdefault(np.packbits(rule.holds(x)).tobytes(), rule)
    rules = list(by_rows.values())
    z = np.stack([r.holds(x) for r in rules], axis=1).astype(float)
    b, w = _lasso(z, y.astype(float), penalty)
    return RuleModel(b, tuple((r, float(k)) for r, k in zip(rules, w) if abs(k) > 1e-6))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str, label_col: str, usable: Column | None) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``most`` labelled ids, the first in the order of a hash of the id; of an id's texts the least in all statistics counts."""
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        chosen = chosen.where(usable)
    chosen = (
        chosen.groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min(F.col(label_col).cast("int")).alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id").limit(most)
    )
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    rows = rows.select("_id", "_y", statistics(F.col("_text")).alias("s")).groupBy("_id", "_y").agg(F.min("s").alias("s")).select("_id", "_y", "s.*")
    got = rows.toArrow().to_pandas().sort_values(["_id", "words", "mean_word"], kind="stable")
    return got[list(STATISTICS)].to_numpy(dtype=float), (got["_y"].to_numpy() > 0).astype(int)


def fit_quality(docs: DataFrame, labels: DataFrame, usable: Column | None = None, most: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **how) -> RuleModel:
    """The model of the labelled documents that meet ``usable`` (a condition on the id column).

    At most ``most`` labelled rows are learned from: a documented bound, under which fitting
    on the driver takes memory and time that do not grow with the corpus, also where ids repeat.
    ``how`` goes to ``fit_rules``.  Where an id has several labels the least counts.  Rows without a label, id or document teach nothing.
    """
    x, y = labelled_sample(docs, labels, most, id_col, text_col, label_col, usable)
    return fit_rules(x, y, **how)


def scored(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = 0.7, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with the model's score and 1 or 0.  Null texts score like empty ones; repeated rows alike; no rows, no result."""
    if clash := sorted(c for c in docs.columns if c.lower() in (score.lower(), predicted.lower())):
        raise ValueError(f"the input already has a column {clash}; name others")
    (stats,) = unused(docs, "stats")
    out = docs.withColumn(stats, statistics(F.col(text_col))).withColumn(score, model.column(stats))
    return out.withColumn(predicted, (F.col(score) >= threshold).cast("int")).drop(stats)
