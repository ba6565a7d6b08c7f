import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptmerge.llm import quality

from .conftest import ODD


def labelled():
    good = [(i, f"This is a plain sentence number {i}. It says that nothing much happened on day {i * 3}, and so on.\nThen it ends.") for i in range(200)]
    bad = [(1000 + i, f"BUY!! NOW!! THIS!! IS!! NUMBER!! {i}!! " * 9) for i in range(30)] + [(2000 + i, f"w{i}*** x### y$$$ z%%% " * 20) for i in range(30)]
    return good + bad


def test_held_out_accuracy(spark, docs):
    rows = labelled()
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in rows] + [(5, None, 0), (None, 1, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = quality.fit_quality(docs(rows), labels, ~held)
    got = quality.scored(docs(rows).drop("score"), model).where(held).collect()
    assert len(got) > 40 and all(r["predicted"] == int(r["doc_id"] < 1000) for r in got)
    assert 0 < len(model.rules) < 60
    odd = quality.scored(docs(ODD).drop("score"), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    same = [r["score"] for r in odd if r["text"] == "same words here again and again"]
    assert len(same) == 3 and len(set(same)) == 1
    x, _ = quality.labelled_sample(docs(rows), labels, 10_000, "doc_id", "text", "quality", held)
    scores = np.sort(model.score(x))
    assert np.allclose(scores, np.sort([r["score"] for r in got if r["doc_id"] != 9999]))


def test_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(docs(ODD), none)
    assert model.rules == () and model.score(np.zeros((1, len(quality.STATISTICS))))[0] == 0.5
    assert quality.scored(docs([]).drop("score"), model).count() == 0
    with pytest.raises(ValueError, match="score"):
        quality.scored(docs(ODD), model)
    assert quality.scored(docs(ODD), model, score="s2").count() == len(ODD)


def test_clashing_names_and_repeated_ids(spark, docs):
    rows = labelled()
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows], "doc_id long, quality int")
    with pytest.raises(ValueError, match="Score"):
        quality.scored(docs(rows).withColumnRenamed("score", "Score"), quality.RuleModel(0.0, ()))
    got = quality.scored(docs(rows).drop("score").withColumn("Stats", F.lit("mine")), quality.RuleModel(0.0, ()))
    assert {r["Stats"] for r in got.collect()} == {"mine"}
    repeated = docs(rows + [(5, f"another text {i}") for i in range(300)])
    x, y = quality.labelled_sample(repeated, labels, 100, "doc_id", "text", "quality", None)
    assert len(x) == len(y) == 100
    assert len(quality.labelled_sample(repeated, labels, 10_000, "doc_id", "text", "quality", None)[1]) == len(rows)


def test_statistics_against_plain_python(spark):
    import math
    import re

    texts = [t for _, t in ODD if t and len(t) < 100_000] + ["Ünï cödé ABC! 12 ?\n\nx\ty.", "a  b\nc\na  b", "***", "É" * 25 + " yes no yes"]
    got = [tuple(r["s"]) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(quality.statistics(F.col("t")).alias("s")).collect()]
    for t, row in zip(texts, got):
        words, lines, n = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w], t.split("\n"), len(t)
        per = max(len(words), 1)
        count = lambda of: sum(c in of for c in t)
        want = (
            math.log10(len(words) + 1), count(r"*#$%&|@^~=+<>\_{}[]`/") / n, count("!") / per, sum(c.isupper() for c in t) / n, count("0123456789") / n, n / per, len(set(words)) / per,
            len(set(lines)) / len(lines), len(words) / len(lines), count(".?") / per, count(" \n\t\r") / n, sum(len(w) > 20 for w in words) / per,
        )
        assert np.allclose(row, want), t[:40]
