import pytest


@pytest.fixture()
def docs(spark):
    """Builds a documents table with two columns that operators might use for themselves."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1.5) for i, t in rows], "doc_id long, text string, mark string, score double")

    return make


#: Null and blank texts, a null id, repeated rows and ids, a long word and a very long text.
ODD = [
    (None, "one two three four five six"), (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "w" * 70_000), (6, "tick tock " * 30_000), (7, "same words here again and again"),
    (7, "same words here again and again"), (7, "another text under the same id"), (8, "same words here again and again"), (None, None),
]
