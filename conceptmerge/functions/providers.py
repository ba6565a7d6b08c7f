"""Boundaries to models and remote look-ups, each with a deterministic offline stand-in.

A provider is a plain function on a pandas batch, called in Arrow batches on the executors;
real ones open their client inside the function.  The stand-ins give the same answer
everywhere, and make no claim to be as good as a model.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The tags that a summary may have.
CATEGORIES = (
    "IUPAC String", "N-Linked Type", "O-Linked Core", "Glycolipid", "Named Functional Motif", "Polysaccharide", "Polysaccharide Repeating Unit", "Monosaccharide", "Disaccharide", "Others",
)


def hashed_embedding(texts: pd.Series, dims: int = 64) -> pd.Series:
    """Character trigrams hashed to signed counts, scaled to length one."""
    def one(text: str | None) -> list[float]:
        v = [0.0] * dims
        padded = f"  {(text or '').lower()}  "
        for i in range(len(padded) - 2):
            h = int.from_bytes(hashlib.blake2b(padded[i : i + 3].encode(), digest_size=8).digest(), "little")
            v[h % dims] += 1.0 if h >> 63 else -1.0
        n = sum(x * x for x in v) ** 0.5
        return [x / n for x in v] if n else v

    return texts.map(one)


def embedded(df: DataFrame, text: str, into: str = "embedding", provider: Callable[[pd.Series], pd.Series] = hashed_embedding) -> DataFrame:
    @F.pandas_udf("array<float>")
    def call(batch: pd.Series) -> pd.Series:
        return provider(batch)

    return df.withColumn(into, call(F.col(text)))


def dictionary_entities(text: str, names: tuple[str, ...], threshold: float = 0.25) -> list[tuple[str, int, int, float]]:
    """Literal occurrences of names: (term, start, end, score)."""
    if not names:
        return []
    found = re.finditer("|".join(rf"\b{re.escape(n)}\b" for n in sorted(names, key=lambda n: (-len(n), n))), text, re.IGNORECASE)
    return [(m[0], m.start(), m.end(), 1.0) for m in found if threshold <= 1.0]


def entities(df: DataFrame, id_col: str, text: str, names: tuple[str, ...], provider: Callable = dictionary_entities, threshold: float = 0.25) -> DataFrame:
    """Rows ``(id, term, start_pos, end_pos, similarity)``."""
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, *hit) for i, t in zip(pdf["id"], pdf["text"]) if t for hit in provider(t, names, threshold)]
            yield pd.DataFrame(rows, columns=["id", "term", "start_pos", "end_pos", "similarity"])

    return df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInPandas(run, f"id {kind}, term string, start_pos long, end_pos long, similarity double")


def retain_by_length(terms: list[str]) -> str:
    """Stand-in for the model that keeps or removes terms: JSON lines, as the model is asked for."""
    return "\n".join(json.dumps({"original_term": t, "decision": "retain" if len(t) > 3 else "remove"}, ensure_ascii=False) for t in terms)


def normalize_by_case(terms: list[str]) -> str:
    groups: dict[str, list[str]] = {}
    for t in terms:
        groups.setdefault(re.sub(r"(?<![isu])s\b", "", t.lower()), []).append(t)
    return "\n".join(json.dumps({"normalized_term": k, "original_terms": v}, ensure_ascii=False) for k, v in groups.items())


def summarize_first(term: str, original_terms: list[str], descriptions: str) -> str:
    """Stand-in for the model that sums a run up: the longest tag that the descriptions name, the other terms, the first sentence."""
    kind = next((c for c in sorted(CATEGORIES, key=len, reverse=True) if c.lower() in descriptions.lower()), "Others")
    made = {"exact_synonyms": sorted(set(original_terms) - {term}), "classification": kind, "description": descriptions.split(". ")[0]}
    return "```json\n" + json.dumps(made, ensure_ascii=False) + "\n```"


def answered(batches: DataFrame, arguments: str | list[str], into: str, provider: Callable[..., str]) -> DataFrame:
    """A provider's answer for each row, and ``<into>_error``, null where it answered.

    An exception leaves an empty answer, which parsing turns into its fallback, and its text
    as the error, so a provider that is down can be told from one that answers nonsense.
    """
    names = [arguments] if isinstance(arguments, str) else arguments

    @F.pandas_udf("answer string, error string")
    def call(*columns: pd.Series) -> pd.DataFrame:
        def one(*row) -> tuple[str, str | None]:
            try:
                return provider(*[x.tolist() if hasattr(x, "tolist") else x for x in row]), None
            except Exception as e:
                return "", f"{type(e).__name__}: {e}"

        return pd.DataFrame([one(*row) for row in zip(*columns)], columns=["answer", "error"])

    said = batches.withColumn("_said", call(*[F.col(c) for c in names]))
    return said.withColumn(into, F.col("_said.answer")).withColumn(f"{into}_error", F.col("_said.error")).drop("_said")


class Lookups:
    """Remote look-ups by accession, sequence or code; offline, tables stand in for the services."""

    def __init__(self, sequences: dict[str, str] | None = None, accessions: dict[str, str] | None = None):
        self.sequences, self.accessions = sequences or {}, accessions or {}

    def sequence_of(self, accession: str) -> str:
        """The sequence of an accession; any failure gives ``""``."""
        return self.sequences.get(accession, "")

    def accession_of(self, sequence: str) -> str:
        """The accession of a sequence, or a message."""
        return self.accessions.get(sequence, "not registered")


class RemoteLookups:
    """The same look-ups over a service.  Its routes and messages are fixed values.  ``get(url)`` gives ``(status, decoded JSON)`` or raises; tests pass a stand-in.

    It must be picklable, as the calls run on the executors.
    """

    def __init__(self, get: Callable[[str], tuple[int, object]], base: str):
        self.get, self.base = get, base.rstrip("/")

    def sequence_of(self, accession: str) -> str:
        """Two chained calls: the accession's WURCS, then its condensed form; any failure gives ``""``."""
        try:
            _, found = self.get(f"{self.base}/sparqlist/gtcid2seqs?gtcid={accession}")
            _, made = self.get(f"{self.base}/glycanformatconverter/2.10.4/wurcs2iupaccondensed/{quote(found[0]['wurcs'], safe='')}")
            return made["IUPACcondensed"]
        except Exception:
            return ""

    def _id(self, route: str, sequence: str) -> str:
        status, found = self.get(f"{self.base}/glycanformatconverter/{route}/{quote(sequence)}")
        if status != 200:
            return f"Error: {status}"
        return found.get("id") or "No GlyTouCan ID found"

    def accession_of_code(self, code: str) -> str:
        """The accession of a GlycoCT text: the answer depends on the status and on whether an id came back."""
        return self._id("2.10.4/glycoct2wurcs", code)

    def accession_of(self, sequence: str) -> str:
        """The accession of a condensed sequence."""
        return self._id("2.8.2/iupaccondensed2wurcs", sequence)


def looked_up(df: DataFrame, column: str, into: str, method: Callable[[str], str]) -> DataFrame:
    """Looks each distinct value up once."""
    @F.pandas_udf("string")
    def call(values: pd.Series) -> pd.Series:
        return values.map(lambda x: method(x) if x is not None else None)

    distinct = df.select(column).distinct().withColumn(into, call(F.col(column)))
    return df.join(distinct, column, "left")


def resolved(df: DataFrame, column: str, connect: Callable[[], Callable[[str], str | None]], tries: int = 4, wait: float = 0.5, calls_a_second: float | None = None, tasks: int | None = None) -> DataFrame:
    """Rows ``(key, value, error, tries)`` for each distinct value of a column: what a remote service says about it.

    ``connect`` runs once in each task and gives the call for one key, so clients need not be
    picklable.  A call that raises is made again, up to ``tries`` times, after ``wait`` seconds
    and then twice as long each time; the last error stays in the row, so failures are a table
    (``error is not null``) that can be resolved again.  Keys are dealt to ``tasks`` (by default
    the session's shuffle partitions), each asked for once and one after another, which with
    ``calls_a_second`` bounds what a service sees.  A null key is not asked for.
    """
    spark = df.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, pause = None, 1 / calls_a_second if calls_a_second else 0
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                for turn in range(1, tries + 1):
                    try:
                        ask = ask or connect()
                        rows.append((key, ask(key), None, turn))
                        break
                    except Exception as e:
                        if turn == tries:
                            rows.append((key, None, f"{type(e).__name__}: {e}", turn))
                        else:
                            time.sleep(wait * 2 ** (turn - 1))
                time.sleep(pause)
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int32()))], names=["key", "value", "error", "tries"])

    keys = df.select(F.col(column).cast("string").alias("key")).where("key is not null").distinct()
    return keys.repartition(tasks, "key").mapInArrow(run, "key string, value string, error string, tries int")
