"""A keyed table in hash buckets that batches are merged into.

Every version is a small manifest: which folder holds each bucket.  A batch reads and rewrites
the buckets its keys fall into and leaves the others where they are; its version counts once
the manifest is there under its name.  So a batch that fails leaves only files that nothing
points at, and a batch that comes again finds its version and does nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_BUCKET = "hash_bucket"


class BucketTable:
    """State by ``key`` below ``folder``, in ``buckets`` parts fixed when the table begins.

    ``fold`` turns all rows of some keys into the rows to keep; it must give the same whether
    rows are folded at once or batch by batch.  A bucket is written by one task, so choose
    their number for parts of some hundred megabytes; the manifest has a line for each.
    """

    def __init__(self, spark: SparkSession, folder: str, key: Sequence[str], fold: Callable[[DataFrame], DataFrame], buckets: int = 64, keep: int = 2):
        if keep < 1:
            raise ValueError("at least one version is kept")
        self.spark, self.folder, self.key, self.fold, self.buckets, self.keep = spark, folder.rstrip("/"), list(key), fold, buckets, keep

    # --- files ---

    def _at(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._at(*parts)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("versions") if n.endswith(".json"))

    def manifest(self, version: int) -> dict:
        """``buckets``, ``schema`` and ``places`` (the folder of each bucket that has rows)."""
        fs, path = self._at("versions", f"{version}.json")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, version: int, manifest: dict) -> None:
        fs, final = self._at("versions", f"{version}.json")
        _, draft = self._at("versions", f"{version}.{uuid.uuid4().hex}.draft")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if not fs.rename(draft, final):
            raise OSError(f"version {version} of {self.folder} exists already")

    # --- reading and merging ---

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version (the last if none is named), of all buckets or some."""
        held = self.versions()
        if not held:
            raise FileNotFoundError(f"{self.folder} holds no version")
        manifest = self.manifest(held[-1] if version is None else version)
        return self._rows(manifest, only)

    def _rows(self, manifest: dict, only: Sequence[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        places = [f"{self.folder}/{p}" for b, p in manifest["places"].items() if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, number: int) -> list[int]:
        """Merges a batch under its number; the buckets it rewrote, none if that number is merged already.

        Numbers grow; a batch without rows gives a version all the same.
        """
        held = self.versions()
        if held and number <= held[-1]:
            return []
        if _BUCKET in {c.lower() for c in batch.columns}:
            raise ValueError(f"a column is called {_BUCKET}")
        old = self.manifest(held[-1]) if held else {"buckets": self.buckets, "schema": None, "places": {}}
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(old["buckets"])).cast("int")
        batch = batch.persist()
        try:
            touched = sorted(r[0] for r in batch.select(bucket).distinct().collect())  # at most as many as there are buckets
            rows = batch if old["schema"] is None else self._rows(old, touched).unionByName(batch)
            made = f"data/{number}-{uuid.uuid4().hex}"
            folded = self.fold(rows)
            if touched:
                folded.withColumn(_BUCKET, bucket).repartition(len(touched), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.folder}/{made}")
        finally:
            batch.unpersist()
        places = {b: p for b, p in old["places"].items() if int(b) not in touched}
        for name in self._names(made):
            if name.startswith(f"{_BUCKET}="):
                places[name.partition("=")[2]] = f"{made}/{name}"
        self._commit(number, {"buckets": old["buckets"], "schema": json.loads(folded.schema.json()), "places": places})
        self._clean()
        return touched

    def _clean(self) -> None:
        """Removes manifests before the last ``keep``, and folders that none of those points at, failed attempts among them."""
        *gone, = self.versions()[: -self.keep]
        used = {p for v in self.versions()[-self.keep :] for p in self.manifest(v)["places"].values()}
        for made in self._names("data"):
            for name in self._names("data", made):
                if f"data/{made}/{name}" not in used and name.startswith(f"{_BUCKET}="):
                    fs, path = self._at("data", made, name)
                    fs.delete(path, True)
            if not any(n.startswith(f"{_BUCKET}=") for n in self._names("data", made)):
                fs, path = self._at("data", made)
                fs.delete(path, True)
        for version in gone:
            fs, path = self._at("versions", f"{version}.json")
            fs.delete(path, False)
