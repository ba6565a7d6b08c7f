"""WARC archives of pages, and their global capture index by external merge.

Writing: each task writes its records to one archive of gzip members (one for each record);
repeated payloads become revisit records.  Indexing: each archive is read back from its
bytes, and its captures are written as a run sorted by URL key, time and page, with a sparse
index of a row for each block of lines.  Merging: these rows are numbered along all runs, which
parts the keys into ranges of about equal size; joined with them, each run's blocks tell which
bytes a range needs of it.  For each range a task reads its slice of every run and merges the
slices with a loser tree.  With more runs than ``fan_in``, runs are first merged in groups, so a
task never has more files open than that.  Index, ranges and slices are tables: the driver
holds their counts alone.

A task that runs again writes new files; only files that a completed task reported are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from typing import NamedTuple
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.batching import numbered
from .staging import dropped, fresh_path, settings, staged

SMALLEST = 100  # payloads of fewer bytes are never revisits
_START = datetime(2024, 1, 1, tzinfo=timezone.utc)
_WIDE = 1 << 63


class Capture(NamedTuple):
    """One line of the index; its order is that of the capture histories."""

    url_key: str
    timestamp: str
    page: int  # the page id shifted to be non-negative; null ids come last
    record: str
    url: str
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: int | None
    archive: str
    offset: int
    length: int


def url_key(url: str | None) -> str:
    """A sort key of a URL: host labels reversed, then path and query; scheme, ``www.``, port 80 or 443 and fragment do not matter."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text if "://" in text or text.startswith("//") else f"//{text}")
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return text.lower()
    host = re.sub(r"\Awww\d*\.", "", host)
    tail = f":{port}" if port not in (None, 80, 443) else ""
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return ",".join(reversed(host.split("."))) + tail + ")" + (parts.path or "/") + (f"?{query}" if query else "")


def capture_time(page_id: int | None) -> str:
    """The time of a synthetic capture: one second for each page id, within a century."""
    return (_START + timedelta(seconds=(page_id or 0) % 3_155_760_000)).strftime("%Y-%m-%dT%H:%M:%SZ")


def _one_line(text: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record: a response with its payload, or a revisit without."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{url}')}>",
        f"WARC-Target-URI: {_one_line(url or '')}",
        f"WARC-Date: {capture_time(page_id)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(source, chunk: int = 1 << 20) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, headers, block)`` of each record of an archive; holds one record at a time."""
    at, rest = 0, b""
    while True:
        if not rest:
            rest = source.read(chunk)
            if not rest:
                return
        unzip, out, used = zlib.decompressobj(31), [], 0
        while not unzip.eof:
            if not rest:
                rest = source.read(chunk)
                if not rest:
                    raise ValueError("an archive ends within a record")
            out.append(unzip.decompress(rest))
            used += len(rest) - len(unzip.unused_data)
            rest = unzip.unused_data
        raw = b"".join(out)
        head, _, body = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a WARC record: {lines[0][:40]}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        block = body[: int(headers["Content-Length"])]
        if body[len(block) :] != b"\r\n\r\n":
            raise ValueError("a record's length does not match its block")
        yield at, used, headers, block
        at += used


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a URI, for executors: local and shared mounts, HDFS and object stores alike."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- loser tree -----------------------------------------------------------------------------

class LoserTree:
    """Merges sorted iterators: one comparison for each level per item taken."""

    def __init__(self, sources: list[Iterator]):
        self.k = len(sources)
        self.sources = sources
        self.heads = [next(s, None) for s in sources]
        self.losers = [-1] * max(1, self.k)
        self.winner = self._build(1) if self.k > 1 else 0

    def _before(self, i: int, j: int) -> bool:
        a, b = self.heads[i], self.heads[j]
        return a is not None and (b is None or (a, i) < (b, j))

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        left, right = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (left, right) if self._before(left, right) else (right, left)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator:
        if not self.k:
            return
        while (item := self.heads[self.winner]) is not None:
            yield item
            i = self.winner
            self.heads[i] = next(self.sources[i], None)
            node = (i + self.k) // 2
            while node >= 1:
                if self._before(self.losers[node], i):
                    self.losers[node], i = i, self.losers[node]
                node //= 2
            self.winner = i


# --- runs -----------------------------------------------------------------------------------

def _line(c: Capture) -> bytes:
    return json.dumps(list(c), ensure_ascii=False, separators=(",", ":")).encode() + b"\n"


def _parsed(line: bytes) -> Capture:
    return Capture(*json.loads(line))


_KEY = "url_key string, timestamp string, unnamed boolean, page long, record string"
_RUN = f"path string, n long, at long, until long, key struct<{_KEY.replace(' ', ':').replace(',:', ',')}>"


def _key(c: tuple) -> dict:
    """The first fields of a capture as columns that Spark orders alike; a page without an id comes last."""
    unnamed = c[2] == 2 * _WIDE
    return {"url_key": c[0], "timestamp": c[1], "unnamed": unnamed, "page": 0 if unnamed else c[2] - _WIDE, "record": c[3]}


def _tuple(key: dict | None) -> tuple | None:
    return None if key is None else (key["url_key"], key["timestamp"], 2 * _WIDE if key["unnamed"] else key["page"] + _WIDE, key["record"])


def _written_run(folder: str, captures: Iterator[Capture], every: int) -> pa.RecordBatch:
    """Writes sorted captures as a run; a row for each block of so many lines with its first key, and one of no lines with the last key."""
    store, path = _open(f"{folder}/run-{uuid.uuid4().hex}.cdxj")
    at, rows, last = 0, [], None
    with store.open_output_stream(path, buffer_size=1 << 18) as out:
        for n, c in enumerate(captures):
            line = _line(c)
            if n % every == 0:
                rows.append([0, at, at, _key(c)])
            out.write(line)
            at, last = at + len(line), c
            rows[-1][0] += 1
            rows[-1][2] = at
    rows.append([0, at, at, _key(last)])
    n, begin, until, key = zip(*rows)
    kind = pa.struct([("url_key", pa.string()), ("timestamp", pa.string()), ("unnamed", pa.bool_()), ("page", pa.int64()), ("record", pa.string())])
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(rows)), *(pa.array(x, pa.int64()) for x in (n, begin, until)), pa.array(key, kind)], names=["path", "n", "at", "until", "key"]
    )


def _slice(store: pafs.FileSystem, path: str, begin: int, end: int, low: tuple | None, high: tuple | None) -> Iterator[Capture]:
    """The captures of a run from ``low`` to before ``high``, out of the bytes begin to end."""
    if end <= begin:
        return
    with store.open_input_file(path) as f:
        f.seek(begin)
        at, rest = begin, b""
        while at < end:
            got = f.read(min(1 << 16, end - at))
            at += len(got)
            lines = (rest + got).split(b"\n")
            rest = lines.pop()
            for line in lines:
                c = _parsed(line)
                if high is not None and c[:4] >= high:
                    return
                if low is None or c[:4] >= low:
                    yield c


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", level: int = 2) -> DataFrame:
    """Writes all pages as archives in ``folder``; rows ``(path, n_records)`` of complete archives.

    Of records with equal payloads of at least ``SMALLEST`` bytes the one of the smallest id
    holds the payload and the others refer to it.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= SMALLEST
    first = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    rows = rows.join(first, "digest", "left").select("page_id", "url", "payload", "digest", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path, out, n = None, None, None, 0
        try:
            for batch in batches:
                for page, url, body, digest, refers in zip(*(batch.column(i).to_pylist() for i in range(5))):
                    if out is None:
                        store, path = _open(f"{folder}/pages-{uuid.uuid4().hex}.warc.gz")
                        out = store.open_output_stream(path, buffer_size=1 << 20, compression=None)
                    zipped = zlib.compressobj(level, zlib.DEFLATED, 31)
                    out.write(zipped.compress(record_bytes(page, url, body, digest, refers)) + zipped.flush())
                    n += 1
        finally:
            if out is not None:
                out.close()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], names=["path", "n_records"])

    return staged(rows.mapInArrow(run, "path string, n_records long"), "warc-archives")


def index_archives(archives: DataFrame, folder: str, every: int = 512, memory_rows: int = 200_000) -> DataFrame:
    """Reads the archives back; each gives sorted runs of its captures, checked against their digests."""

    def captures(path: str) -> Iterator[Capture]:
        store, _ = _open(folder)
        with store.open_input_stream(path, compression=None) as f:
            for at, used, head, block in read_records(f):
                digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["X-Payload-Length"])
                if head["WARC-Type"] == "response" and (hashlib.sha256(block).hexdigest() != digest or len(block) != size):
                    raise ValueError(f"{path} is damaged at {at}")
                page = int(head["X-Page-Id"]) + _WIDE if head["X-Page-Id"] else 2 * _WIDE
                refers = head.get("X-Refers-To-Page")
                url = head["WARC-Target-URI"]
                yield Capture(url_key(url), head["WARC-Date"], page, head["WARC-Record-ID"], url, size, digest, head["WARC-Type"], int(refers) if refers else None, path, at, used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held: list[Capture] = []
                for c in captures(path):
                    held.append(c)
                    if len(held) >= memory_rows:
                        held.sort()
                        yield _written_run(folder, iter(held), every)
                        held = []
                if held:
                    held.sort()
                    yield _written_run(folder, iter(held), every)

    n = max(1, archives.count())
    return staged(archives.select("path").repartition(n, "path").mapInArrow(run, _RUN), "warc-runs")


_CAPTURE = "url_key string, timestamp string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long, range_no long, position long"


def _grouped(blocks: DataFrame, folder: str, fan_in: int, every: int, n: int) -> DataFrame:
    """Runs merged in groups of ``fan_in``."""
    ends = numbered(blocks.groupBy("path").agg(F.max("until").alias("until")), ["path"], "i")
    groups = ends.groupBy(((F.col("i") - 1) / fan_in).cast("long").alias("g")).agg(F.collect_list(F.struct("path", "until")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(folder)
        for batch in batches:
            for runs in batch.column(0).to_pylist():
                yield _written_run(folder, iter(LoserTree([_slice(store, r["path"], 0, r["until"], None, None) for r in runs])), every)

    return staged(groups.repartition(-(-n // fan_in), "g").select("runs").mapInArrow(run, _RUN), "warc-runs")


def _slices(blocks: DataFrame, parts: int) -> DataFrame:
    """Rows ``(range_no, low, high, runs)``: the keys between which a range lies, and of each run the bytes that may hold them."""
    keys = numbered(blocks.select("key").distinct(), ["key"], "rank")
    keys = staged(keys, "warc-keys")
    per = max(1, -(-keys.count() // parts))
    keys_in = keys.withColumn("range_no", ((F.col("rank") - 1) / per).cast("long"))
    lows = keys_in.where((F.col("rank") - 1) % per == 0).select("range_no", F.col("key").alias("low"))
    here = blocks.join(keys_in.select("key", "range_no"), "key")
    # a block's keys go on to the first key of the next block of its run
    on = F.lead("range_no").over(Window.partitionBy("path").orderBy("at", "until"))
    held = here.withColumn("last", on).where("until > at").select("path", "at", "until", F.explode(F.sequence("range_no", F.coalesce("last", "range_no"))).alias("range_no"))
    held = held.groupBy("range_no", "path").agg(F.min("at").alias("begin"), F.max("until").alias("until"))
    runs = held.groupBy("range_no").agg(F.collect_list(F.struct("path", "begin", "until")).alias("runs"))
    highs = lows.select((F.col("range_no") - 1).alias("range_no"), F.col("low").alias("high"))
    first = F.when(F.col("range_no") > 0, F.col("low")).alias("low")  # the first range has no lower end
    out = staged(runs.join(lows, "range_no").join(highs, "range_no", "left").select("range_no", first, "high", "runs"), "warc-ranges")
    dropped(keys)
    return out


def merged_index(runs: DataFrame, folder: str, fan_in: int = 256, captures_a_task: int = 50_000, every: int = 512) -> DataFrame:
    """The captures of all runs in global order: by ``range_no``, then ``position``; at most ``fan_in`` runs are merged at a time."""
    blocks, spent = runs, []
    while (n := blocks.select("path").distinct().count()) > fan_in:
        blocks = _grouped(blocks, folder, fan_in, every, n)
        spent.append(blocks)
    parts = max(1, -(-(blocks.agg(F.sum("n")).first()[0] or 0) // captures_a_task))
    ranges = _slices(blocks, parts)
    dropped(*spent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(folder)
        for batch in batches:
            for t, low, high, slices in zip(*(batch.column(c).to_pylist() for c in ("range_no", "low", "high", "runs"))):
                tree = LoserTree([_slice(store, r["path"], r["begin"], r["until"], _tuple(low), _tuple(high)) for r in slices])
                held, position = [], 0
                for c in tree:
                    held.append((c.url_key, c.timestamp, None if c.page == 2 * _WIDE else c.page - _WIDE, c.url, c.payload_bytes, c.payload_digest, c.record_type, c.refers_to, c.archive, c.offset, c.length, t, position))
                    position += 1
                    if len(held) == 4096:
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)

    return ranges.repartition(parts, "range_no").mapInArrow(run, _CAPTURE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    s, n = pa.string(), pa.int64()
    kinds = (s, s, n, s, n, s, s, n, s, n, n, n, n)
    names = [x.split()[0] for x in _CAPTURE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def capture_histories(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", every: int = 512, **merge: int) -> DataFrame:
    """Writes ``pages`` as WARC archives, reads them back and returns all captures in global order.

    One row for each page: a null payload is empty, a null URL empty; repeated ids and rows
    are captures of their own (of equal payloads under the smallest id, each row of that id
    holds its payload).  An empty input writes nothing and gives an empty result.  Archives
    and runs stay in ``folder`` (by default a new one in the shared folder).
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    if folder.startswith("file:") or "://" not in folder:
        store, path = _open(folder)
        store.create_dir(path, recursive=True)
    with settings(spark, values={"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}):
        archives = write_archives(pages, folder, id_col, url_col, payload_col)
        runs = index_archives(archives, folder, every)
    out = merged_index(runs, folder, every=every, **merge)
    dropped(runs)
    return out
