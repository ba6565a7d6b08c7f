import gzip
import hashlib
import io
import random

import pytest

from conceptmerge.llm import warc

KIND = "page_id long, url string, html string, digest string, path int"


def rows():
    long = "<html>" + "é" * 200
    out = [(i, f"http://www.ex{i % 7}.com/p{i % 3}?b=2&a=1", f"<p>page {i % 20}</p>" + "x" * (i % 20 * 9), "d", 0) for i in range(90)]
    return out + [(500, None, long, "d", 0), (501, "https://a.b/c#f", long, "d", 0), (400, "", long, "d", 0), (502, "u", None, "d", 0), (503, "u", "", "d", 0), (504, "bad url:99x/\r\nx", "z" * 300_000, "d", 0)]


def expected(table):
    first = {}
    for page, _, html, *_ in table:
        body = (html or "").encode()
        h = hashlib.sha256(body).hexdigest()
        first[h] = min(first.get(h, page), page)
    out = []
    for page, _, html, *_ in table:
        body = (html or "").encode()
        h = hashlib.sha256(body).hexdigest()
        again = len(body) >= 100 and first[h] != page
        out.append((page, len(body), h, "revisit" if again else "response", first[h] if again else None))
    return sorted(out)


@pytest.mark.parametrize("how", [{}, {"captures_a_task": 7, "fan_in": 2, "every": 3}])
def test_round_trip_and_order(spark, tmp_path, how):
    df = spark.createDataFrame(rows(), KIND).repartition(5)
    got = warc.capture_histories(df, f"file://{tmp_path}/w", **how).collect()
    assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(rows())
    placed = [(r["url_key"], r["timestamp"], r["page_id"]) for r in sorted(got, key=lambda r: (r["range_no"], r["position"]))]
    assert placed == sorted(placed)
    if how:
        assert len({r["range_no"] for r in got}) > 3
    texts = {r[0]: (r[2] or "") for r in rows()}
    for r in got:
        with open(r["archive"], "rb") as f:
            f.seek(r["offset"])
            record = gzip.decompress(f.read(r["length"]))
        head, _, body = record.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        if r["record_type"] == "response":
            assert body == texts[r["page_id"]].encode() + b"\r\n\r\n"


def test_null_and_repeated_ids(spark, tmp_path):
    body = "y" * 150
    df = spark.createDataFrame([(None, "u", body, "d", 0), (3, "u", body, "d", 0), (3, "u", body, "d", 0)], KIND)
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in warc.capture_histories(df, f"file://{tmp_path}/w").collect())
    assert got == [(0, "revisit", 3), (3, "response", None), (3, "response", None)]
    assert warc.capture_histories(spark.createDataFrame([], KIND), f"file://{tmp_path}/v").count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(30))) for _ in range(k)]
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_damage_is_seen():
    good = gzip.compress(warc.record_bytes(1, "http://a/", b"hello", "00", None))
    assert [x[3] for x in warc.read_records(io.BytesIO(good + good), chunk=7)] == [b"hello", b"hello"]
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_records(io.BytesIO(good[:-9])))


def test_url_keys():
    same = ["http://www.Example.com/a?y=1&x=2", "https://example.com:443/a?x=2&y=1#top", "//www2.example.com/a?x=2&y=1"]
    assert {warc.url_key(u) for u in same} == {"com,example)/a?x=2&y=1"}
    assert warc.url_key("http://h:8080") == "h:8080)/" and warc.url_key(None) == ")/"


def test_very_many_small_runs(spark, tmp_path):
    """A thousand runs of a few captures each, merged in groups twice, and ranges that begin within a run's last block."""
    folder = f"file://{tmp_path}/w"
    (tmp_path / "w").mkdir()
    n = 3000

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                held = sorted(warc.Capture(f"h{(k * 7919 + i * 104729) % n:05d}", "t", warc._WIDE + k * 3 + i, f"r{k}-{i}", "u", 1, "d", "response", None, "a", 0, 1) for i in range(3))
                yield warc._written_run(folder, iter(held), 2)

    runs = warc.staged(spark.range(0, n // 3, 1, 4).mapInArrow(run, warc._RUN), "test-runs")
    got = warc.merged_index(runs, folder, fan_in=20, captures_a_task=100, every=2).collect()
    assert len(got) == n and len({r["range_no"] for r in got}) > 20
    placed = [(r["url_key"], r["page_id"]) for r in sorted(got, key=lambda r: (r["range_no"], r["position"]))]
    assert placed == sorted(placed) and len(set(placed)) == n
