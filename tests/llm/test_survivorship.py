"""Golden records against a plain version that sorts each cluster's records."""

import math
from datetime import datetime, timedelta
from random import Random

import pytest

from conceptmerge.llm.survivorship import Field, golden_records

SOURCES = ("crm", "web", "store", "partner")
FIELDS = (
    Field("name", ("name",), "longest"), Field("email", ("email",), "trusted"), Field("segment", ("segment",), "recent"), Field("balance", ("balance",), "within", of="segment"),
    Field("address", ("city", "nation_id"), "fullest"),
)
COLUMNS = "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id int, segment string, balance double, key string, Salt int"


def plain(rows):
    blank = lambda x: None if x is None or not x.strip(" \t\n\x0b\x0c\r") else x
    clusters = {}
    for r in rows:
        r = dict(zip([c.split()[0] for c in COLUMNS.split(", ")], r))
        for c in ("name", "email", "city", "segment"):
            r[c] = blank(r[c])
        if r["balance"] is not None and not math.isfinite(r["balance"]):
            r["balance"] = None
        clusters.setdefault(r["client_id"] if r["master_id"] is None else r["master_id"], []).append(r)
    out = []
    for key, members in clusters.items():
        dated = [r["updated_at"] for r in members if r["updated_at"]]
        least = lambda x: (x is None, x or 0)
        trust = lambda r: SOURCES.index(r["source"]) if r["source"] in SOURCES else 4
        stale = lambda r: not r["updated_at"] or r["updated_at"] < max(dated) - timedelta(hours=1440)
        age = lambda r: (not r["updated_at"], datetime.max - r["updated_at"] if r["updated_at"] else timedelta(0))
        recent = lambda r: (*age(r), trust(r), *least(r["client_id"]))
        trusted = lambda r: (stale(r), trust(r), *recent(r))
        first = lambda c, order: min((r for r in members if r[c] is not None), key=lambda r: (order(r), r[c]), default=None)
        segment = first("segment", recent)
        chosen = segment and segment["segment"]
        best = {
            "name": first("name", lambda r: (-len(r["name"]), trusted(r))), "email": first("email", trusted), "segment": segment,
            "balance": first("balance", lambda r: (r["segment"] != chosen, recent(r))),
        }
        missing = lambda r: (r["city"] is None) + (r["nation_id"] is None)
        address = min(members, key=lambda r: (missing(r), trusted(r), r["city"] is not None, r["city"] or "", r["nation_id"] is not None, r["nation_id"] or 0))
        out.append((
            key, len(members), sum(map(stale, members)), *[best[c] and best[c][c] for c in ("name", "email", "segment", "balance")], address["city"], address["nation_id"],
            *[best[c] and best[c]["client_id"] for c in ("name", "email", "segment", "balance")], None if missing(address) == 2 else address["client_id"],
        ))
    return sorted(out, key=str)


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert sorted((tuple(r) for r in golden_records(df, FIELDS, SOURCES, **how).collect()), key=str) == plain(rows)


@pytest.mark.parametrize("salts", [1, 7, None])
def test_random_records(spark, salts):
    rng = Random(3)
    day = datetime(2024, 5, 1)
    pick = lambda *x: rng.choice(x)
    rows = []
    for i in range(600):
        master = pick(None, 1, 1, 1, rng.randrange(40))
        when = pick(None, day, day - timedelta(days=60), day - timedelta(days=60, microseconds=1), day - timedelta(hours=rng.randrange(3000)))
        rows.append((
            pick(i, i, i, i // 2, None), master, pick(*SOURCES, None, "CRM", " web"), when, pick(None, "", " \t", "Ann", "Bö", "日本語", "😀😀", " x "), pick(None, " ", "a@b", "c@d"),
            pick(None, "\n", "Port", "Bel"), pick(None, 3, 0), pick(None, "", "retail", "Retail", "public"), pick(None, -0.5, 12.345, math.nan, math.inf), "mine", 9,
        ))
    rows += rows[:50]
    check(spark, rows, salts=salts)


def test_nothing_known(spark):
    check(spark, [])
    check(spark, [(None,) * 12] * 3 + [(5, None, *(None,) * 10), (6, 5, *(None,) * 10)])


def test_zoned_times_ignore_the_session_zone(spark):
    """Over a change of clocks a record is stale by hours that passed, not by the clock's face."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.sql("""select * from values (1L, 1L, 'crm', timestamp_micros(1711846800000000), 'a'), (2L, 1L, 'crm', timestamp_micros(1711846800000000 + 3600000000), 'b'),
            (3L, 1L, 'crm', timestamp_micros(1711846800000000 + 7200000001), 'c') t(client_id, master_id, source, updated_at, name)""")
        got = golden_records(df, [Field("name", ("name",), "recent")], SOURCES, stale_hours=1).collect()[0]
        assert (got["n_records"], got["n_stale"], got["name"], got["name_from"]) == (3, 2, "c", 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_hot_cluster_is_dealt_to_its_salts(spark):
    df = spark.range(30_000).selectExpr("id client_id", "if(id % 3 = 0, 7L, id) master_id", "'web' source", "timestamp_ntz'2024-01-01' updated_at", "string(id) name")
    got = {r["cluster_id"]: r for r in golden_records(df, [Field("name", ("name",), "longest")], SOURCES, salts=50).where("n_records > 1").collect()}
    assert list(got) == [7] and got[7]["n_records"] == 10_001 and got[7]["name_from"] == 10_002
