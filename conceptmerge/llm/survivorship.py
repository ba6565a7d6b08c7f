"""Golden records: one surviving record for each cluster of records of the same entity.

Winners are minima of structs (order first, value last), so they merge like any minimum:
records are dealt to salts, each (cluster, salt) finds its own winners, and the winners of
a cluster's salts are merged.  What the order of a later round needs (the latest change of
the cluster, and the values that go by recency alone) is found by an earlier salted round
and handed back to every (cluster, salt), so a cluster of any size is spread over as many
tasks as there are salts, and no table is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .staging import dropped, staged

_BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Field:
    """Columns that one record supplies together, and which record.

    ``recent``: the latest change.  ``trusted``: fresh records, then sources by trust.
    ``longest``: most code points (of the first column), then trusted.  ``fullest``: most
    columns that are not null, then trusted; supplies its columns even if all are null.
    ``within``: records whose value of the field ``of`` (itself ``recent``) is the surviving
    one, then all others, by recency.  All but ``fullest`` pass over records whose first
    column is null.
    """

    name: str
    columns: tuple[str, ...]
    rule: str = "trusted"
    of: str | None = None


def filled(c: Column, kind: str) -> Column:
    """Null for what says nothing: empty and blank text, and numbers that are none or infinite."""
    if kind == "string":
        return F.when(F.translate(c, _BLANKS, "") != "", c)
    if kind in ("double", "float"):
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    return c


def _age(c: Column, kind: str) -> Column:
    """Grows with the time since the change, to the microsecond and whatever the session's zone."""
    if kind == "timestamp":
        return -F.unix_micros(c)
    return F.expr("timestamp_ntz'9999-12-31 23:59:59.999999'") - c.cast("timestamp_ntz")


def golden_records(
    records: DataFrame,
    fields: Sequence[Field],
    sources: Sequence[str],
    stale_hours: int = 60 * 24,
    id_col: str = "client_id",
    master_col: str = "master_id",
    source_col: str = "source",
    updated_col: str = "updated_at",
    salts: int | None = None,
) -> DataFrame:
    """Rows ``(cluster_id, n_records, n_stale, <columns of each field>, <field>_from)``.

    The cluster is the master's id, or the record's own where that is null; records with
    neither are one cluster of null id.  ``sources`` go by falling trust; any other source,
    null too, is trusted least.  A record is stale if its time of change is null or more than
    ``stale_hours`` before the latest of its cluster.  Recency: latest change (null last),
    higher trust, smaller id (null last); rows alike in all that tie by the least value.
    ``<field>_from`` is the id of the record that supplies a value, null where none does.
    Blank texts count as null, other texts stay untrimmed; NaN and infinite numbers count as
    null.  Repeated rows are records of their own.  Further columns of the input are not read.
    An empty input gives an empty result.

    ``salts`` is the number of tasks that one cluster may be spread over, by default the
    session's number of shuffle partitions.
    """
    spark = records.sparkSession
    salts = salts or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kinds = dict(records.dtypes)
    timed = kinds[updated_col]
    trust = F.lit(len(sources))
    for rank, source in reversed(list(enumerate(sources))):
        trust = F.when(F.col(source_col) == source, F.lit(rank)).otherwise(trust)
    places = {c: f"v{i}" for i, c in enumerate(dict.fromkeys(c for f in fields for c in f.columns))}
    rows = staged(
        records.select(
            F.struct(F.coalesce(F.col(master_col), F.col(id_col)).alias("id")).alias("key"),  # a struct equals another even where both hold null
            F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("salt"),
            F.col(id_col).alias("id"), trust.alias("trust"), _age(F.col(updated_col), timed).alias("age"),
            *[filled(F.col(c), kinds[c]).alias(v) for c, v in places.items()],
        ),
        "survivorship-rows",
    )
    late = [F.col("age").isNull().alias("undated"), F.col("age").alias("age"), F.col("trust").alias("trust"), F.col("id").isNull().alias("unnamed"), F.col("id").alias("id")]
    value = lambda f: [F.col(places[c]).alias(f"c{i}") for i, c in enumerate(f.columns)]
    present = lambda f: F.col(places[f.columns[0]]).isNotNull()
    early = [f for f in fields if f.rule == "recent"]
    number = {f.name: i for i, f in enumerate(fields)}
    won = lambda f: f"w{number[f.name]}"

    # First round: what goes by recency alone, for each (cluster, salt), then over the cluster's salts, of which each keeps its row.
    found = rows.groupBy("key", "salt").agg(F.min("age").alias("latest"), *[F.min(F.when(present(f), F.struct(*late, *value(f)))).alias(won(f)) for f in early])
    whole = Window.partitionBy("key")
    found = found.select("key", "salt", *[F.min(c).over(whole).alias(c) for c in ("latest", *map(won, early))])

    # Second round: each row knows its cluster's latest change and surviving values.
    limit = F.lit(stale_hours * 3_600_000_000) if timed == "timestamp" else F.expr(f"make_dt_interval(0, {int(stale_hours)})")
    known = rows.join(found, ["key", "salt"]).withColumn("stale", F.col("age").isNull() | (F.col("age") - F.col("latest") > limit))
    trusted = [F.col("stale"), *late[2:3], *late[:2], *late[3:]]

    def winner(f: Field) -> Column:
        if f.rule == "recent":
            return F.min(won(f)).alias(won(f))
        if f.rule == "trusted":
            order = trusted
        elif f.rule == "longest":
            order = [(-F.char_length(places[f.columns[0]])).alias("length"), *trusted]
        elif f.rule == "fullest":
            missing = sum((F.col(places[c]).isNull().cast("int") for c in f.columns), F.lit(0))
            return F.min(F.struct(missing.alias("missing"), *trusted, *value(f))).alias(won(f))
        elif f.rule == "within":
            of = next(x for x in early if x.name == f.of)
            same = F.lit(True)
            for i, c in enumerate(of.columns):
                same = same & F.col(places[c]).eqNullSafe(F.col(f"{won(of)}.c{i}"))
            order = [(~same).alias("other"), *late]
        else:
            raise ValueError(f"no rule {f.rule!r}")
        return F.min(F.when(present(f), F.struct(*order, *value(f)))).alias(won(f))

    parts = known.groupBy("key", "salt").agg(F.count("*").alias("n_records"), F.sum(F.col("stale").cast("long")).alias("n_stale"), *map(winner, fields))
    merged = parts.groupBy("key").agg(F.sum("n_records").alias("n_records"), F.sum("n_stale").alias("n_stale"), *[F.min(won(f)).alias(won(f)) for f in fields])
    out = [F.col("key.id").alias("cluster_id"), "n_records", "n_stale"]
    for f in fields:
        out += [F.col(f"{won(f)}.c{i}").alias(c) for i, c in enumerate(f.columns)]
    for f in fields:
        supplied = F.lit(False)
        for i in range(len(f.columns)):
            supplied = supplied | F.col(f"{won(f)}.c{i}").isNotNull()
        out.append(F.when(supplied, F.col(f"{won(f)}.id")).alias(f"{f.name}_from"))
    made = staged(merged.select(*out), "survivorship-records")
    dropped(rows)
    return made
