"""Connected components of a graph of any size, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .staging import dropped, staged


def _constant(k: int) -> int:
    return (0x5851F42D4C957F2D * (2 * k + 1)) % (1 << 63)


def _scramble(c: Column, k: int) -> Column:
    """A reversible mixing of 64-bit ids by shifts and xors, another for each k."""
    c = c.bitwiseXOR(F.lit(_constant(k)))
    c = c.bitwiseXOR(F.shiftleft(c, 13))
    c = c.bitwiseXOR(F.shiftrightunsigned(c, 17))
    return c.bitwiseXOR(F.shiftleft(c, 23))


def _unscramble(c: Column, k: int) -> Column:
    for shift, by in ((F.shiftleft, 23), (F.shiftrightunsigned, 17), (F.shiftleft, 13)):
        parts = [shift(c, by * j) for j in range(1, 63 // by + 1)]
        for part in parts:
            c = c.bitwiseXOR(part)
    return c.bitwiseXOR(F.lit(_constant(k)))


def component_labels(links: DataFrame, label: str = "components") -> DataFrame:
    """Rows ``(node, root)`` for each node of ``links(a long, b long)``; equal roots mean connected.

    Random contraction: each round every node moves to the neighbour (or itself) of least
    scrambled id, links are renamed and repeated ones dropped.  A round leaves a constant
    share of the nodes on average whatever the shape, so chains and stars alike end after a
    number of rounds that grows with the logarithm of the input.  A hub is no hot key: the
    minimum is combined before its shuffle, and the renaming is a join that Spark may split.

    Nulls and self-links are ignored; an empty input gives an empty result.  The scramble
    is a bijection, so no two nodes tie.  It changes every second round: under a new one half of
    a star's leaves stay where they are, and only the same one again brings them all to the least.
    """
    links = staged(
        links.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
        .distinct(),
        label,
    )
    trail, depth = [], 0
    while not links.isEmpty():
        order = depth // 2
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = (
            both.groupBy("a")
            .agg(F.min(_scramble(F.col("b"), order)).alias("near"))
            .select(F.col("a").alias("node"), _unscramble(F.least("near", _scramble(F.col("a"), order)), order).alias("to"))
        )
        least = staged(least, label)
        trail.append(least)
        to_a = least.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        to_b = least.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        renamed = (
            links.join(to_a, "a").join(to_b, "b").where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        )
        following = staged(renamed, label)
        dropped(links)
        links, depth = following, depth + 1
    dropped(links)
    if not trail:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    out = trail[-1].select("node", F.col("to").alias("root"))
    for step in reversed(trail[:-1]):
        later = out.select(F.col("node").alias("to"), "root")
        out = step.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    if len(trail) > 1:
        out = staged(out, label)
        dropped(*trail)
    return out
