"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import settle

MAX_ROUNDS = 60
#: Tasks that the pairs of one node are dealt to, at least, and how many pairs make it one more.
SALTS, SALTED_PAIRS = 32, 100_000


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _with_least(pairs: DataFrame, salts: int) -> DataFrame:
    """Pairs (u, v) with m, the least v of each u.

    Minima are taken by (u, salt) and then by u, and go back to the pairs by (u, salt), so a node with a third of
    all pairs is spread over that many tasks."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)))
    parts = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"))
    return salted.join(parts.select("u", "salt").join(least, "u"), ["u", "salt"]).drop("salt")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link to another; the root is the smallest node reachable.

    ``links`` has two columns ``u`` and ``v`` of one type; nulls, loops and repeats are ignored.  Each round links
    all larger neighbours of a node to its smallest one, then all smaller ones (large star, small star);
    rounds end when no link changes, after about the logarithm of the longest path.  Minima are combined
    before they are shuffled, no neighbourhood is ever collected, and that of a hub is dealt to many tasks.
    """
    edges = settle(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                   "links")
    sign = _sign(edges)
    for _ in range(MAX_ROUNDS):
        if not sign[0]:
            break
        salts = max(SALTS, sign[0] // SALTED_PAIRS)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, salts).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        starred = _with_least(large.distinct(), salts)
        edges = settle(starred.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(starred.where("v = m").select("u", "v")).distinct(), "links")
        before, sign = sign, _sign(edges)
        if sign == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
