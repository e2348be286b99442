"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import replaced

#: Far more rounds than the square of the logarithm of any corpus; the loop ends when nothing changes.
ROUNDS = 100


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame, scratch: list[str] | None = None) -> DataFrame:
    """From links (a, b): node, component (the smallest node reachable), for every node that has a link to another.

    Self-links, repeated links and nulls are dropped; an empty table has no components. Each round's table is written to the
    shared folder and the one before deleted, so a lost executor repeats one round at most. A node with very many links is
    aggregated before it is shuffled, and joined with one row per node, so that its links can be split among tasks. An
    unfinished labelling is an error, never a result. The last table's folder is added to `scratch`.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path: list[str] = []
    edges = replaced(edges, path)
    seen = _signature(edges)
    scratch = [] if scratch is None else scratch
    if not seen[0]:
        scratch += path
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(ROUNDS):
        # large star: each node hangs its larger neighbours on the smallest of its neighbourhood
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: each node hangs its smaller neighbours, and itself, on the smallest of them
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("n")).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = replaced(small.select("e.*").where("a <> b").distinct(), path)
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components are not closed after {ROUNDS} rounds")
    scratch += path
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
