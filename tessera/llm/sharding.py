"""Sharding by a hierarchical weighted hash tree.

Levels: region, rack, shard. A key descends from the root; at each node every child draws -ln(u) / weight, where u is a
hash of key and child, and the smallest draw wins, so that a child is chosen in proportion to its weight. A draw depends
on the key and the child alone. When a weight rises, keys only move towards that child; the other subtrees exchange nothing
among themselves. A cluster has a base of fixed size, laid out over regions and racks, and every further shard is a region
of its own; so growth by one, from any number, moves rows into the new shard alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ranked, unit, written

SHARDS = 40
#: Shards of the base. It never changes while a cluster grows: another base is another placement.
BASE = 40
REGIONS, RACKS = 4, 2
#: Bytes that a document costs besides its text.
OVERHEAD = 16

Tree = dict[str, dict[str, dict[str, float]]]


def tree(shards: int = SHARDS, regions: int = REGIONS, racks: int = RACKS, base: int = BASE) -> Tree:
    """`shards` shards of weight 1: the `base` first ones dealt evenly over regions and racks, each further one a region.

    `tree(n)` is `tree(n + 1)` without its last region. Fewer shards than the base are refused: a smaller cluster is begun
    with a smaller base, and keeps it.
    """
    if shards < base:
        raise ValueError(f"{shards} shards are fewer than the base of {base}")
    out: Tree = {}
    places = regions * racks
    for s in range(base):
        p = s * places // base
        out.setdefault(f"g{p // racks}", {}).setdefault(f"g{p // racks}k{p % racks}", {})[f"s{s}"] = 1.0
    for s in range(base, shards):
        out[f"n{s}"] = {f"n{s}k0": {f"s{s}": 1.0}}
    return out


def _levels(t: Tree) -> list[dict[str, list[tuple[str, float]]]]:
    rack = {k: sum(leaves.values()) for racks in t.values() for k, leaves in racks.items()}
    region = {g: sum(rack[k] for k in racks) for g, racks in t.items()}
    return [{"": list(region.items())}, {g: [(k, rack[k]) for k in racks] for g, racks in t.items()}, {k: list(leaves.items()) for racks in t.values() for k, leaves in racks.items()}]


def place(key: Column, t: Tree) -> Column:
    """The number of the shard that `key` falls to; a null key falls to one place."""
    node: Column = F.lit("")
    for level in _levels(t):
        children = F.create_map(*[x for name, kids in level.items() for x in (F.lit(name), F.array(*[F.struct(F.lit(c).alias("c"), F.lit(float(w)).alias("w")) for c, w in kids]))])

        def best(kids: Column) -> Column:
            return F.array_min(F.transform(kids, lambda k: F.struct((-F.log(unit(key, k["c"])) / k["w"]).alias("draw"), k["c"].alias("c"))))["c"]

        node = best(F.element_at(children, node))
    return F.substring(node, 2, 9).cast("int")


def shard(docs: DataFrame, shards: int = SHARDS, base: int = BASE) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law ('key'), shard, slot, grown_shard (with one shard more).

    size: UTF-8 bytes of the whole text (null or empty: none) + 16. Slots number the rows of a shard from 0; equal rows take
    neighbouring slots. A null doc_id is a key like another. Only doc_id and the number of shards decide, so repeated rows
    stay together, and `grown_shard` is the `shard` of `shards + 1`. An empty table has no rows; other columns are left out.
    Draws are computed once and written to the shared folder.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(F.col("doc_id"), tree(shards, base=base)).alias("shard"),
        place(F.col("doc_id"), tree(shards + 1, base=base)).alias("grown_shard"),
    )
    out = ranked(written(rows, "placements"), "shard", ["doc_id", "text_crc32"], "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
