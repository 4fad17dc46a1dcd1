"""Hierarchical weighted hash tree: region, rack, shard.

At each level every child of the chosen node draws ``-ln(u) / weight`` with
``u`` a hash of (key, child path); the smallest draw wins. A child's draw
depends on nothing but the key, its own path and its own weight, so changing
a weight moves keys only into or out of the subtree whose weight changed: a
heavier child can only win keys, a lighter one only lose them. A new shard
joins as a region of its own; keys move only into it (law ``key``).

Rows: null keys all hash alike and land in one shard; repeated rows each get
a slot; a null text has size 16 and the crc32 of no bytes (0); an empty table
gives an empty table. Only the named columns are read, so other columns with
any name may be present.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import uniform

SLOT_BLOCKS = 512


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    number: int
    weight: float = 1.0


def even_tree(n: int, racks: int = 2, per_rack: int = 5) -> list[Shard]:
    """Shards 0..n-1 dealt to regions of ``racks`` racks of ``per_rack``."""
    return [Shard(f"g{i // (racks * per_rack)}", f"r{i // per_rack % racks}", i) for i in range(n)]


def with_shard(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, in a region of its own."""
    n = max((s.number for s in tree), default=-1) + 1
    return [*tree, Shard(f"new{n}", "r0", n, weight)]


def _children(tree: list[Shard], depth: int) -> dict[str, dict[str, float]]:
    out: dict[str, dict[str, float]] = {}
    for s in tree:
        path = [s.region, f"{s.region}/{s.rack}", f"{s.region}/{s.rack}/{s.number}"]
        node = path[depth - 1] if depth else ""
        kids = out.setdefault(node, {})
        kids[path[depth]] = kids.get(path[depth], 0.0) + s.weight
    return out


def tree_shard(key: Column, tree: list[Shard], seed: str = "0") -> Column:
    """Shard number of ``key`` as a column expression."""
    if not tree or any(not s.weight > 0 for s in tree):
        raise ValueError("a tree needs shards of positive weight")
    node = F.lit("")
    for depth in range(3):
        kids = F.create_map(*[x for parent, of in sorted(_children(tree, depth).items()) for x in (
            F.lit(parent), F.array(*[F.struct(F.lit(k).alias("path"), F.lit(w).alias("w")) for k, w in sorted(of.items())]))])
        draws = F.transform(F.element_at(kids, node), lambda c: F.struct(
            (-F.log(uniform(key, seed, c["path"])) / c["w"]).alias("draw"), c["path"].alias("path")))
        node = F.array_min(draws)["path"]
    return F.element_at(F.split(node, "/"), 3).cast("int")


def shard_rows(df: DataFrame, tree: list[Shard], grown: list[Shard] | None = None, key: str = "doc_id",
               text: str = "text", seed: str = "0") -> DataFrame:
    """One row per input row: key, ``size`` (UTF-8 bytes + 16),
    ``text_crc32``, ``shard``, ``slot`` (gapless from 0 within the shard) and
    ``grown_shard`` (the shard under the ``grown`` tree, else null)."""
    body = F.coalesce(F.col(text), F.lit(""))
    k = F.col(key)
    block = F.pmod(F.xxhash64(F.lit(17), k), F.lit(SLOT_BLOCKS)).cast("int")
    keyed = df.select(k, tree_shard(k, tree, seed).alias("shard"), block.alias("__block"),
                      (F.octet_length(body) + 16).cast("long").alias("size"),
                      F.crc32(body.cast("binary")).alias("text_crc32"),
                      (tree_shard(k, grown, seed) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    # at most shards x SLOT_BLOCKS rows, whatever the input: a proven bound for the broadcast
    counts = (df.select(tree_shard(k, tree, seed).alias("shard"), block.alias("__block"))
              .groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("__n")))
    before = F.sum("__n").over(Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "__block", F.coalesce(before, F.lit(0)).alias("__before"))
    at = F.row_number().over(Window.partitionBy("shard", "__block").orderBy(k, "text_crc32", "size")) - 1
    return (keyed.withColumn("__at", at).join(F.broadcast(offsets), ["shard", "__block"])
            .select(key, "size", "text_crc32", "shard", (F.col("__at") + F.col("__before")).cast("long").alias("slot"),
                    "grown_shard"))
