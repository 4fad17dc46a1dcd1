"""Row rank within a group, without a whole-group window.

``row_number().over(Window.partitionBy(g).orderBy(o))`` puts a group into
one task. Here every row gets a block that is a pure function of its order
value, so any number of uses of the frame agree on it; a table of row counts
per (group, block) gives each block's offset; a window per (group, block)
numbers the rows inside the block. Where the order is that of a long
(``rank_by_key``), the blocks come from a tree of counts: a cell of the key's
leading digits that holds too many rows is split by further digits, so no
window passes a bound, neither over rows nor over cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITTERS = 255
HASH_BITS = 60


def key_hash(key: str, seed: int) -> Column:
    """Seeded hash order of a key: the first 60 bits of md5(key/seed), a
    non-negative long that any SQL engine with md5 can compute."""
    text = F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def order_block(df: DataFrame, first: str) -> Column:
    """Block of a row by its first order column: the number of splitters at
    or below the value. The splitters are the values of a bounded sample (the
    SPLITTERS smallest by hash), collected once and inlined, so the block
    depends on the row alone. Nulls are in block 0."""
    picked = df.select(first).where(F.col(first).isNotNull()).distinct().orderBy(F.xxhash64(first), first).limit(SPLITTERS)
    values = sorted(r[0] for r in picked.collect())
    if not values:
        return F.lit(0)
    kind = df.schema[first].dataType
    splitters = F.array(*[F.lit(v).cast(kind) for v in values])
    return F.size(F.filter(splitters, lambda s: s <= F.col(first)))


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank",
                block: Column | None = None) -> DataFrame:
    """Adds ``name`` = 0-based position within ``keys`` by ``order`` (which
    must make rows unique within a group for a deterministic result). Every
    row is kept. ``block``, if given, must be a pure function of the row that
    never decreases along ``order``."""
    keys, order = list(keys), list(order)
    d = df.withColumn("_blk", block if block is not None else order_block(df, order[0]))
    s = d.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_blk").orderBy(*order)) - 1)
    blocks = d.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_bn"))
    before = F.sum("_bn").over(Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_blk").alias("_b"),
                           F.coalesce(before, F.lit(0)).alias("_off"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_blk") == F.col("_b"))
    return s.join(blocks, same).select(*[c for c in df.columns if c != name], (F.col("_off") + F.col("_rn")).alias(name))


BLOCK_ROWS = 65_536
DIGITS = 12  # bits by which a cell of the count tree is split


def rank_by_key(df: DataFrame, keys: Sequence[str], order_key: Column, order: Sequence[str], name: str = "rank",
                bits: int = HASH_BITS, levels: int = 2, bound: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``name`` = 0-based position within ``keys`` by (``order_key``,
    ``order``). ``order_key`` is a long in [0, 2 ** ``bits``). Per key a tree of
    counts with up to ``levels`` levels is built: cells of DIGITS bits each,
    split again only where one holds more than ``bound`` rows. A cell's offset
    is the sum of the cells before it on its level, at most 2 ** DIGITS, so
    rows with one order key, and what the last level cannot part, are all that
    can exceed the bound. Null keys form a group."""
    keys, order = list(keys), list(order)
    path = [f"_c{i}" for i in range(levels)]
    rows = df.withColumn("_k", order_key)
    for i, c in enumerate(path):
        rows = rows.withColumn(c, F.shiftright("_k", max(0, bits - DIGITS * (i + 1))))
    out, open_, within = rows, rows, list(keys)
    offset = F.lit(0).cast("long")
    for i, c in enumerate(path):
        counts = open_.groupBy(*within, c).agg(F.count(F.lit(1)).alias("_n"))
        before = F.sum("_n").over(Window.partitionBy(*within).orderBy(c).rowsBetween(Window.unboundedPreceding, -1))
        within = [*within, c]
        cells = counts.select(*[F.col(k).alias(f"_w{j}") for j, k in enumerate(within)], F.coalesce(before, F.lit(0)).alias(f"_o{i}"), F.col("_n").alias(f"_n{i}"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_w{j}")) for j, k in enumerate(within)])
        gone = [f"_w{j}" for j in range(len(within))]
        out = out.join(cells, same, "left").drop(*gone)
        open_ = open_.join(cells.where(F.col(f"_n{i}") > bound).drop(f"_o{i}", f"_n{i}"), same, "left_semi")
        offset = offset + F.coalesce(F.col(f"_o{i}"), F.lit(0))
    # a cell's rows are numbered on the first level that did not split it
    split = F.lit(True)
    leaf = []
    for i, c in enumerate(path):
        leaf.append(F.when(split, F.col(c)).alias(f"_l{i}"))
        split = split & (F.coalesce(F.col(f"_n{i}"), F.lit(0)) > bound)
    out = out.select(*df.columns, "_k", offset.alias("_o"), *leaf)
    at = F.row_number().over(Window.partitionBy(*keys, *[f"_l{i}" for i in range(levels)]).orderBy("_k", *order)) - 1
    return out.select(*[c for c in df.columns if c != name], (F.col("_o") + at).cast("long").alias(name))


def stratified_folds(df: DataFrame, label: str, key: str = "id", n_splits: int = 5, seed: int = 42,
                     name: str = "fold", bound: int = BLOCK_ROWS) -> DataFrame:
    """Shuffled stratified fold number 0..n_splits-1: rows of each class are
    put in a seeded hash order and dealt round-robin, so per class the fold
    sizes differ by at most one. Rows with a null label get no fold. No window
    holds more than ``bound`` rows with different keys."""
    r = rank_by_key(df.where(F.col(label).isNotNull()), [label], key_hash(key, seed), [key], "_r", bound=bound)
    return r.withColumn(name, (F.col("_r") % n_splits).cast("int")).drop("_r")
