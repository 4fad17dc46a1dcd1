"""Exact top-k search of binary codes by incremental multi-index hashing.

A code is split into SEGMENTS parts. A block of codes is indexed by the value
of each part. A query probes the parts' values in order of growing radius r:
after part s at radius r, a code not yet met differs from the query in at
least r + 1 bits of the parts up to s and r bits of the others, so by
``SEGMENTS * r + s + 1`` bits at least. The search of a block ends once the
k-th verified distance is below that bound: its answer is provably whole.
Blocks of queries meet blocks of codes; the best k of all blocks are kept.

Rows: a null vector, one of another length, or one with a null or NaN gives a
null code, which neither asks nor is found; ties in distance go to the
smaller key; repeated rows are found once each; fewer than k codes give fewer
rows; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_arrow

BITS, SEGMENTS = 64, 4
CODE_BLOCK, QUERY_BLOCK = 1 << 17, 256


def sign_code(vector: Column, bits: int = BITS) -> Column:
    """Bit i of the code tells whether component i is above 0."""
    bit = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bit, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    whole = (F.size(vector) == bits) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    return F.when(whole, code)


class MultiIndex:
    """The codes of one block by the value of each part."""

    def __init__(self, keys: np.ndarray, codes: np.ndarray):
        order = np.argsort(keys, kind="stable")  # positions then order as keys do
        self.keys, self.codes = keys[order], codes[order].view(np.uint64)
        self.width = BITS // SEGMENTS
        self.parts = []
        for s in range(SEGMENTS):
            value = self.part(self.codes, s)
            at = np.argsort(value, kind="stable")
            self.parts.append((at, np.searchsorted(value[at], np.arange((1 << self.width) + 1))))
        values = np.arange(1 << self.width)
        weight = np.bitwise_count(values)
        self.masks = [values[weight == r] for r in range(self.width + 1)]

    def part(self, codes, s: int):
        return ((codes >> np.uint64(s * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def nearest(self, code: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and distances of the k nearest codes, ties by key."""
        met = np.zeros(len(self.codes), bool)
        at, dist = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for r, masks in enumerate(self.masks):
            for s, (order, starts) in enumerate(self.parts):
                probe = int(self.part(code, s)) ^ masks
                a, n = starts[probe], starts[probe + 1] - starts[probe]
                if n.any():
                    place = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                    found = order[place]
                    found = found[~met[found]]
                    met[found] = True
                    at = np.concatenate((at, found))
                    dist = np.concatenate((dist, np.bitwise_count(self.codes[found] ^ code).astype(np.int64)))
                    if len(at) > k:
                        best = np.lexsort((at, dist))[:k]
                        at, dist = at[best], dist[best]
                if len(at) >= k and dist.max(initial=0) < SEGMENTS * r + s + 1:
                    return self._sorted(at, dist)
        return self._sorted(at, dist)

    def _sorted(self, at, dist):
        best = np.lexsort((at, dist))
        return self.keys[at[best]], dist[best]


def _packed(rows: DataFrame, size: int, id_name: str, column: str, total: int) -> DataFrame:
    """Rows (key, code) in blocks of about ``size``: number, keys, codes."""
    n = max(1, -(-total // size))
    block = F.pmod(F.xxhash64("key", "code"), F.lit(n)).cast("int")
    return (rows.withColumn(id_name, block).groupBy(id_name)
            .agg(F.collect_list(F.struct("key", "code")).alias(column)))


def top_k(df: DataFrame, queries: Column, key: str = "vec_id", code: str = "code", k: int = 10) -> DataFrame:
    """For each row where ``queries`` holds, its k nearest rows of ``df``
    (itself among them): query_id, rank from 1, neighbour_id, distance."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(code).alias("code"), queries.alias("asks")).where("key is not null and code is not null")
    total, asking = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    codes = _packed(rows.select("key", "code"), CODE_BLOCK, "block", "codes", total)
    asked = _packed(rows.where("asks").select("key", "code"), QUERY_BLOCK, "asked_block", "asked", asking)
    n = max(1, -(-total // CODE_BLOCK))
    pairs = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(codes, "block")

    def search(batches):
        for batch in batches:
            for i in range(len(batch)):
                part = {name: batch.column(name).slice(i, 1).flatten() for name in ("codes", "asked")}
                get = {name: (p.field("key").to_numpy(zero_copy_only=False), p.field("code").to_numpy(zero_copy_only=False)) for name, p in part.items()}
                index = MultiIndex(*get["codes"])
                ids, near, dist = [], [], []
                for q, c in zip(*get["asked"], strict=True):
                    a, d = index.nearest(np.array(c, np.int64).view(np.uint64)[()], k)
                    ids.append(np.full(len(a), q))
                    near.append(a)
                    dist.append(d)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (ids, near, dist)],
                                                 ["query_id", "neighbour_id", "distance"])

    found = map_arrow(pairs.select("codes", "asked"), search, "query_id long, neighbour_id long, distance long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbour_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "neighbour_id", "distance")
