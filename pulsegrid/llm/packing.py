"""Best-fit packing planned on the length histogram.

Documents become token ids, an end id, and pieces of at most ``capacity``
ids. Best-fit decreasing runs over the counts of the histogram (at most
``capacity`` rows, so it fits the driver whatever the corpus): lengths go
from long to short, each into the open sequences with the least room that
still holds it, a run of equal sequences at a time. The plan is a list of
(length, ranks, first sequence, offset) ranges; pieces get a rank within
their length and take the planned slot of that rank by a join.

Rows: a null text is empty and gives the end id alone; repeated rows are
packed each; ties in length are ranked by key, piece and ids; an empty table
gives an empty table; very long texts are tokenized whole (see chunks.py).
Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.chunks import WordEndCoder, coder
from pulsegrid.llm.common import map_arrow, stage_table
from pulsegrid.llm.ranking import numbered

BLOCK_ROWS = 4096
CHUNKS_KEPT, TEXT_BYTES = 150_000, 4 << 20  # a worker's memory of runs, and bytes of text coded at once


def token_pieces(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id",
                 text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32 and, with
    ``keep_ids``, the ids themselves as an array."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches):
        tok = coder(WordEndCoder, tokenizer_path, CHUNKS_KEPT)
        for batch in batches:
            keys = batch.column(0)
            for first, ids, starts in tok.rows(batch.column(1), TEXT_BYTES):
                raw, starts = memoryview(ids.astype("<u4")).cast("B"), (4 * starts).tolist()
                rows: list[tuple] = []
                for i, (a, b) in enumerate(pairwise(starts)):
                    whole = memoryview(bytes(raw[a:b]) + end)
                    for p, at in enumerate(range(0, len(whole), 4 * capacity)):
                        part = whole[at:at + 4 * capacity]
                        rows.append((first + i, p, at // 4, len(part) // 4, zlib.crc32(part), part))
                columns = list(zip(*rows, strict=True))
                out = [keys.take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32())]
                out += [pa.array(c, pa.int64()) for c in columns[2:5]]
                if keep_ids:
                    out.append(pa.array([np.frombuffer(p, "<i4") for p in columns[5]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    return map_arrow(df.select(key, text), pieces, schema)


def best_fit_plan(counts: dict[int, int], capacity: int = 2048) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over {length: count}. Returns rows (length, lo,
    hi, seq, offset, each): the pieces of that length ranked lo..hi-1 go, each
    of them in a run, to sequences seq, seq+1, ..., ``each`` to a sequence,
    from ``offset`` on. A run of sequences with equal room is handled at once,
    so the work and the plan depend on the distinct lengths, not on the counts.
    """
    plan, open_runs, rooms, next_seq = [], {}, [], 0  # open_runs: room -> [(first sequence, number)]

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in open_runs:
                insort(rooms, room)
                open_runs[room] = []
            open_runs[room].append((first, number))

    for length in sorted((x for x, c in counts.items() if c), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece has {length} of 1 to {capacity} ids")
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = open_runs[room].pop()
                if not open_runs[room]:
                    del open_runs[room], rooms[at]
            else:
                room, first, number = capacity, next_seq, -(-left // (capacity // length))
                next_seq += number
            each = room // length
            full = min(number, left // each)
            rest = min(left - full * each, each) if full < number else 0
            if full:
                plan.append((length, rank, rank + full * each, first, capacity - room, each))
                put(room - each * length, first, full)
            if rest:
                plan.append((length, rank + full * each, rank + full * each + rest, first + full, capacity - room, rest))
                put(room - rest * length, first + full, 1)
            put(room, first + full + (rest > 0), number - full - (rest > 0))
            rank += full * each + rest
            left -= full * each + rest
    return plan


def pack(pieces: DataFrame, capacity: int = 2048, key: str = "doc_id") -> DataFrame:
    """``pieces`` (a table read back from storage: it is used three times)
    with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    plan = best_fit_plan(counts, capacity)
    plan_df = spark.createDataFrame(plan, "length long, lo long, hi long, seq long, base long, each long")
    blocks = F.element_at(F.create_map(*[F.lit(x) for n, c in sorted(counts.items()) for x in (n, -(-c // BLOCK_ROWS))]),
                          F.col("length").cast("int")) if counts else F.lit(1)
    ranked = numbered(pieces.withColumn("__block", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), blocks)), ["length"], "__block",
                      [F.col(key), F.col("piece"), F.col("ids_crc32")], "__rank")
    # the plan's length depends on the capacity alone; beyond this size it is joined by a shuffle
    side = F.broadcast(plan_df) if len(plan) <= 200_000 else plan_df
    r, p = ranked.alias("r"), side.alias("p")
    at = F.col("r.__rank") - F.col("p.lo")
    return (r.join(p, (F.col("r.length") == F.col("p.length")) & (F.col("r.__rank") >= F.col("p.lo")) & (F.col("r.__rank") < F.col("p.hi")))
            .select(*[f"r.{c}" for c in pieces.columns],
                    (F.col("p.seq") + F.floor(at / F.col("p.each"))).cast("long").alias("sequence_id"),
                    (F.col("p.base") + at % F.col("p.each") * F.col("r.length")).cast("long").alias("offset")))


def pack_documents(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id",
                   text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Documents to pieces with sequence_id and offset."""
    return pack(stage_table(token_pieces(df, tokenizer_path, capacity, end_id, key, text, keep_ids), "pieces"), capacity, key)


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences themselves, from pieces packed with
    ``keep_ids``: sequence_id, ids. A group holds at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
