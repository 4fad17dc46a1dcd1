"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes; positions where tokens of both end cut
them into groups. Walking the two arrays of token ends, the current shift
between the indexes is the diagonal: windows of doubling width are compared
along it, so a stretch of one-to-one tokens is jumped in few comparisons and
its end found by halving the last window. Where the diagonal breaks, the
irregular group is resolved token by token, which also gives its links, and
the shift is updated.

``align_documents`` applies this to a table. A pair's corpus count (documents
that hold it linked) comes from a pre-aggregated shuffle of the documents'
distinct pairs; the counts return to the documents in slices of at most
``SLICE_PAIRS`` pairs, the only thing that is broadcast, one scan of the
staged links per slice, so memory is bounded however many pairs there are.

Rows: texts that are null or empty, or that a tokenizer does not spell byte
for byte, have no tokens: zeros and an empty digest. Repeated rows count as
documents each; ties for an id's best partner all count; null and repeated
keys are kept as they are; an empty table gives an empty table; very long
texts are aligned whole. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.chunks import ByteLevelCoder, ChunkCoder, PieceCoder, coder
from pulsegrid.llm.common import map_arrow, stage_table, text_slices

SLICE_PAIRS = 4_000_000
STEP = 2 << 20  # bytes of text aligned at once
WIDTH = 15  # bits of an id of the second vocabulary in a pair


def diagonal_runs(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int], list[int], list[int], list[int], list[int]]:
    """Align two increasing lists of token ends with the same last end.
    Returns one-to-one stretches (start in a, start in b, length), irregular
    groups (end in a, end in b) and the links inside irregular groups (index
    in a, index in b)."""
    run_a, run_b, run_n, end_a, end_b, link_a, link_b = [], [], [], [], [], [], []
    i, shift, n = 0, 0, len(a)
    while i < n:
        start, width = i, 1
        while True:  # along the diagonal, in windows of doubling width
            part = a[i:i + width]
            if part != b[i + shift:i + shift + len(part)]:
                break
            i += len(part)
            width += width
            if i == n:
                break
        if i < n:
            while width > 1:  # the first mismatch lies in the last window
                width >>= 1
                if a[i:i + width] == b[i + shift:i + shift + width]:
                    i += width
        if i > start:
            run_a.append(start)
            run_b.append(start + shift)
            run_n.append(i - start)
        if i == n:
            break
        j = i + shift
        x, y = a[i], b[j]
        link_a.append(i)
        link_b.append(j)
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
            link_a.append(i)
            link_b.append(j)
        i += 1
        end_a.append(i)
        end_b.append(j + 1)
        shift = j + 1 - i
    return run_a, run_b, run_n, end_a, end_b, link_a, link_b


def _stretch(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ..., start + n - 1 of every stretch, one after the other."""
    ends = np.cumsum(n)
    return np.repeat(start - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


class Alignment:
    """Groups and links of two token arrays that spell the same bytes, over
    one document or several, one after the other."""

    def __init__(self, ends_a: np.ndarray, ends_b: np.ndarray):
        run_a, run_b, run_n, end_a, end_b, link_a, link_b = (np.array(x, np.int64) for x in diagonal_runs(ends_a.tolist(), ends_b.tolist()))
        one_a, one_b = _stretch(run_a, run_n), _stretch(run_b, run_n)
        #: ends of the groups as token numbers, ascending
        self.group_a, self.group_b = np.sort(np.concatenate((one_a + 1, end_a))), np.sort(np.concatenate((one_b + 1, end_b)))
        #: token numbers of every linked pair
        self.link_a, self.link_b = np.concatenate((one_a, link_a)), np.concatenate((one_b, link_b))


class _Spelling:
    """Both coders, and tables that turn their tokens into bytes and into the
    decimal text of groups."""

    def __init__(self, path_a: str, path_b: str):
        self.coders: tuple[ChunkCoder, ChunkCoder] = coder(ByteLevelCoder, path_a, True), coder(PieceCoder, path_b)
        self.bytes = [pa.array(c.table, pa.large_binary()) for c in self.coders]
        self.n = max(len(c.table) for c in self.coders)
        if len(self.coders[1].table) > 1 << WIDTH or len(self.coders[0].table) >> (32 - WIDTH):
            raise ValueError("vocabularies too large for 32-bit pairs")
        self.decimal = pa.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(self.n)], pa.large_binary())

    def spelled(self, data: np.ndarray, offsets: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, row starts, and which rows the tokens spell byte for byte."""
        ids, at = self.coders[which].ids(data, offsets)
        joined = self.bytes[which].take(pa.array(ids.astype(np.int64)))
        ends = np.frombuffer(joined.buffers()[1], np.int64, len(ids) + 1)[at]
        raw = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
        if np.array_equal(ends, offsets) and np.array_equal(raw[:len(data)], data):
            return ids, at, np.ones(len(at) - 1, bool)
        same = [np.array_equal(raw[a:b], data[c:d]) for (a, b), (c, d) in zip(pairwise(ends.tolist()), pairwise(offsets.tolist()), strict=True)]
        return ids, at, np.array(same, bool)

    def groups(self, ids_a: np.ndarray, ids_b: np.ndarray, found: Alignment) -> tuple[memoryview, np.ndarray]:
        """Text `a1,a2|b1;a3|b2;` of all groups, and where each token's part
        starts, tokens in the order of the text."""
        n_a, n_b = np.diff(found.group_a, prepend=0), np.diff(found.group_b, prepend=0)
        code_a, code_b = ids_a.astype(np.int64), ids_b.astype(np.int64)
        code_a[found.group_a - 1] += self.n
        code_b[found.group_b - 1] += 2 * self.n
        out = np.empty(len(ids_a) + len(ids_b), np.int64)
        out[np.arange(len(ids_a)) + np.repeat(found.group_b - n_b, n_a)] = code_a
        out[np.arange(len(ids_b)) + np.repeat(found.group_a, n_b)] = code_b
        text = self.decimal.take(pa.array(out))
        return memoryview(text.buffers()[2] or b""), np.frombuffer(text.buffers()[1], np.int64, len(out) + 1)


_SPELLINGS: dict[tuple[str, str], _Spelling] = {}


def _aligned_rows(column: pa.Array, paths: tuple[str, str]):
    """Per document: n_a, n_b, n_groups, n_links, group text, pairs, times."""
    if paths not in _SPELLINGS:
        _SPELLINGS[paths] = _Spelling(*paths)
    both = _SPELLINGS[paths]
    texts = column.cast(pa.large_string()).fill_null("")
    full = pc.binary_length(texts).to_numpy() > 0
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
    for first, data, offsets in text_slices(spaced, STEP):
        ids_a, at_a, good_a = both.spelled(data, offsets, 0)
        ids_b, at_b, good_b = both.spelled(data, offsets, 1)
        n = len(offsets) - 1
        good = good_a & good_b & full[first:first + n]
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, np.diff(at_a))], ids_b[np.repeat(good, np.diff(at_b))]
            at_a, at_b = (np.concatenate(([0], np.cumsum(np.where(good, np.diff(at), 0)))) for at in (at_a, at_b))
        found = Alignment(np.cumsum(both.coders[0].lengths[ids_a]), np.cumsum(both.coders[1].lengths[ids_b]))
        text, part = both.groups(ids_a, ids_b, found)
        borders = part[at_a + at_b].tolist()
        groups = np.diff(np.searchsorted(found.group_a, at_a, "right"))
        row = np.searchsorted(at_a, found.link_a, "right") - 1
        keys, times = np.unique((row.astype(np.uint64) << np.uint64(32)) | (ids_a[found.link_a].astype(np.uint64) << np.uint64(WIDTH))
                                | ids_b[found.link_b].astype(np.uint64), return_counts=True)
        at = np.searchsorted(keys, np.arange(n + 1, dtype=np.uint64) << np.uint64(32)).tolist()
        pairs, times = keys.astype(np.uint32), times.astype(np.uint32)
        links = np.bincount(row, minlength=n)
        for d in range(n):
            a, b = at[d], at[d + 1]
            yield (int(at_a[d + 1] - at_a[d]), int(at_b[d + 1] - at_b[d]), int(groups[d]), int(links[d]),
                   text[borders[d]:max(borders[d], borders[d + 1] - 1)], pairs[a:b].tobytes(), times[a:b].tobytes())


def aligned(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", keep_groups: bool = False) -> DataFrame:
    """One row a document: key, n_a, n_b, n_groups, n_links, groups_sha256,
    its distinct pairs (id of a << 15 | id of b, little-endian 32-bit) and how
    often it links each, and with ``keep_groups`` the text of the groups."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, __pairs binary, __times binary" + ", groups string" * keep_groups

    def run(batches):
        for batch in batches:
            rows = [(*r[:4], hashlib.sha256(r[4]).hexdigest() if r[0] else "", *r[5:], *([bytes(r[4]).decode()] * keep_groups))
                    for r in _aligned_rows(batch.column(1), (path_a, path_b))]
            columns = list(zip(*rows, strict=True)) if rows else [()] * (7 + keep_groups)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()] + [pa.string()] * keep_groups
            names = [key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "__pairs", "__times"] + ["groups"] * keep_groups
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], names)

    return map_arrow(df.select(key, text), run, schema)


def pair_counts(documents: DataFrame) -> DataFrame:
    """pair, docs (documents that hold it), best (docs is the highest of the
    pair's first id). Each task adds its documents up before the shuffle; a
    first id meets at most one row per id of the second vocabulary."""

    def run(batches):
        held, size = [], 0

        def flush():
            pairs, docs = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(docs)], ["pair", "docs"])

        for batch in batches:
            held += [np.frombuffer(x, "<u4") for x in batch.column(0).to_numpy(zero_copy_only=False)]
            size += sum(map(len, held[-len(batch):])) if len(batch) else 0
            if size > SLICE_PAIRS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    counts = map_arrow(documents.select("__pairs"), run, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))
    top = F.max("docs").over(Window.partitionBy(F.shiftright("pair", WIDTH)))
    return counts.select("pair", "docs", (F.col("docs") == top).alias("best"))


def align_documents(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", keep_groups: bool = False,
                    slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """``aligned`` with n_best (links whose pair is the most frequent of its
    first id) and count_sum (corpus counts summed over the links)."""
    spark = df.sparkSession
    documents = stage_table(aligned(df, path_a, path_b, key, text, keep_groups), "aligned").withColumn("__row", F.monotonically_increasing_id())
    counts = stage_table(pair_counts(documents), "pair-counts")
    slices = max(1, -(-counts.count() // max(1, slice_pairs * 3 // 4)))
    out = [c for c in documents.columns if c not in ("__pairs", "__times", "__row")]
    carried = documents.select(*(out if slices == 1 else ["__row"]), "__pairs", "__times")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields[:-2]) + ", n_best long, count_sum long"
    parts = [map_arrow(carried, _sums(spark, counts.where(F.pmod(F.xxhash64("pair"), F.lit(slices)) == s)), schema) for s in range(slices)]
    if slices == 1:
        return parts[0]
    sums = reduce(DataFrame.union, parts).groupBy("__row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return documents.join(sums, "__row").select(*out, "n_best", "count_sum")


def _sums(spark: SparkSession, counts: DataFrame):
    """Map function that ends its rows with n_best and count_sum, as far as
    the pairs of ``counts`` (about ``SLICE_PAIRS`` rows at most) go."""
    some = counts.toArrow().sort_by("pair")
    table = spark.sparkContext.broadcast((some["pair"].to_numpy().astype(np.uint32), some["docs"].to_numpy(), some["best"].to_numpy(zero_copy_only=False)))

    def run(batches):
        known, docs, best = table.value
        for batch in batches:
            pairs, times = ([np.frombuffer(x, "<u4") for x in batch.column(c).to_numpy(zero_copy_only=False)] for c in ("__pairs", "__times"))
            at = np.cumsum([0, *map(len, pairs)])
            flat, often = (np.concatenate([np.zeros(0, "<u4"), *x]).astype(np.int64) for x in (pairs, times))
            sums = [np.zeros(len(flat) + 1, np.int64)] * 2
            if len(known):
                where = np.minimum(np.searchsorted(known, flat.astype(np.uint32)), len(known) - 1)
                often *= known[where] == flat
                sums = [np.concatenate(([0], np.cumsum(often * worth[where]))) for worth in (best, docs)]
            kept = [name for name in batch.schema.names if name not in ("__pairs", "__times")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(np.diff(x[at])) for x in sums)], [*kept, "n_best", "count_sum"])

    return run
