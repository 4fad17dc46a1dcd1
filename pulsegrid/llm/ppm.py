"""Language-model scores by prediction by partial matching over bytes.

The trie of byte contexts up to ORDER is learned from all training documents
and kept as Spark tables, one per order: (context, symbol) counts. Escapes
follow method D (a context seen n times with q symbols escapes with q / 2n,
a symbol seen c times has (2c - 1) / 2n), and symbols seen in a context are
excluded from all shorter ones after an escape; below order 0 the symbols left are uniform. A context
never seen in training is skipped without cost. Texts start with pad bytes
and end with an end symbol, neither of which UTF-8 contains, so the model is
a distribution over whole texts. The same pass counts words for the base
score, a smoothed word model.

Documents are dealt to chunks of about CHUNK_BYTES by hash. A chunk's
distinct (ORDER + 1)-byte strings and words meet the tables by a join and come
back to the chunk, which is then scored: no table is broadcast or collected,
and memory is bounded by the chunk, however large the corpus or its trie.

Rows: a null text is empty (only the end symbol is scored); a null key is
hashed as empty text to tell training from held-out rows; repeated rows count
and are scored each; without training rows every symbol has probability
1/256; very long texts are scored whole, about a megabyte at a time; an empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import _LOWER, map_arrow, ship_package, stage_table, text_slices, word_keys, word_spans

ORDER = 4
CHUNK_BYTES = 32 << 20
PAD, END = 0xFE, 0xFF
SYMBOLS = 256
BLOCK = 1 << 20
ROW_BITS = 64 - 8 * (ORDER + 1)  # a row number takes the bits that a string leaves


def _strings(data: np.ndarray, offsets: np.ndarray):
    """Yield (keys, rows): the (ORDER + 1)-byte string that ends at each
    symbol of each text, as an integer, in blocks."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    total = len(data) + n * (ORDER + 1)
    shift = np.arange(n) * (ORDER + 1) + ORDER
    wide = np.full(total, PAD, np.uint8)
    symbol = np.zeros(total, bool)
    row = np.repeat(np.arange(n), sizes + ORDER + 1)
    place = np.arange(len(data)) + np.repeat(shift, sizes)
    wide[place] = _LOWER[data]
    wide[offsets[1:] + shift] = END
    symbol[place] = True
    symbol[offsets[1:] + shift] = True
    for a in range(0, total, BLOCK):
        at = np.flatnonzero(symbol[a:a + BLOCK]) + a  # never among the first ORDER bytes
        keys = np.zeros(len(at), np.uint64)
        for back in range(ORDER, -1, -1):
            keys = (keys << np.uint64(8)) | wide[at - back].astype(np.uint64)
        yield keys, row[at]


def _uniques(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their summed counts."""
    if not pairs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*pairs, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often they stand in training rows."""
    packed = np.sort((keys << np.uint64(1)) | train.astype(np.uint64)) if len(keys) else keys
    bare = packed >> np.uint64(1)
    first = np.flatnonzero(np.concatenate(([True], bare[1:] != bare[:-1]))) if len(bare) else np.zeros(0, np.int64)
    counts = np.add.reduceat((packed & np.uint64(1)).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return bare[first], counts


def _word_list(data, offsets):
    starts, ends, rows = word_spans(data, offsets)
    return word_keys(data, starts, ends) >> np.uint64(1), rows  # 63 bits, to be a Spark long


def _vocabulary(docs: DataFrame) -> DataFrame:
    """chunk, kind (0 word, 1 string), key, n (count in training rows), over
    the distinct keys of each chunk. ``docs`` is clustered by chunk."""

    def rows(batches):
        chunk, held = None, ([], [])

        def out():
            for kind, pairs in enumerate(held):
                keys, n = _uniques(pairs)
                for a in range(0, len(keys), BLOCK):
                    k = keys[a:a + BLOCK]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), chunk, np.int32)), pa.array(np.full(len(k), kind, np.int32)),
                                                      pa.array(k.astype(np.int64)), pa.array(n[a:a + BLOCK])], ["chunk", "kind", "key", "n"])
                pairs.clear()

        for batch in batches:
            chunks = batch.column(0).to_numpy()
            for a in (edges := [0, *np.flatnonzero(np.diff(chunks)) + 1, len(chunks)])[:-1]:
                if a == len(chunks):
                    continue
                b = edges[edges.index(a) + 1]
                if chunk is not None and chunk != chunks[a]:
                    yield from out()
                chunk = chunks[a]
                train = batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False)
                for first, data, offsets in text_slices(batch.column(2).slice(a, b - a)):
                    here = train[first:first + len(offsets) - 1]
                    words, of = _word_list(data, offsets)
                    held[0].append(_counted(words, here[of]))
                    for keys, of in _strings(data, offsets):
                        held[1].append(_counted(keys, here[of]))
                    for pairs in held:
                        if len(pairs) >= 16:
                            pairs[:] = [_uniques(pairs)]
        if chunk is not None:
            yield from out()

    return map_arrow(docs.select("chunk", "train", "text"), rows, "chunk int, kind int, key long, n long")


def trie_scores(strings: DataFrame) -> DataFrame:
    """``strings`` (key, n) of (ORDER + 1)-byte strings, n 0 where only held-
    out texts have them, to (key, score): log10 of the probability of the
    last byte after the others. A context has at most SYMBOLS rows, so the
    windows are small. For a symbol not seen after a context, ``below`` is
    its probability in the shorter contexts with the seen ones excluded."""
    levels = [strings.select("key", "n")]
    for k in range(ORDER - 1, -1, -1):
        mask = (1 << 8 * (k + 1)) - 1
        levels.insert(0, levels[0].groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("n")))
    context = Window.partitionBy("context")
    lower = None
    for k, level in enumerate(levels):
        t = level.withColumn("context", F.shiftright("key", 8))
        t = t.withColumn("seen", F.sum("n").over(context)).withColumn("kinds", F.sum((F.col("n") > 0).cast("long")).over(context))
        if k == 0:
            left = F.greatest(F.lit(1), SYMBOLS - F.col("kinds"))
            t = t.withColumn("below", 1.0 / left)
        else:
            t = t.withColumn("short", F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1)))
            t = t.join(lower, "short")
            t = t.withColumn("left_n", F.col("seen_") - F.sum(F.when(F.col("n") > 0, F.col("n_")).otherwise(0)).over(context))
            t = t.withColumn("left_kinds", F.col("kinds_") - F.col("kinds"))
            rest = 2 * F.col("left_n")
            t = t.withColumn("below", F.when(F.col("seen") == 0, F.col("p_"))
                             .when(F.col("n_") > 0, (2 * F.col("n_") - 1) / F.greatest(F.lit(1), rest))
                             .otherwise(F.when(rest > 0, F.col("left_kinds") / F.greatest(F.lit(1), rest)).otherwise(1.0) * F.col("below_")))
        whole = F.greatest(F.lit(1), 2 * F.col("seen"))
        t = t.withColumn("p", F.when(F.col("seen") == 0, F.col("below")).when(F.col("n") > 0, (2 * F.col("n") - 1) / whole)
                         .otherwise(F.col("kinds") / whole * F.col("below")))
        lower = t.select(F.col("key").alias("short"), *[F.col(c).alias(c + "_") for c in ("n", "seen", "kinds", "below", "p")])
    return t.select("key", F.log10("p").alias("score"))


def score_documents(df: DataFrame, train, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: key, train, n_tokens, n_known, train_tokens,
    base_score and score. ``train`` is a column that marks training rows."""
    docs = df.select(F.col(key).alias("key"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size, trained = docs.agg(F.sum(F.octet_length("text")), F.count(F.when(F.col("train"), 1))).first()
    chunks = max(1, -(-int(size or 0) // chunk_bytes))
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("key", "text"), F.lit(chunks)).cast("int"))
    seen = stage_table(_vocabulary(docs.repartition(chunks, "chunk").sortWithinPartitions("chunk")), "chunk-vocabulary")
    # words: training count c; a word is new where its first chunk holds it
    every = Window.partitionBy("key")
    words = (seen.where("kind = 0").withColumn("c", F.sum("n").over(every)).withColumn("first", F.min("chunk").over(every))
             .select("chunk", "kind", "key", F.col("c").cast("double").alias("value"), (F.col("first") == F.col("chunk")).alias("first")))
    strings = seen.where("kind = 1")
    scores = trie_scores(strings.groupBy("key").agg(F.sum("n").alias("n")))
    strings = strings.join(scores, "key").select("chunk", "kind", "key", F.col("score").alias("value"), F.lit(False).alias("first"))
    kind = df.schema[key].dataType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        sort = lambda t: (k[o := np.argsort(k)], t["value"].to_numpy()[o]) if len(k := t["key"].to_numpy().astype(np.uint64)) else (k, np.zeros(0))
        of = right["kind"].to_numpy()
        word_at, word_n = sort(right.filter(pa.array(of == 0)))
        string_at, string_score = sort(right.filter(pa.array(of == 1)))
        fresh = right["first"].to_numpy(zero_copy_only=False) & (right["value"].to_numpy() > 0)
        sums = (float(right["value"].to_numpy()[right["first"].to_numpy(zero_copy_only=False)].sum()), int(fresh.sum()))
        n = len(left)
        tokens, known, base, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for first, data, offsets in text_slices(left["text"]):
            rows = len(offsets) - 1
            part = slice(first, first + rows)
            keys, row = _word_list(data, offsets)
            if len(keys):
                some, inverse = np.unique(keys, return_inverse=True)
                c = word_n[np.searchsorted(word_at, some)][inverse]
                tokens[part] = np.bincount(row, minlength=rows)
                known[part] = np.bincount(row, c > 0, rows).astype(np.int64)
                base[part] = np.bincount(row, np.log10(c + 0.1), rows)
            for keys, row in _strings(data, offsets):
                for lo in range(int(row[0]) if len(row) else 0, int(row[-1]) + 1 if len(row) else 0, 1 << ROW_BITS):
                    here = slice(*np.searchsorted(row, (lo, lo + (1 << ROW_BITS))))
                    packed = np.sort((keys[here] << np.uint64(ROW_BITS)) | (row[here] - lo).astype(np.uint64))
                    bare = packed >> np.uint64(ROW_BITS)
                    if not len(bare):
                        continue
                    cut = np.flatnonzero(np.concatenate(([True], bare[1:] != bare[:-1])))
                    value = string_score[np.searchsorted(string_at, bare[cut])]
                    value = np.repeat(value, np.diff(np.concatenate((cut, [len(bare)]))))
                    got = np.bincount((packed & np.uint64((1 << ROW_BITS) - 1)).astype(np.int64), value)
                    total[first + lo:first + lo + len(got)] += got
        first = np.zeros(n, bool)
        first[:1] = True
        return pa.table({"key": left["key"], "train": left["train"], "tokens": tokens, "known": known, "base": base, "score": total,
                         "chunk_tokens": np.where(first, sums[0], 0.0), "chunk_words": np.where(first, sums[1], 0).astype(np.int64)})

    ship_package(df.sparkSession)
    parts = docs.groupBy("chunk").cogroup(words.union(strings).groupBy("chunk")).applyInArrow(
        score, f"key {kind}, train boolean, tokens long, known long, base double, score double, chunk_tokens double, chunk_words long")
    parts = stage_table(parts, "chunk-scores")
    n_words, distinct = parts.agg(F.sum("chunk_tokens"), F.sum("chunk_words")).first()
    all_tokens = int(n_words or 0) + trained
    distinct = int(distinct or 0) + (trained > 0)
    per_token = float(np.log10(all_tokens + 0.1 * (distinct + 1)))
    n = F.col("tokens") + 1
    return parts.select(
        F.col("key").alias(key), "train", n.alias("n_tokens"), (F.col("known") + int(trained > 0)).alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + float(np.log10(trained + 0.1)) - n * per_token).alias("base_score"), "score")
