"""Spelling variants by Bloom-guided neighbourhoods.

Words are counted with a bounded memory per task and added up by one shuffle.
The vocabulary fills one blocked Bloom filter per word length, built as an OR
aggregate over (length, block) and broadcast: a block is one 64-bit word, and
the filters together never pass ``FILTER_BYTES``; a vocabulary too large for
``BITS`` bits a word gets fewer bits, so more false positives reach the exact
join, never fewer pairs. Every word's deletions and its replacements by a
later letter are hashed from the word's own hash and probed by their length;
an insertion is the deletion seen from the longer word. Only positives
shuffle, to the join with the vocabulary that removes false ones.

``word_counts`` may garble a fixed share of the runs (one code point deleted
where ``garble`` divides the crc32 of `<key>:<run>`), so that rare variants
exist whatever the corpus.

Rows: a null or empty text has no runs; a null key counts as the empty text
in that crc; repeated rows count each; ties in n go to the smallest word in
code-point order; an empty table gives an empty table; very long texts and
runs are taken whole. Only the named columns are read, so others may have any
name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_arrow, mix, stage_table

LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)  # a-z and U+00C0-U+00FF in Latin-1
RUN = re.compile("[a-zÀ-ÿ]+")
FLUSH_WORDS = 200_000
FILTER_BYTES = 32 << 20
BITS, BITS_SET = 16, 5
LENGTHS = 64  # words of this length or more share a filter
CANDIDATES = 1 << 20  # edits hashed at once


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", garble: int = 199, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """word, n of all words with min_length code points and min_count
    occurrences or more."""

    def run(batches):
        found: Counter[str] = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
                runs = Counter(RUN.findall((t.as_py() or b"").lower().decode()))
                head = zlib.crc32(f"{k.as_py() or ''}:".encode())
                for word, n in runs.items():
                    h = zlib.crc32(word.encode(), head)
                    if h % garble == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= min_length:
                        found[word] += n
                if len(found) > FLUSH_WORDS:
                    yield rows()
                    found.clear()
        yield rows()

    counted = map_arrow(df.select(F.col(key).cast("string"), text), run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- hashes of words and of their edits ------------------------------------

def _place(at: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Part of a word's hash that a letter at a place adds."""
    return mix((at.astype(np.uint64) << np.uint64(8)) + letter.astype(np.uint64) + np.uint64(1))


def _block_and_bits(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(h)
    block = ((h >> np.uint64(34)) * np.uint64(blocks)) >> np.uint64(30)  # blocks < 2**30
    bits = np.zeros(h.shape, np.uint64)
    for i in range(BITS_SET):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return block, bits


def _by_length(words: list[bytes]):
    """Matrices of the letters of words of one length, of a bounded size."""
    lengths: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        lengths.setdefault(len(w), []).append(i)
    for n, rows in lengths.items():
        for at in range(0, len(rows), each := max(1, CANDIDATES // max(1, n))):
            some = rows[at:at + each]
            yield n, np.array(some), np.frombuffer(b"".join(words[i] for i in some), np.uint8).reshape(len(some), n)


class Filters:
    """Bloom filters by word length, one after the other in ``blocks``."""

    def __init__(self, words_by_length: dict[int, int], filter_bytes: int = FILTER_BYTES):
        total = sum(words_by_length.values())
        share = min(BITS / 64, filter_bytes / 8 / max(1, total))  # blocks a word
        self.sizes = {n: max(1, int(c * share)) for n, c in words_by_length.items()}
        self.starts = dict(zip(self.sizes, np.cumsum([0, *self.sizes.values()]).tolist(), strict=False))
        self.blocks = np.zeros(sum(self.sizes.values()), np.uint64)

    def places(self, length: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = min(length, LENGTHS)
        block, bits = _block_and_bits(h, self.sizes[n])
        return block.astype(np.int64) + self.starts[n], bits

    def may_hold(self, length: int, h: np.ndarray) -> np.ndarray:
        if min(length, LENGTHS) not in self.sizes:
            return np.zeros(h.shape, bool)
        block, bits = self.places(length, h)
        return (self.blocks[block] & bits) == bits


def hashes(letters: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _place(np.arange(letters.shape[1])[None, :], letters).sum(1, dtype=np.uint64)


def edits(letters: np.ndarray, filters: Filters):
    """(rows, words) of deletions and of replacements by a later letter that
    the filters may hold; each edited word comes once per row."""
    m, n = letters.shape
    at = np.arange(n)
    part = _place(at[None, :], letters)
    whole = part.sum(1, dtype=np.uint64)
    if n > 1:
        moved = np.zeros((m, n), np.uint64)  # parts of the letters behind, one place earlier
        moved[:, 1:] = _place(at[None, :-1], letters[:, 1:])
        tail = moved.sum(1, dtype=np.uint64)[:, None] - np.cumsum(moved, 1, dtype=np.uint64)
        head = np.cumsum(part, 1, dtype=np.uint64) - part
        first = np.ones((m, n), bool)
        first[:, 1:] = letters[:, 1:] != letters[:, :-1]  # one deletion a run of equal letters
        rows, places = np.nonzero(first & filters.may_hold(n - 1, head + tail))
        yield rows, [letters[r].tobytes()[:p] + letters[r].tobytes()[p + 1:] for r, p in zip(rows, places, strict=True)]
    width = max(1, CANDIDATES // (m * len(LETTERS)))
    for lo in range(0, n, width):
        old = letters[:, lo:lo + width]
        rest = whole[:, None] - part[:, lo:lo + width]
        new = _place(at[lo:lo + width, None], LETTERS[None, :])
        later = LETTERS[None, None, :] > old[:, :, None]
        row, place, letter = np.nonzero(later)
        hit = filters.may_hold(n, rest[row, place] + new[place, letter])
        row, place, letter = row[hit], place[hit] + lo, letter[hit]
        found = letters[row].copy()
        found[np.arange(len(row)), place] = LETTERS[letter]
        yield row, [w.tobytes() for w in found]


def build_filters(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> Filters:
    """Filters of a stored vocabulary (word). What reaches the driver is at
    most one row a length and one a block, ``filter_bytes`` / 8 of them."""
    size = F.least(F.char_length("word"), F.lit(LENGTHS))
    counts = {r["length"]: r["words"] for r in vocabulary.groupBy(size.alias("length")).agg(F.count(F.lit(1)).alias("words")).collect()}
    filters = Filters(counts, filter_bytes)

    def run(batches):
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            for n, _, letters in _by_length(words):
                block, bits = filters.places(n, hashes(letters))
                order = np.argsort(block, kind="stable")
                block, at = np.unique(block[order], return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(np.bitwise_or.reduceat(bits[order], at).view(np.int64))], ["block", "bits"])

    parts = map_arrow(vocabulary.select("word"), run, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    filters.blocks[parts["block"].to_numpy()] = parts["bits"].to_numpy().view(np.uint64)
    return filters


def near_pairs(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, n, near, near_n: both directions of every pair of words of a
    stored vocabulary (word, n) one edit apart."""
    filters = vocabulary.sparkSession.sparkContext.broadcast(build_filters(vocabulary, filter_bytes))

    def run(batches):
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            for _, index, letters in _by_length(words):
                each = max(1, CANDIDATES // (letters.shape[1] * len(LETTERS)))
                for lo in range(0, len(index), each):
                    for rows, edited in edits(letters[lo:lo + each], filters.value):
                        if len(rows):
                            at = pa.array(index[lo:lo + each][rows])
                            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([w.decode("latin-1") for w in edited])], ["word", "n", "near"])

    # every task takes a share of the words: probing costs far more than reading them
    spread = vocabulary.select("word", "n").repartition("word")
    maybe = map_arrow(spread, run, "word string, n long, near string")
    found = maybe.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")
    return found.union(found.select("near", "near_n", "word", "n"))


def group_variants(vocabulary: DataFrame, times: int = 5, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per word of a stored vocabulary (word, n): n_near, form, form_n, root.
    n grows ``times``-fold along the forms, so chains are short and doubling
    the pointers ends after a few joins."""
    pairs = stage_table(near_pairs(vocabulary, filter_bytes), "near-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= times * F.col("n")
    rows = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"))
    rows = stage_table(rows, "variants")
    jumps = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        jumps = stage_table(jumps.join(ahead, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("__moved")), "roots")
        moved = not jumps.where("__moved").isEmpty()
        jumps = jumps.drop("__moved")
        if not moved:
            break
    return rows.join(jumps, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text", garble: int = 199, min_length: int = 6, min_count: int = 5, times: int = 5,
                      filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Counted words of ``df`` with their variants."""
    return group_variants(stage_table(word_counts(df, key, text, garble, min_length, min_count), "vocabulary"), times, filter_bytes)
