"""Language spans: script ranges, per-word scores, Viterbi with a penalty.

Learned from labelled texts, over all of them: counts of letter trigrams
inside words (hashed to ``BUCKETS`` cells a language, so the model has a
fixed size a language) and of words by script. A word is a run of letters;
its script narrows the candidate languages to those seen in that script; its
score in a language is the sum of the log probabilities of its trigrams.
Viterbi over the words of a text, with a fixed penalty for changing the
language between words, labels spans; the text's language is the one with
most letters and the score its share of them.

Rows: a text that is null, empty or has no letters is ``und`` with score 0;
ties go to the first language in code-point order; without training rows all
is ``und``; very long texts are decoded whole, in blocks of words whose
best scores are chained (the result is the same as word by word).
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_arrow

BUCKETS = 1 << 16
PENALTY, SMOOTH, OUT_OF_SCRIPT, RUN = 12.0, 0.2, -60.0, 64
STEP_CHARS = 1 << 20

# First code points of ranges and their scripts; fixed values of Unicode blocks.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
    (0xFF20, "latin"), (0xFF60, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
]
SCRIPT_NAMES = sorted({s for _, s in SCRIPTS})
_STARTS = np.array([a for a, _ in SCRIPTS])
_SCRIPT_OF = np.array([SCRIPT_NAMES.index(s) for _, s in SCRIPTS])
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Per code point: its lower-case letter, or 0 if it is no letter."""
    if not _TABLE:
        table = np.zeros(sys.maxunicode + 1, np.uint32)
        for c in range(sys.maxunicode + 1):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _TABLE.append(table)
    return _TABLE[0]


def _words(texts: list[str]):
    """Trigram cell of every letter, first letter of every word within these,
    script and text of every word, its start and end in the joined texts,
    and the start of every text."""
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _letters()[codes]
    inside = low > 0
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at = np.flatnonzero(inside)
    wide = np.concatenate(([0], low, [0])).astype(np.uint32)
    key = wide[at] * np.uint32(0x9E3779B1) + wide[at + 1] * np.uint32(0x85EBCA77) + wide[at + 2] * np.uint32(0xC2B2AE3D)
    key = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    cells = (key >> np.uint32(16)).astype(np.int64)
    sizes = ends - starts
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    script = _SCRIPT_OF[np.searchsorted(_STARTS, codes[starts], "right") - 1]
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])[:-1])).astype(np.int64)
    return cells, first, script, np.searchsorted(begins, starts, "right") - 1, starts, ends, begins


def _runs(batch: pa.RecordBatch, column: int):
    texts = batch.column(column)
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at + len(some) < len(texts) and size < STEP_CHARS:
            some.append(texts[at + len(some)].as_py() or "")
            size += len(some[-1])
        yield at, some
        at += len(some)


def fit_languages(df: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Counts over all rows with text and lang. What reaches the driver is at
    most (BUCKETS + scripts) counts a language."""

    def count(batches):
        cells: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for at, some in _runs(batch, 0):
                cell, first, script, row, *_ = _words(some)
                letter_row = np.repeat(row, np.diff(np.concatenate((first, [len(cell)]))))
                names = langs[at:at + len(some)]
                known = sorted(set(names))
                code = np.array([known.index(n) for n in names])
                for k, name in enumerate(known):
                    cells.setdefault(name, np.zeros(BUCKETS, np.int64))
                    cells[name] += np.bincount(cell[code[letter_row] == k], minlength=BUCKETS)
                    scripts.setdefault(name, np.zeros(len(SCRIPT_NAMES), np.int64))
                    scripts[name] += np.bincount(script[code[row] == k], minlength=len(SCRIPT_NAMES))
        for name in cells:
            both = np.concatenate((cells[name], scripts[name]))
            at = np.flatnonzero(both)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()),
                                              "cell": pa.array(at, pa.int64()), "n": pa.array(both[at], pa.int64())})

    known = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    rows = (map_arrow(known, count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(rows["lang"].to_pylist()), key=lambda s: s.encode())
    table = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)))
    if langs:
        code = {n: i for i, n in enumerate(langs)}
        table[[code[n] for n in rows["lang"].to_pylist()], rows["cell"].to_numpy()] = rows["n"].to_numpy()
    cells, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
    logp = np.log((cells + SMOOTH) / (cells.sum(1, keepdims=True) + SMOOTH * BUCKETS))
    share = scripts / np.maximum(1, scripts.sum(1, keepdims=True))
    return {"langs": langs, "logp": np.ascontiguousarray(logp.T.astype(np.float32)), "scripts": (share > 1e-3).T}


def word_scores(model: dict, cells, first, script) -> np.ndarray:
    """Log score of each word in each language; languages not seen in the
    word's script are held far below (no language in it: no evidence)."""
    score = np.add.reduceat(model["logp"][cells], first, axis=0) if len(first) else np.zeros((0, len(model["langs"])), np.float32)
    allowed = model["scripts"][script]
    none = ~allowed.any(1)
    score = score + np.where(allowed, 0, OUT_OF_SCRIPT).astype(np.float32)
    score[none] = 0
    return score.astype(np.float64)


def viterbi(score: np.ndarray, row: np.ndarray, n_rows: int, penalty: float = PENALTY) -> np.ndarray:
    """Best language of each word, every text on its own. Texts are cut into
    blocks of RUN words; a block's best score for each (language before it,
    language at its end) chains the blocks, then each block is traced back."""
    n, size = score.shape
    if not n:
        return np.zeros(0, np.int64)
    begin = np.searchsorted(row, np.arange(n_rows))
    place = np.arange(n) - begin[row]
    blocks_of = -(-np.bincount(row, minlength=n_rows) // RUN)
    first_block = np.concatenate(([0], np.cumsum(blocks_of)[:-1]))
    block = first_block[row] + place // RUN
    total = int(blocks_of.sum())
    s = np.zeros((RUN, total, size))
    s[place % RUN, block] = score
    best = np.full((total, size, size), -np.inf)
    best[:, np.arange(size), np.arange(size)] = 0
    for t in range(RUN):
        best = np.maximum(best, best.max(2, keepdims=True) - penalty) + s[t][:, None, :]
    # along each text
    into = np.zeros((total, size))
    value = np.zeros((n_rows, size))
    order = np.argsort(-blocks_of, kind="stable")
    active = [int((blocks_of > k).sum()) for k in range(int(blocks_of.max()))]
    for k, m in enumerate(active):
        rows = order[:m]
        at = first_block[rows] + k
        into[at] = value[rows]
        value[rows] = (value[rows][:, :, None] + best[at]).max(1)
    last = np.zeros(total, np.int64)
    enter = np.zeros(total, np.int64)
    state = value.argmax(1)
    for k in range(len(active) - 1, -1, -1):
        rows = order[:active[k]]
        at = first_block[rows] + k
        last[at] = state[rows]
        state[rows] = (into[at] + best[at, :, state[rows]]).argmax(1)
        enter[at] = state[rows]
    # inside each block
    v = np.full((total, size), -np.inf)
    v[np.arange(total), enter] = 0
    back = np.zeros((RUN, total, size), np.int16)
    stay = np.arange(size)
    for t in range(RUN):
        top = v.argmax(1)
        jump = v[np.arange(total), top][:, None] - penalty
        back[t] = np.where(v >= jump, stay, top[:, None])
        v = np.maximum(v, jump) + s[t]
    path = np.zeros((RUN, total), np.int64)
    for t in range(RUN - 1, -1, -1):
        path[t] = last
        last = back[t][np.arange(total), last]
    return path[place % RUN, block]


def label_languages(df: DataFrame, model: dict, key: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                    spans: bool = True, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """One row per input row: the columns ``keep`` (default: the key), the
    language and its share under ``names`` and, with ``spans``, the labelled
    spans as an array of (start, length, lang) in code points from the span's
    first letter to its last."""
    keep = keep or [key]
    kept = df.select(*keep, *([] if text in keep else [F.col(text).alias("__text")]))
    source = text if text in keep else "__text"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*keep).schema.fields)
    schema += f", {names[0]} string, {names[1]} double" + ", spans array<struct<start:int,length:int,lang:string>>" * spans
    shared = df.sparkSession.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("lang", pa.string())]))

    def label(batches):
        model = shared.value
        langs = np.array([*model["langs"], "und"], object)
        size = len(langs) - 1
        for batch in batches:
            column = batch.schema.get_field_index(source)
            for at, some in _runs(batch, column):
                cells, first, script, row, starts, ends, begins = _words(some)
                if not size:
                    row = row[:0]
                    path = row
                else:
                    path = viterbi(word_scores(model, cells, first, script), row, len(some))
                letters = np.zeros((len(some), size + 1))
                if len(row):
                    np.add.at(letters, (row, path), ends - starts)
                total = letters.sum(1)
                pred = np.where(total > 0, letters.argmax(1), size)
                out = [c.slice(at, len(some)) for c, name in zip(batch.columns, batch.schema.names, strict=True) if name in keep]
                out += [pa.array(langs[pred], pa.string()), pa.array(letters.max(1) / np.maximum(total, 1), pa.float64())]
                if spans:
                    cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(path) != 0)) + 1 if len(row) else np.zeros(0, np.int64)
                    a = np.concatenate(([0], cut)).astype(np.int64) if len(row) else cut
                    b = np.concatenate((cut, [len(row)])).astype(np.int64) - 1 if len(row) else cut
                    of = row[a]
                    lo = starts[a] - begins[of]
                    flat = pa.StructArray.from_arrays([pa.array(lo, pa.int32()), pa.array(ends[b] - starts[a], pa.int32()),
                                                       pa.array(langs[path[a]], pa.string())], fields=list(span_type.value_type))
                    out.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(some) + 1)), pa.int32()), flat, type=span_type))
                yield pa.RecordBatch.from_arrays(out, [*keep, *names] + ["spans"] * spans)

    return map_arrow(kept, label, schema)
