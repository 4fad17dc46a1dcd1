"""Shared helpers: shared-folder tables, seeded uniform hashes, word and
shingle keys computed on whole Arrow columns."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES, ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20
TWO_52 = float(1 << 52)


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir``.
    Only a local[*] session without the setting gets a private folder."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, survives lost executors, and every later use sees the same rows."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    held = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, ARROW_BYTES)  # small batches to Python while this table is written
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_BYTES, held)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give executors this package (once a context), as ``--py-files`` would."""
    sc = spark.sparkContext
    top = Path(__file__).resolve().parents[1]
    if not getattr(sc, "_llm_shipped", False) and top.is_dir():
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='llm-code-')}/{top.name}", "zip", top.parent, top.name))
        sc._llm_shipped = True


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand on every executor; workers
    return freed Arrow memory to the system."""
    ship_package(df.sparkSession)

    def run(batches):
        pa.set_memory_pool(pa.system_memory_pool())
        return function(batches)

    return df.mapInArrow(run, schema)


def uniform(*parts: Column | str) -> Column:
    """Uniform draw strictly inside (0, 1) from the md5 of the joined parts;
    the same in any SQL engine with md5. Nulls count as the mark U+2205."""
    text = F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("∅")) for p in parts])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / TWO_52


def doc_remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n (null key: as the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``_name``, ``__name``, ... that is no column
    of ``df`` (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


# ---- keys of words and shingles over Arrow string columns -----------------

_P = np.uint64(0x9E3779B97F4A7C15)
_STEP = 1 << 20  # bytes hashed at once
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW["up"]) < n:
        m = max(n, _STEP + 65536)
        for name, base in (("up", int(_P)), ("down", _inverse(int(_P)))):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            _POW[name] = np.multiply.accumulate(a)
    return _POW["up"], _POW["down"]


def text_slices(column: pa.Array, step: int = _STEP):
    """Yield (first row, bytes, offsets) over runs of rows of about ``step``
    bytes; a null text counts as empty. Views of the Arrow buffers."""
    column = column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + step, "right")) - 1)
        yield at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the row it belongs to; words
    end at ASCII white space and at the end of a text."""
    n = len(data)
    inside = ~_SPACE[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    opens, closes = border[:-1].copy(), border[1:].copy()
    opens[1:] |= ~inside[:-1]
    closes[:-1] |= ~inside[1:]
    starts, ends = np.flatnonzero(inside & opens), np.flatnonzero(inside & closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit key of each word, A-Z lower-cased; words are taken in runs of
    about ``_STEP`` bytes so that scratch arrays stay small."""
    out, i = np.zeros(len(starts), np.uint64), 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _STEP, "right")))
        run = _LOWER[data[base:ends[j - 1]]].astype(np.uint64)
        up, down = _powers(len(run) + 1)
        sums = np.zeros(len(run) + 1, np.uint64)
        np.cumsum((run + np.uint64(1)) * up[:len(run)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def shingle_sets(column: pa.Array, width: int = 5):
    """Yield (row, sorted distinct shingle keys): ``width`` consecutive words,
    or the whole sequence where a text has fewer; no words give no keys."""
    for first, data, offsets in text_slices(column):
        starts, ends, rows = word_spans(data, offsets)
        keys = word_keys(data, starts, ends)
        n_rows = len(offsets) - 1
        at = np.searchsorted(rows, np.arange(n_rows + 1))
        salts = [np.uint64(mix(np.array([i + 1], np.uint64))[0] | np.uint64(1)) for i in range(width)]
        if len(keys) >= width:
            full = np.zeros(len(keys) - width + 1, np.uint64)
            for i in range(width):
                full += mix(keys[i:len(keys) - width + 1 + i] * salts[i])
            full = mix(full)
        for r in range(n_rows):
            a, b = at[r], at[r + 1]
            if b - a >= width:
                s = np.sort(full[a:b - width + 1])
                yield first + r, s if len(s) < 2 else s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                short = np.array([b - a], np.uint64)
                for i in range(b - a):
                    short += mix(keys[a + i:a + i + 1] * salts[i])
                yield first + r, mix(short)
            else:
                yield first + r, np.zeros(0, np.uint64)
