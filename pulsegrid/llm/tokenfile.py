"""Token ids in Arrow files with fixed-size-list batches.

A shard is one file in Arrow's file format (a stream with a footer, so
batches can be addressed). Its rows are sequences: ``ids``, a fixed-size list
of unsigned 16-bit ids (32-bit for larger vocabularies), and ``mask``, a
fixed-size list of booleans, false only in the padding of a shard's last
sequence. All batches of a shard but the last have the same number of rows
and nothing is compressed, so sequence i is a fixed place in a memory-mapped
file and its arrays are views of it. A second file per shard lists key, first
token and number of tokens of its documents.

Shards are ranges of the key, ascending, nulls last, equal keys in the order
of the table, so a hot key spreads over shards, too. A task streams one shard:
it holds a batch, never a shard. Files get names of their own per attempt and
only those of the attempts that Spark accepted stand in the manifest, so a
lost executor or a second attempt leaves no half-written or double shard in
the result.

Rows: a null or empty text gives the end id alone; repeated rows are written
each; an empty table gives an empty manifest; very long texts run over as
many sequences as they need. Only the named columns are read, so others may
have any name. ``df`` should be a table read from storage.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.chunks import ByteLevelCoder, coder
from pulsegrid.llm.common import map_arrow, shared_dir, stage_table

BATCH_SEQUENCES = 256
MANIFEST = "shard int, tokens_path string, documents_path string, n_documents long, n_tokens long, n_sequences long"


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """Arrow's file system for a path or URI of the shared folder."""
    if "://" in path:
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path.removeprefix("file:")


class TokenWriter:
    """Writes one shard; ``add`` takes ids of whole documents."""

    def __init__(self, base: str, key_type: pa.DataType, seq_len: int, vocabulary: int):
        fs, self.base = file_system(base)
        self.seq_len, self.held, self.size = seq_len, [], 0
        self.kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
        fields = [("ids", pa.list_(self.kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))]
        notes = {"seq_len": str(seq_len), "batch_sequences": str(BATCH_SEQUENCES), "vocabulary": str(vocabulary)}
        self.schema = pa.schema(fields, metadata=notes)
        self.index = pa.schema([("key", key_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = [fs.open_output_stream(f"{self.base}.tokens.arrow"), fs.open_output_stream(f"{self.base}.documents.arrow")]
        self.tokens, self.documents = pa.ipc.new_file(self.out[0], self.schema), pa.ipc.new_file(self.out[1], self.index)
        self.n_documents = self.n_tokens = self.n_sequences = 0

    def _batch(self, ids: np.ndarray, real: int) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(x, self.seq_len) for x in (pa.array(ids, self.kind), pa.array(np.arange(len(ids)) < real))]
        self.tokens.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.n_sequences += len(lists[0])

    def add(self, keys: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        self.documents.write_batch(pa.RecordBatch.from_arrays([keys, pa.array(starts), pa.array(sizes)], schema=self.index))
        self.n_documents += len(sizes)
        self.n_tokens += len(ids)
        self.held.append(ids.astype(self.kind.to_pandas_dtype()))
        self.size += len(ids)
        full = self.seq_len * BATCH_SEQUENCES
        if self.size >= full:
            held = np.concatenate(self.held)
            for at in range(0, len(held) - full + 1, full):
                self._batch(held[at:at + full], full)
            self.held, self.size = [held[len(held) // full * full:].copy()], len(held) % full

    def close(self) -> None:
        if self.size:
            held = np.concatenate(self.held)
            self._batch(np.concatenate((held, np.zeros(-len(held) % self.seq_len, held.dtype))), len(held))
        for x in (self.tokens, self.documents, *self.out):
            x.close()


class TokenFile:
    """Random access to one shard. On a local or mounted path the file is
    memory-mapped and ``sequence`` returns views of it."""

    def __init__(self, path: str):
        fs, inner = file_system(path)
        self.source = pa.memory_map(inner) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(inner)
        self.reader = pa.ipc.open_file(self.source)
        self.per_batch = int(self.reader.schema.metadata[b"batch_sequences"])

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """ids and mask of the shard's sequence ``i``."""
        batch = self.reader.get_batch(i // self.per_batch)
        row = i % self.per_batch
        ids, mask = (batch.column(c).slice(row, 1).flatten() for c in (0, 1))
        return ids.to_numpy(), mask

    def tokens(self) -> Iterator[np.ndarray]:
        """All ids without the padding, a batch at a time."""
        for i in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(i)
            ids, mask = batch.column(0).flatten().to_numpy(), batch.column(1).flatten()
            yield ids if i + 1 < self.reader.num_record_batches else ids[:mask.true_count]

    def close(self) -> None:
        self.source.close()


def write_token_files(df: DataFrame, tokenizer_path: str, folder: str, seq_len: int = 2048, end_id: int = 2, shards: int | None = None,
                      key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``df`` as shards below ``folder`` and return the manifest with
    first_token and first_sequence of every shard over all shards. ``shards``
    defaults to ``spark.sql.shuffle.partitions``; a task streams one."""
    spark = df.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        tok = coder(ByteLevelCoder, tokenizer_path)
        shard, out = TaskContext.get().partitionId(), None
        base = f"{folder.rstrip('/')}/shard-{shard:06d}-{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            for first, ids, at in tok.rows(batch.column(1)):
                keys = batch.column(0).slice(first, len(at) - 1)
                out = out or TokenWriter(base, keys.type, seq_len, len(tok.table))
                out.add(keys, np.insert(ids, at[1:], end_id), np.diff(at) + 1)
        if out:
            out.close()
            row = [shard, f"{base}.tokens.arrow", f"{base}.documents.arrow", out.n_documents, out.n_tokens, out.n_sequences]
            yield pa.RecordBatch.from_arrays([pa.array([x]).cast(t) for x, t in zip(row, [pa.int32(), pa.string(), pa.string(), *[pa.int64()] * 3], strict=True)],
                                             ["shard", "tokens_path", "documents_path", "n_documents", "n_tokens", "n_sequences"])

    fs, inner = file_system(folder)
    fs.create_dir(inner, recursive=True)
    order = [F.col(key).asc_nulls_last(), F.col("__row")]
    rows = df.select(key, text).withColumn("__row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    written = stage_table(map_arrow(rows.select(key, text), run, MANIFEST), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return written.select("*", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"first_{n[2:-1]}") for n in ("n_tokens", "n_sequences")])


def _by_shard(manifest: DataFrame) -> DataFrame:
    """The manifest with its files dealt over tasks."""
    return manifest.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")


def read_documents(manifest: DataFrame, key: str, key_type: str) -> DataFrame:
    """Per document, from the files: key, start (tokens of all documents
    before it), n_tokens, ids_crc32 of its ids as little-endian unsigned
    32-bit integers."""

    def digests(path: str, documents: str, first: int) -> Iterator[pa.RecordBatch]:
        shard, index = TokenFile(path), file_system(documents)
        source = index[0].open_input_file(index[1])
        blocks, ids, at = shard.tokens(), np.zeros(0, np.uint32), 0
        listed = pa.ipc.open_file(source)
        for b in range(listed.num_record_batches):
            keys, starts, sizes = listed.get_batch(b).columns
            crcs = []
            for n in sizes.to_pylist():
                crc = 0
                while n:
                    if at == len(ids):
                        ids, at = next(blocks).astype("<u4"), 0
                    part = ids[at:at + n]
                    crc, at, n = zlib.crc32(part, crc), at + len(part), n - len(part)
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([keys, pa.array(starts.to_numpy() + first), sizes, pa.array(crcs, pa.int64())], [key, "start", "n_tokens", "ids_crc32"])
        shard.close()
        source.close()

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from digests(row["tokens_path"], row["documents_path"], row["first_token"])

    files = _by_shard(manifest).select("tokens_path", "documents_path", "first_token")
    return map_arrow(files, run, f"`{key}` {key_type}, start long, n_tokens long, ids_crc32 long")


def read_sequences(manifest: DataFrame) -> DataFrame:
    """Every sequence of the files: sequence (counted over all shards), ids,
    mask."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard, at = TokenFile(row["tokens_path"]), row["first_sequence"]
                for i in range(shard.reader.num_record_batches):
                    lists = shard.reader.get_batch(i)
                    n, width = len(lists), lists.schema.field(0).type.list_size
                    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
                    ids, mask = (pa.ListArray.from_arrays(offsets, lists.column(c).flatten().cast(t)) for c, t in ((0, pa.int64()), (1, pa.bool_())))
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + n)), ids, mask], ["sequence", "ids", "mask"])
                    at += n
                shard.close()

    return map_arrow(_by_shard(manifest).select("tokens_path", "first_sequence"), run, "sequence long, ids array<long>, mask array<boolean>")


def round_trip(df: DataFrame, tokenizer_path: str, seq_len: int = 2048, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``df`` to a new folder of the shared folder and read every
    document's digest back from the files."""
    manifest = write_token_files(df, tokenizer_path, new_folder(df.sparkSession), seq_len, end_id, None, key, text)
    return read_documents(manifest, key, df.schema[key].dataType.simpleString())


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
