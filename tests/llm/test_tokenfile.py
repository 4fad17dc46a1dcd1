import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pulsegrid.llm import tokenfile
from pulsegrid.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def want(local):
    """(key, ids) of every document in ascending key order, nulls last."""
    tok = Tokenizer.from_file(PATH)
    rows = [(r["doc_id"], [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in local]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("shards", [1, 7])
def test_round_trip(spark, docs, want, shards):
    manifest = tokenfile.write_token_files(docs, PATH, tokenfile.new_folder(spark), seq_len=128, shards=shards)
    got = sorted(tokenfile.read_documents(manifest, "doc_id", "bigint").collect(), key=lambda r: r["start"])
    at = 0
    for row, (key, ids) in zip(got, want, strict=True):
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    stream = [i for _, ids in want for i in ids]
    rows = sorted(tokenfile.read_sequences(manifest).collect(), key=lambda r: r["sequence"])
    assert [r["sequence"] for r in rows] == list(range(len(rows))) and all(len(r["ids"]) == len(r["mask"]) == 128 for r in rows)
    assert [i for r in rows for i, m in zip(r["ids"], r["mask"], strict=True) if m] == stream
    assert sum(not all(r["mask"]) for r in rows) <= shards and all(sorted(r["mask"], reverse=True) == r["mask"] for r in rows)
    assert sum(r["n_documents"] for r in manifest.collect()) == len(want)


def test_random_access_is_a_view_of_the_file(spark, docs, want):
    manifest = tokenfile.write_token_files(docs, PATH, tokenfile.new_folder(spark), seq_len=16, shards=1).collect()
    shard = tokenfile.TokenFile(manifest[0]["tokens_path"])
    stream = np.array([i for _, ids in want for i in ids])
    held = pa.total_allocated_bytes()
    place = np.frombuffer(shard.source.read_buffer(shard.source.size()), np.uint8).__array_interface__["data"][0]
    assert shard.reader.num_record_batches > 2
    for i in (0, 255, 256, 700, manifest[0]["n_sequences"] - 1, 3):
        ids, mask = shard.sequence(i)
        n = mask.true_count
        assert ids.dtype == np.uint16 and ids[:n].tolist() == stream[16 * i:16 * i + n].tolist() and (n == 16 or i == manifest[0]["n_sequences"] - 1)
        assert 0 <= ids.__array_interface__["data"][0] - place < shard.source.size() and not ids.flags.owndata
    assert pa.total_allocated_bytes() - held < 4096
    shard.close()


def test_hot_key_and_ties_keep_table_order(spark):
    rows = [(None, f"text {i}") for i in range(300)] + [(5, "a"), (5, "b"), (5, "a"), (-1, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    manifest = tokenfile.write_token_files(df, PATH, tokenfile.new_folder(spark), seq_len=8, shards=4)
    got = sorted(tokenfile.read_documents(manifest, "doc_id", "bigint").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [-1, 2, 5, 5, 5, *[None] * 300] and got[2]["ids_crc32"] == got[4]["ids_crc32"] != got[3]["ids_crc32"]
    assert [r["n_tokens"] for r in got[:3]] == [1, 1, 2]
    assert max(r["n_documents"] for r in manifest.collect()) < 200


def test_wide_ids_and_empty_table(spark, docs, tmp_path):
    out = tokenfile.TokenWriter(str(tmp_path / "x"), pa.string(), 4, 1 << 17)
    out.add(pa.array(["a"]), np.array([70_000, 1, 2, 3, 4], np.uint32), np.array([5]))
    out.close()
    shard = tokenfile.TokenFile(str(tmp_path / "x.tokens.arrow"))
    assert [x.tolist() for x in shard.tokens()] == [[70_000, 1, 2, 3, 4]] and shard.sequence(1)[1].to_pylist() == [True, False, False, False]
    assert tokenfile.round_trip(docs.limit(0), PATH).collect() == []
