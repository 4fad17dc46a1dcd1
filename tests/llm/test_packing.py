import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm.packing import best_fit_plan, pack_documents, sequences
from pulsegrid.llm.queries import tokenizer_path


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 60), max_size=20))
def test_plan_places_every_piece_once_without_overlap(counts):
    used, ranks = defaultdict(list), defaultdict(list)
    for length, lo, hi, seq, offset, each in best_fit_plan(counts, 64):
        for r in range(lo, hi):
            i = r - lo
            ranks[length].append(r)
            used[seq + i // each].append((offset + i % each * length, length))
    assert all(sorted(ranks[n]) == list(range(c)) for n, c in counts.items())
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    rooms = []  # best-fit decreasing, piece by piece
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 64) - length)
    assert len(used) == len(rooms)
    assert sorted(used) == list(range(len(used)))


def test_plan_rejects_long_pieces():
    with pytest.raises(ValueError):
        best_fit_plan({11: 1}, 10)


def test_round_trip(docs, local):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    ids = {r["doc_id"]: [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in local}
    packed = pack_documents(docs, tokenizer_path(), keep_ids=True).cache()
    rows = packed.collect()
    n = Counter(r["doc_id"] for r in local)
    assert Counter(r["doc_id"] for r in rows) == {k: n[k] * -(-len(x) // 2048) for k, x in ids.items()}
    for r in rows:
        part = ids[r["doc_id"]][2048 * r["piece"]:2048 * r["piece"] + 2048]
        assert (r["ids"], r["start"], r["length"]) == (part, 2048 * r["piece"], len(part))
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    whole = {r["sequence_id"]: r["ids"] for r in sequences(packed).collect()}
    assert all(whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"] for r in rows)
    assert sum(map(len, whole.values())) == sum(r["length"] for r in rows) and max(map(len, whole.values())) <= 2048
    assert len(whole) <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_odd_texts_as_the_tokenizer(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    texts = ["it's 'tis don't'll", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>x", "É ́x İstanbul ΣΑΣ", "  x\x1cy\x85z", "ab.,cd... ab*** ##1a$$", "漢字かな 한국어", "9a.8 x9.,", "é. ü!!", "\x00\x7f﻿"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in pack_documents(df, tokenizer_path(), keep_ids=True).collect()}
    for i, t in enumerate(texts):
        assert got[i] == [*tok.encode(t, add_special_tokens=False).ids, 0], t


def test_empty_table(docs):
    assert pack_documents(docs.limit(0), tokenizer_path()).collect() == []
