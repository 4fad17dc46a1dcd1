import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsegrid.llm.chunks import byte_level_table
from pulsegrid.llm.crosstok import Alignment, align_documents, diagonal_runs
from pulsegrid.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 80).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(1, n)), st.sets(st.integers(1, n)))))
def test_alignment_equals_set_arithmetic(case):
    n, a, b = case
    a, b = sorted(a | {n}), sorted(b | {n})
    found = Alignment(np.array(a), np.array(b))
    common = sorted(set(a) & set(b))
    assert found.group_a.tolist() == [a.index(x) + 1 for x in common] and found.group_b.tolist() == [b.index(x) + 1 for x in common]
    spans_a, spans_b = list(zip([0, *a], a, strict=False)), list(zip([0, *b], b, strict=False))
    links = sorted((i, j) for i, (s, e) in enumerate(spans_a) for j, (t, f) in enumerate(spans_b) if s < f and t < e)
    assert sorted(zip(found.link_a.tolist(), found.link_b.tolist(), strict=True)) == links


def test_long_stretches_are_jumped():
    a = list(range(1, 100_001))
    b = a[:50_000] + a[50_002:]  # one irregular group in the middle
    run_a, run_b, run_n, end_a, end_b, link_a, _ = diagonal_runs(a, b)
    assert (run_a, run_b, run_n) == ([0, 50_003], [0, 50_001], [50_000, 49_997]) and (end_a, end_b) == ([50_003], [50_001]) and len(link_a) == 3
    assert diagonal_runs([], []) == ([], [], [], [], [], [], [])


def brute(rows):
    """Per row, from whole-text encodings and byte positions alone."""
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    table = byte_level_table(tok)
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    out, linked = [], []
    for text in rows:
        whole = (" " + (text or "")).encode()
        ids_a, ids_b = tok.encode(whole.decode(), add_special_tokens=False).ids, sp.encode(text or "")
        pieces = [sp.id_to_piece(i) for i in ids_b]
        spelt = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces, strict=True)]
        if not text or b"".join(table[i] for i in ids_a) != whole or b"".join(spelt) != whole:
            out.append((0, 0, 0, "", []))
            linked.append(set())
            continue
        own_a = [k for k, i in enumerate(ids_a) for _ in table[i]]
        own_b = [k for k, x in enumerate(spelt) for _ in x]
        links = [(ids_a[i], ids_b[j]) for i, j in sorted(set(zip(own_a, own_b, strict=True)))]
        last = len(whole) - 1
        cuts = [p for p in range(last + 1) if p == last or own_a[p] != own_a[p + 1] and own_b[p] != own_b[p + 1]]
        parts, x, y = [], 0, 0
        for p in cuts:
            i, j = own_a[p] + 1, own_b[p] + 1
            parts.append(",".join(map(str, ids_a[x:i])) + "|" + ",".join(map(str, ids_b[y:j])))
            x, y = i, j
        out.append((len(ids_a), len(ids_b), len(parts), ";".join(parts), links))
        linked.append(set(links))
    docs = Counter(p for s in linked for p in s)
    top = defaultdict(int)
    for (a, _), n in docs.items():
        top[a] = max(top[a], n)
    return [(n_a, n_b, g, len(links), sum(docs[p] == top[p[0]] for p in links), sum(docs[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if n_a else "") for n_a, n_b, g, text, links in out]


ODD = ["a<|endoftext|>b <s> </s>", "▁", "x ▁ y", "\x00\x01", "tab\tline\r\nend ", "  two  ", "😀é漢字 ﬁ ½", "\n", " ", "’tis <0x41>", "ab  c"]


@pytest.mark.parametrize("slice_pairs", [4_000_000, 200])
def test_documents_equal_brute_force(spark, docs, local, slice_pairs):
    extra = spark.createDataFrame([(200 + i, t, None, None, 0.0, "", [], 0, 0) for i, t in enumerate(ODD)], docs.schema)
    rows = [(r["doc_id"], r["text"]) for r in local] + [(200 + i, t) for i, t in enumerate(ODD)]
    got = align_documents(docs.union(extra), A, B, keep_groups=True, slice_pairs=slice_pairs).collect()
    want = [(k, *x) for (k, _), x in zip(rows, brute([t for _, t in rows]), strict=True)]
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    order = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((*(r[c] for c in names),) for r in got), key=order) == sorted(want, key=order)
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in got if r["n_a"])


def test_empty_table(docs):
    assert align_documents(docs.limit(0), A, B).collect() == []
    assert [r["n_links"] for r in align_documents(docs.where("doc_id = 90"), A, B).collect()] == [0]
