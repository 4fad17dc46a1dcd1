import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm.common import doc_remainder
from pulsegrid.llm.ppm import ORDER, score_documents

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Trie:
    """Partial matching with method D and exclusion, symbol by symbol."""

    def __init__(self, texts):
        self.count = defaultdict(Counter)
        for t in texts:
            s = b"\xfe" * ORDER + t + b"\xff"
            for p in range(ORDER, len(s)):
                for k in range(ORDER + 1):
                    self.count[s[p - k:p]][s[p]] += 1

    def probability(self, context, symbol):
        out, p = set(), 1.0
        for k in range(ORDER, -1, -1):
            seen = self.count.get(context[len(context) - k:])
            if not seen:
                continue
            left = {a: n for a, n in seen.items() if a not in out}
            whole = 2 * sum(left.values())
            if symbol in left:
                return p * (2 * left[symbol] - 1) / whole
            if left:
                p *= len(left) / whole
            out |= set(seen)
        return p / (256 - len(out))

    def score(self, text):
        s = b"\xfe" * ORDER + text + b"\xff"
        return sum(math.log10(self.probability(s[p - ORDER:p], s[p])) for p in range(ORDER, len(s)))


def check(rows, got, chosen):
    data = [((r["text"] or "").encode().translate(LOWER), chosen(r["doc_id"])) for r in rows]
    trie = Trie([t for t, train in data if train])
    words = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", t) + [None]
    c = Counter(w for t, train in data if train for w in words(t))
    n, v = sum(c.values()), len(c)
    want = {}
    for r, (t, _) in zip(rows, data, strict=True):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t))
        want[r["doc_id"]] = (len(words(t)), sum(c[w] > 0 for w in words(t)), n, base, trie.score(t))
    assert len(got) == len(rows)
    for r in got:
        have = (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
        assert have == pytest.approx(want[r["doc_id"]], rel=1e-9, abs=1e-9)


def test_equals_trie_for_any_chunking(docs, local):
    small = docs.where("length(text) < 6000 or text is null")
    rows = [r for r in local if len(r["text"] or "") < 6000]
    train = doc_remainder(F.col("doc_id"), 3) != 0
    for size in (1 << 20, 3000):
        got = score_documents(small, train, chunk_bytes=size).collect()
        check(rows, got, lambda k: zlib.crc32(str("" if k is None else k).encode()) % 3 != 0)


def test_probabilities_sum_to_one():
    trie = Trie([b"abracadabra", b"abba", b""])
    for context in (b"\xfe" * 4, b"\xfeabr", b"zzzz", b"abra"):
        assert sum(trie.probability(context, s) for s in range(256)) == pytest.approx(1.0)


def test_no_training_rows_and_empty_table(docs, spark):
    got = score_documents(spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string"), F.lit(False)).collect()
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx({1: 3 * math.log10(1 / 256), 2: math.log10(1 / 256)})
    assert score_documents(docs.limit(0), F.lit(True)).collect() == []
