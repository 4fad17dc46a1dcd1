import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pulsegrid.llm import variants


def one_edit(a, b):
    """Do two words differ by exactly one edit?"""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def letter(c):
    return "a" <= c.lower() <= "z" and c.isascii() or "À" <= c <= "ÿ"


def counted(rows, garble, min_length, min_count):
    n = Counter()
    for key, text in rows:
        run = ""
        for c in (text or "") + " ":
            if letter(c):
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                cut = h % len(run)
                n[run[:cut] + run[cut + 1:] if h % garble == 0 else run] += 1
                run = ""
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def brute(words, times=5):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if a < b and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x))
        if words[best] >= times * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    stems = ["".join(rng.choice("abeéÉü÷") for _ in range(rng.randrange(3, 10))) for _ in range(60)]
    out = []
    for i in range(400):
        some = []
        for _ in range(40):
            w = stems[min(rng.randrange(60), rng.randrange(60))]
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", w[at] * 2, "ÿ", "Z"]) + w[at + 1:]
            some.append(rng.choice([w, w.title() if w.isascii() else w]))
        out.append((i if i % 50 else None, rng.choice([" ", "\n", "-", "1"]).join(some)))
    out += [(500 + i, "qqqqaa " * 8 + "qqqqab " * 3 + "qqqqbb " * (i < 9)) for i in range(10)]  # a chain of forms
    return [*out, (7, None), (8, ""), (9, "x" * 3000), *[(10, "y" * 200 + " " + "y" * 201)] * 5, *[(11, "y" * 199 + "z")] * 30, out[3], out[3], (12, "ab1cd ×÷×÷×÷ Ābcdefg")]


@pytest.mark.parametrize("filter_bytes,garble", [(variants.FILTER_BYTES, 199), (64, 7)])
def test_equals_brute_force(spark, rows, filter_bytes, garble):
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string").repartition(4)
    got = variants.spelling_variants(df, garble=garble, min_length=3, min_count=2, times=2, filter_bytes=filter_bytes)
    want = brute(counted(rows, garble, 3, 2), 2)
    assert sorted(map(tuple, got.select("word", "n", "n_near", "form", "form_n", "root").collect())) == want
    assert len(want) > 150 and sum(w[3] is not None for w in want) > 30 and any(w[5] != w[3] and w[3] for w in want)


def test_production_parameters(spark, docs, local):
    got = variants.spelling_variants(docs).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got)) == brute(counted([(r["doc_id"], r["text"]) for r in local], 199, 6, 5))
    assert variants.spelling_variants(docs.limit(0)).collect() == []


def test_flush_of_counts(spark, docs, monkeypatch):
    want = {r["word"]: r["n"] for r in variants.word_counts(docs).collect()}
    monkeypatch.setattr(variants, "FLUSH_WORDS", 3)
    monkeypatch.setattr(variants, "FILTER_BYTES", 8)
    assert {r["word"]: r["n"] for r in variants.word_counts(docs).collect()} == want


def test_edit_hashes_are_those_of_the_edited_words(monkeypatch):
    class Seen:
        def may_hold(self, length, h):
            self.found = getattr(self, "found", []) + [(length, x) for x in h.ravel().tolist()]
            return np.ones(h.shape, bool)

    for limit in (variants.CANDIDATES, 100):
        monkeypatch.setattr(variants, "CANDIDATES", limit)
        seen, made = Seen(), []
        word = np.frombuffer("abéézÿ".encode("latin-1"), np.uint8)[None, :]
        for _, words in variants.edits(word, seen):
            made += words
        own = [(len(w), int(variants.hashes(np.frombuffer(w, np.uint8)[None, :])[0])) for w in made]
        assert len(set(made)) == len(made) and set(own) <= set(seen.found)
        plain = "abéézÿ"
        later = {plain[:i] + x + plain[i + 1:] for i in range(6) for x in variants.LETTERS.tobytes().decode("latin-1") if x > plain[i]}
        assert {w.decode("latin-1") for w in made} == later | {plain[:i] + plain[i + 1:] for i in range(6)}
