import re
from collections import defaultdict

import pytest

from pulsegrid.llm.mixing import mix_sources


def fill(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * unit > most * sizes[s]}
        if not over:
            return target | {s: w[s] * unit for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets_and_taken(docs, local):
    got = mix_sources(docs).collect()
    sizes = defaultdict(int)
    for r in local:
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    target = fill(sizes)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r["doc_id"] or -1, len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in local)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        largest = max([r["size"] for r in got if r["source"] == s])
        assert abs(taken[s] - target[s]) <= largest / 2 + 1
    assert sorted(map(str, mix_sources(docs.repartition(2)).collect())) == sorted(map(str, got))


def test_many_blocks_equal_one(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id doc_id", "repeat('w ', cast(1 + id % 17 as int)) text", "concat('s', id % 7 div 3) source")
    one = sorted(map(tuple, mix_sources(df).collect()))
    monkeypatch.setattr("pulsegrid.llm.mixing.BLOCK_ROWS", 50)
    assert sorted(map(tuple, mix_sources(df).collect())) == one
    sums = defaultdict(int)
    for r in one:
        sums[r[5]] += r[4]
    target = {r[5]: r[3] for r in one}
    assert all(abs(sums[s] - target[s]) <= 1 for s in sums)


def test_empty_table_and_no_words(docs, spark):
    assert mix_sources(docs.limit(0)).collect() == []
    got = mix_sources(spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2


def test_large_documents_are_stepped_over(spark, monkeypatch):
    # one large document a source at any place of the order, and heavy tails; tiny ones can fill every gap
    rows = [(1000 * s + i, 30 if i == 0 else 1, f"a{s:02}") for s in range(12) for i in range(71)]
    rows += [(10**6 + i, max(1, int(3000 / (1 + i % 400))), "tail") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, n int, source string").selectExpr("doc_id", "repeat('w ', n) text", "source")
    kinds = {"weights": (1,), "share": 0.5, "most": 0.5}
    one = sorted(map(tuple, mix_sources(df, **kinds).collect()))
    taken, target = defaultdict(int), {}
    for _, _, _, due, words, source, *_ in one:
        taken[source] += words
        target[source] = due
    assert all(abs(taken[s] - target[s]) <= max(1, 0.001 * target[s]) for s in target), (taken, target)
    monkeypatch.setattr("pulsegrid.llm.mixing.BLOCK_ROWS", 20)
    assert sorted(map(tuple, mix_sources(df, **kinds).collect())) == one


def test_inclusion_is_proportional_to_size_and_order_sampling_is_kept(spark):
    from collections import Counter

    sizes = [3] * 1500 + [12] * 600 + [60] * 120 + [2000] * 2
    df = spark.createDataFrame([(i, "w " * n, "a") for i, n in enumerate(sizes)], "doc_id long, text string, source string")
    rows = [r.asDict() for r in mix_sources(df, share=0.4).collect()]
    due = 0.4 * sum(sizes)
    certain = [n for n in sizes if n == 2000]  # the plain way: make the largest certain until no inclusion is above 1
    factor = (due - sum(certain)) / sum(n * n for n in sizes if n < 2000)
    assert factor * 60 < 1 < due / sum(n * n for n in sizes) * 2000
    assert all(r["inclusion"] == pytest.approx(1 if r["size"] == 2000 else factor * r["size"]) for r in rows)
    left, taken = due, set()
    for r in sorted(rows, key=lambda r: r["rank"]):  # sequential Pareto sampling
        if r["size"] > left:
            break
        left -= r["size"]
        taken.add(r["doc_id"])
    mixed = {r["doc_id"] for r in rows if r["copies"]}
    assert taken <= mixed and len(mixed - taken) < 25
    share = Counter(r["size"] for r in rows if r["copies"])
    for n, number in Counter(sizes).items():
        p = 1 if n == 2000 else factor * n
        assert abs(share[n] - p * number) <= 4 * (number * p * (1 - p)) ** 0.5 + 12, (n, share[n], p * number)


def test_many_equal_rows_have_draws_of_their_own(spark, monkeypatch):
    monkeypatch.setattr("pulsegrid.llm.mixing.BLOCK_ROWS", 64)
    df = spark.range(1000).selectExpr("cast(null as long) doc_id", "'a b c' text", "'x' source")
    rows = mix_sources(df, share=0.5).collect()
    assert len(rows) == 1000 and len({r["rank"] for r in rows}) == 1000 and sum(r["taken"] for r in rows) == 1500
