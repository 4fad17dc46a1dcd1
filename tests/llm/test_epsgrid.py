import numpy as np

from pulsegrid.llm.epsgrid import near_vectors


def brute(rows, c):
    ok = lambda v, l, k: k is not None and l is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    use = [i for i, (k, v, l) in enumerate(rows) if ok(v, l, k)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in use:
        for b in use:
            (_, x, l), (_, y, m) = rows[a], rows[b]
            if a != b and l == m and len(x) == len(y):
                x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= c:
                    links[a] += 1
                    root[find(a)] = find(b)
    low = {}
    for i in use:
        low[find(i)] = min(rows[i][0], low.get(find(i), rows[i][0]))
    return [(k, links[i], low.get(find(i), k) if i in use else k) for i, (k, _, _) in enumerate(rows)]


def fixture(n=260, d=12):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(25, d))
    rows = []
    for i in range(n):
        v = centers[rng.integers(25)] + rng.normal(0, 0.09, d)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 3)))
    for i in range(n, n + 60):  # one very common vector, some scaled
        rows.append((i, [float(np.float32(x * (1 + i % 2))) for x in rows[0][1]], 0))
    z = [0.0] * d
    rows += [(900, None, 1), (901, z, 1), (902, [float("nan"), *z[1:]], 1), (903, [None, *z[1:]], 1), (904, rows[0][1], None), (905, [], 1), (906, [float("inf"), *z[1:]], 1),
             (None, rows[0][1], 0), (5, rows[5][1], rows[5][2]), (907, rows[0][1][:4], 0), (908, [2 * x for x in rows[0][1][:4]], 0)]
    return rows


def test_equals_all_pairs_for_any_block_size(spark, monkeypatch):
    rows = fixture()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, n int, block int")
    want = sorted(brute(rows, 0.98), key=str)
    for size in (512, 7):
        monkeypatch.setattr("pulsegrid.llm.epsgrid.BLOCK", size)
        got = near_vectors(df).collect()
        assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert any(x[1] > 60 for x in want)


def test_empty_table_and_other_threshold(spark):
    rows = fixture(60, 5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert near_vectors(df.limit(0)).collect() == []
    got = near_vectors(df, cosine=0.9).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == sorted(brute(rows, 0.9), key=str)


def test_vectors_that_share_a_key(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) for x in v], l) for k, v, l in fixture(120, 6) if v and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v)]
    rows = [(None if k is None else k % 40, v, l) for k, v, l in rows]
    a, b = rng.normal(size=6), rng.normal(size=6)  # 701 near one vector of 702, the other vector of 702 near 703
    rows += [(701, a.tolist(), 1), (702, (a * 1.5).tolist(), 1), (702, b.tolist(), 1), (703, (b + 0.001).tolist(), 1)]
    rows = [(k, [float(np.float32(x)) for x in v], l) for k, v, l in rows]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == sorted(brute(rows, 0.98), key=str)
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] in (702, 703)} == {(702, 1, 701), (702, 1, 702), (703, 1, 702)}
