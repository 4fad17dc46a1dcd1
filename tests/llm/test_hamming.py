import random

from pyspark.sql import functions as F

from pulsegrid.llm.hamming import sign_code, top_k


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    rows = []
    for i in range(700):
        c = rng.choice(base)
        for _ in range(rng.randrange(0, 14)):
            c ^= 1 << rng.randrange(64)
        rows.append((i, c if c < 1 << 63 else c - (1 << 64), i % 2, "x"))
    rows += [(700, None, 0, "x"), (None, 5, 0, "x"), (3, rows[3][1], 0, "x")]  # null code, null key, a repeated row
    df = spark.createDataFrame(rows, "vec_id long, code long, distance int, rank string")
    known = [(i, c) for i, c, *_ in rows if i is not None and c is not None]
    want = []
    for q, c in known:
        if q % 50 == 0:
            best = sorted((bin((c ^ o) & (2 ** 64 - 1)).count("1"), i) for i, o in known)[:10]
            want += [(q, r + 1, i, d) for r, (d, i) in enumerate(best)]
    got = sorted(map(tuple, top_k(df, F.col("vec_id") % 50 == 0).collect()))
    assert got == sorted(want)
    monkeypatch.setattr("pulsegrid.llm.hamming.CODE_BLOCK", 100)
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 50 == 0).collect())) == sorted(want)
    assert top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert len(top_k(df.where("vec_id < 4"), F.col("vec_id") == 0).collect()) == 5


def test_sign_code(spark):
    v = [0.5 if i in (0, 63, 5) else -1.0 for i in range(64)]
    rows = [(v,), (None,), (v[:3],), ([None, *v[1:]],), ([float("nan"), *v[1:]],), ([0.0] * 64,)]
    got = [r[0] for r in spark.createDataFrame(rows, "e array<float>").select(sign_code(F.col("e"))).collect()]
    assert got == [(1 | 1 << 5 | 1 << 63) - (1 << 64), None, None, None, None, 0]
