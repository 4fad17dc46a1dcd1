import re
from itertools import combinations

from pulsegrid.llm.components import connected_components
from pulsegrid.llm.neardup import near_duplicates, overlap_floor

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [(r["doc_id"], shingles(r["text"])) for r in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            root[find(i)] = find(j)
    smallest = {}
    for i, (key, s) in enumerate(sets):
        if key is not None:
            smallest[find(i)] = min(key, smallest.get(find(i), key))
    return sorted(((k, len(s), smallest.get(find(i))) for i, (k, s) in enumerate(sets)), key=str)


def test_equals_all_pairs(docs, local):
    got = near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(local)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_small_sketch_is_still_whole(docs, local):
    got = near_duplicates(docs, k=24).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(local)


def test_common_passages_do_not_link(spark):
    common = " ".join(f"p{i}" for i in range(30))
    rows = [(i, common + " " + " ".join(f"u{i}x{j}" for j in range(70))) for i in range(40)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["kept"] for r in got) and len(got) == 40


def test_empty_table_and_bounds(docs):
    assert near_duplicates(docs.limit(0)).collect() == []
    assert 1 <= overlap_floor(16, 75) < 12 and overlap_floor(64, 75) < 48


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = dict(connected_components(edges).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_null_repeated_and_shared_keys(spark):
    t, u, v = (" ".join(f"{c}{i}" for i in range(60)) for c in "tuv")
    rows = [(1, t), (None, t + " more"), (2, u), (3, u + " more"), (3, v), (4, v + " more"), (4, v + " more"), (None, "alone by itself here today"),
            (None, "alone by itself here today"), (9, ""), (9, None), (None, "")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute([{"doc_id": k, "text": x} for k, x in rows])
    # the link goes by the text of key 3, not by the key: its two texts stay apart
    assert sorted(r["component_id"] for r in got if r["doc_id"] in (2, 3, 4)) == [2, 2, 3, 3, 3]


def test_keys_that_are_all_shared(docs, local):
    from pyspark.sql import functions as F

    some = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 7))
    rows = [{**r, "doc_id": r["doc_id"] % 7 if r["doc_id"] is not None and r["doc_id"] % 3 else None} for r in local]
    got = near_duplicates(some).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows)
