import random

import pytest

WORDS = "the of and to river stone light garden winter market copper ladder signal harbor meadow".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", str(rng.randrange(40))]) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """A small table with nulls, empty and long texts, repeats, near copies,
    a hot source and columns that clash with the operators' own names."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        rows.append((i, prose(rng, rng.randrange(3, 300)), ["en", "fr", None][i % 3], "hot" if i % 3 else f"s{i % 5}"))
    base = prose(rng, 200).split()
    for i in range(60, 90):  # near copies of one text
        some = list(base)
        for _ in range(rng.randrange(0, 12)):
            some[rng.randrange(len(some))] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(some), "en", "hot"))
    rows += [(90, None, "en", None), (91, "", None, None), (92, " \t\n ", "en", "s1"), (93, "!!! 123", "en", "s1"), (94, "Two words", "en", "s1"),
             (95, "two  WORDS", "en", "s2"), (96, prose(rng, 20000), "en", "s2"), (97, rows[5][1], "en", "s3"), (98, rows[5][1].upper(), "en", "s3"),
             (99, "x" * 5000, "en", "s3"), (99, "x" * 5000, "en", "s3"), (None, "no key here at all today", "en", "s3"), (101, "Ünï cödé   ß ﬁ 漢字 \U0001f600", "en", "s4")]
    rows = [(*r, 1.5, "pred", [1], 7, 8) for r in rows]
    schema = "doc_id long, text string, lang string, source string, score double, lang_pred string, size array<int>, n int, key int"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def local(docs):
    return [r.asDict() for r in docs.select("doc_id", "text", "lang", "source").collect()]
