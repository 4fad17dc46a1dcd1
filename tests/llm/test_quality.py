import numpy as np
from pyspark.sql import functions as F

from pulsegrid.llm.quality import fit_quality, fit_rules, score_quality, statistics


def test_rules_are_sparse_and_learn_a_conjunction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.3)).astype(float)
    model = fit_rules(x, y, list("abcde"))
    total = np.full(len(x), model.bias)
    at = {n: j for j, n in enumerate("abcde")}
    for rule, w in model.rules:
        total += w * np.all([(x[:, at[n]] > lo) & (x[:, at[n]] <= hi) for n, lo, hi in rule], axis=0)
    assert ((total > 0) == (y > 0)).mean() > 0.98
    assert 0 < len(model.rules) < 200


def test_column_expression_equals_rules(docs):
    labels = docs.select("doc_id", F.when(F.length("text") > 600, 1).otherwise(0).alias("quality")).where("doc_id is not null")
    model = fit_quality(docs, labels)
    stats = statistics(F.col("text"))
    rows = score_quality(docs, model, name="score").select("score", *[e.alias(f"s_{n}") for n, e in stats.items()]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        total = model.bias + sum(w for rule, w in model.rules if all(lo < r[f"s_{n}"] <= hi for n, lo, hi in rule))
        assert abs(r["score"] - 1 / (1 + np.exp(-total))) < 1e-6 and 0 <= r["score"] <= 1


def test_no_labels_one_class_empty_table(docs, spark):
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert {r["score"] for r in score_quality(docs, fit_quality(docs, none)).collect()} == {0.5}
    ones = docs.select("doc_id", F.lit(1).alias("quality"))
    assert min(r["score"] for r in score_quality(docs, fit_quality(docs, ones)).collect()) > 0.9
    assert score_quality(docs.limit(0), fit_quality(docs, none)).collect() == []


def test_held_out_quality(spark):
    from pulsegrid.llm.queries import op5_rule_quality

    sf = "/root/testdata/sf0.01"
    got = op5_rule_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in got if r["quality"] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97


def test_repeated_keys_and_labels(spark):
    texts = [" ".join(f"w{i}{j}" for j in range(i % 40 + 1)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 40 > 20).cast("int").alias("quality"))
    once, often = fit_quality(docs, labels), fit_quality(docs.union(docs).union(docs), labels.union(labels))
    assert once == often and once.rules


def test_filter_on_the_score_computes_each_statistic_once(docs):
    rng = np.random.default_rng(1)
    names = list(statistics(F.col("text")))
    x = rng.random((2000, len(names)))
    model = fit_rules(x, ((x[:, 1] > 0.5) != (x[:, 7] * x[:, 9] > 0.2)).astype(float), names)
    scored = score_quality(docs.withColumn("__stats", F.lit(1)), model, name="__quality")
    kept = scored.where(F.col("__quality") >= 0.5).select(*docs.columns)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # the five patterns of the shares and the one of the words
    assert len(model.rules) > 1 and 0 < plan.count("regexp_extract_all") <= 6
