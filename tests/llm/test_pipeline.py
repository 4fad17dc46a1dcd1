import corpus_pipeline
from pulsegrid.llm.queries import op3_bottom_k_near_duplicates, op5_rule_quality


def test_stages_keep_columns_and_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mix", "pack"]
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(corpus_pipeline.stage_table(stage(spark, seen[-1], sf), "test-stage"))
        assert seen[-1].columns == columns
    ids = [[r[0] for r in d.select("doc_id").collect()] for d in seen]
    assert set(ids[1]) == {r["doc_id"] for r in op5_rule_quality(spark, sf).where("predicted = 1").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert len(set(good) & set(ids[1])) >= 0.97 * len(good) and len(set(ids[1])) - len(set(ids[2])) <= 3
    kept = {r["doc_id"] for r in op3_bottom_k_near_duplicates(spark, sf).where("kept").collect()}
    assert kept & set(ids[2]) <= set(ids[3]) and len(ids[3]) == len(set(ids[3])) < len(ids[2])
    assert set(ids[4]) <= set(ids[3]) and max(ids[4].count(i) for i in set(ids[4])) <= 2
    packed = corpus_pipeline.pack(spark, seen[4], sf).collect()
    assert sum(r["piece"] == 0 for r in packed) == len(ids[4])


def test_repeated_ids_and_empty_table(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"word{i}" for i in range(50))
    docs = spark.createDataFrame([(1, long, "en", "a", 1), (1, long, "en", "a", 1), (2, long, "en", "a", 1), (3, "other words here", "en", None, 1), (None, long, None, None, None)], schema)
    got = sorted(r["doc_id"] or 0 for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert got == [0, 1, 3]
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").collect() == []
    assert corpus_pipeline.mix(spark, docs.limit(0), "").collect() == []
    assert corpus_pipeline.keep_language(spark, docs.limit(0), "").collect() == []


def test_rows_without_or_with_shared_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    one, two, three = (" ".join(f"{w}{i}" for i in range(50)) for w in ("one", "two", "three"))
    rows = [(1, one), (1, two), (2, two), (None, three), (None, three), (None, three + " more"), (7, ""), (7, ""), (8, "")]
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in rows], schema)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    # both texts of id 1 stay, id 2 repeats one of them; of the copies without an id one stays
    assert sorted((r["doc_id"], r["text"]) for r in got if r["doc_id"]) == [(1, one), (1, two), (7, ""), (8, "")]
    assert len([r for r in got if r["doc_id"] is None]) == 1
