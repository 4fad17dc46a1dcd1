import numpy as np

from pulsegrid.llm.langid import PENALTY, fit_languages, label_languages, viterbi


def brute(score, penalty):
    """Best path word by word; earlier states win ties as in argmax."""
    value, back = np.zeros(score.shape[1]), []
    for s in score:
        top = int(value.argmax())
        stay = value >= value[top] - penalty
        back.append(np.where(stay, np.arange(len(value)), top))
        value = np.maximum(value, value[top] - penalty) + s
    path = [int(value.argmax())]
    for b in reversed(back[1:]):
        path.append(int(b[path[-1]]))
    return path[::-1], value.max()


def test_viterbi_equals_word_by_word():
    rng = np.random.default_rng(1)
    sizes = [1, 3, 64, 65, 128, 500, 0, 7]
    row = np.repeat(np.arange(len(sizes)), sizes)
    score = np.cumsum(rng.normal(size=(len(row), 3)), 0) * 0 + rng.normal(0, 8, (len(row), 3))
    got = viterbi(score, row, len(sizes), 10.0)
    for r in range(len(sizes)):
        if sizes[r]:
            part = score[row == r]
            path, best = brute(part, 10.0)
            mine = got[row == r]
            value = part[np.arange(len(mine)), mine].sum() - 10.0 * (np.diff(mine) != 0).sum()
            assert abs(value - best) < 1e-6 and list(mine) == path


def test_spans_scripts_and_edges(spark):
    en, de, ru = "the cat sat on the mat and then the dog came home ", "der hund und die katze sind nicht im haus gewesen ", "кошка сидит дома и собака тоже дома "
    train = spark.createDataFrame([(en * 20, "en"), (de * 20, "de"), (ru * 20, "ru"), (None, "en"), (en, None)], "text string, lang string")
    model = fit_languages(train)
    assert model["langs"] == ["de", "en", "ru"]
    rows = [(1, en * 3), (2, de * 3), (3, en * 3 + de * 6), (4, ru), (5, None), (6, ""), (7, "123 !!! \n"), (None, en), (8, en * 20000), (9, en), (9, en), (10, "漢字")]
    got = label_languages(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert [by[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 6, 7, None, 8)] == ["en", "de", "de", "ru", "und", "und", "und", "en", "en"]
    spans = by[3]["spans"]
    assert [s["lang"] for s in spans] == ["en", "de"] and abs(spans[1]["start"] - len(en * 3)) <= 8
    assert 0.5 < by[3]["score"] < 0.8 and by[1]["score"] == 1.0 and by[5]["spans"] == [] and by[10]["lang_pred"] in model["langs"]
    assert PENALTY > 0


def test_clashing_columns_empty_table_no_training(docs):
    model = fit_languages(docs)
    assert label_languages(docs, model, keep=docs.columns, names=("__l", "__s")).select(*docs.columns).count() == docs.count()
    assert label_languages(docs.limit(0), model).collect() == []
    none = fit_languages(docs.limit(0))
    assert {r["lang_pred"] for r in label_languages(docs, none).collect()} == {"und"}


def test_held_out_accuracy(spark):
    from pulsegrid.llm.queries import op2_span_language

    sf = "/root/testdata/sf0.01"
    got = op2_span_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").selectExpr("avg(cast(lang = lang_pred as int)) a", "min(score) lo", "max(score) hi").first()
    assert held["a"] > 0.98 and 0 <= held["lo"] and held["hi"] <= 1
