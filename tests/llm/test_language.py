import pytest
from contactgate.llm import language

SAMPLES = {"en": "the quick brown fox jumps over the lazy dog and then some more ",
           "fr": "le vif renard brun saute par dessus le chien paresseux été où ",
           "de": "der schnelle braune Fuchs springt über den faulen Hund während "}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i * 10 + k, (text * (i + 1)), lang) for k, (lang, text) in enumerate(SAMPLES.items()) for i in range(5)]
    rows += [(900, None, "en"), (901, "ignored", None), (902, "", "fr"), (900, None, "en")]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_fit_and_identify(spark, model):
    assert model.languages == ["de", "en", "fr"]
    rows = [(1, "The brown dog", 1.5), (2, "le chien brun", 2.5), (3, None, 3.0), (4, "", 0.0), (5, "123 $$ 456", 0.0),
            (6, SAMPLES["de"] * 20000, 0.0), (1, "The brown dog", 1.5)]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, score double"), model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    found = sorted((r["doc_id"], r["lang_pred"]) for r in got.collect())
    assert found == [(1, "en"), (1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (6, "de")]
    assert all(0 <= r["score"] <= 1 for r in got.collect())


def test_long_text_counts_each_ngram_once(monkeypatch):
    text = SAMPLES["en"] * 50
    whole = [ids.tolist() for ids in language.features(language.code_points(text), 1 << 12)]
    monkeypatch.setattr(language, "SLAB_CHARS", 100)
    cut = [[], [], []]
    for slab in language.slabs(language.code_points(text)):
        for k, ids in enumerate(language.features(slab, 1 << 12)):
            cut[k] += ids.tolist()
    assert cut == whole


def test_a_batch_scores_as_its_texts_one_by_one(model, monkeypatch):
    texts = [SAMPLES["en"] * 3, None, "le", SAMPLES["de"] * 30, "", "x", "12 34", SAMPLES["fr"], "\u00e9" * 500]
    alone = [model.predict(t) for t in texts]
    for slab in (7, 100, 1 << 20):
        monkeypatch.setattr(language, "SLAB_CHARS", slab)
        names, scores = model.predict_batch(texts)
        assert names == [n for n, _ in alone]
        assert scores.tolist() == pytest.approx([x for _, x in alone], abs=1e-6)
    assert model.predict_batch([]) == ([], pytest.approx([]))


def test_too_many_languages_are_refused(spark):
    docs = spark.range(20).selectExpr("id AS doc_id", "'some text' AS text", "cast(id AS string) AS lang")
    with pytest.raises(ValueError, match="more than 10 values"):
        language.fit(docs, max_languages=10)


def test_no_labels_and_empty_table(spark, model):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    none = language.fit(empty)
    assert none.predict("anything") == ("und", 0.0)
    assert language.identify(empty, model).count() == 0


def test_held_out_accuracy(spark):
    from contactgate.llm.queries import op1_language_id
    sf = "/root/testdata/sf0.001"
    got = op1_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 200
    held = [r for r in got if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_predictions_as_by_one_ngram_after_the_other(spark, model):
    import brute
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for fitted in (model, language.fit(docs)):
        for r in language.identify(docs.select("text"), fitted).collect():
            lang, score = brute.language(fitted, r["text"], language.MULTIPLIERS)
            assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-3)


def test_counts_behind_the_model(spark):
    """Fitting counts every n-gram of the sample once."""
    from collections import Counter
    rows = [(1, "Ab ab", "x"), (2, "b", "y"), (3, "a--b", "x")]
    fitted = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    seen = {lang: Counter() for lang in ("x", "y")}
    for _, text, lang in rows:
        for n, ids in enumerate(language.features(language.code_points(text), language.BUCKETS)):
            seen[lang].update(ids.tolist())
    import math
    for k, lang in enumerate(fitted.languages):
        total = sum(seen[lang].values()) + language.ALPHA * language.BUCKETS
        for feature, n in seen[lang].items():
            assert fitted.table[feature, k] == pytest.approx(math.log((n + language.ALPHA) / total), abs=1e-4)
