import numpy as np
from contactgate.llm import quality


def test_features_of_odd_texts():
    width = len(quality.features(""))
    for text in (None, "", " ", "\n", "a", "ÜÜÜ", "!!! ???", "word " * 100000):
        x = quality.features(text)
        assert len(x) == width and np.isfinite(x).all()


def test_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 1, (1500, 5)), rng.normal(-1.5, 1, (500, 5))
    model = quality.train(good[:700], np.concatenate([good[700:], bad]), prior=800 / 1300)
    assert (model.scores(good[:700]) > 0.5).mean() > 0.95 and (model.scores(bad) < 0.5).mean() > 0.9


def test_no_positives_empty_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a text", 7.0), (2, None, 7.0), (2, None, 7.0), (None, "", 7.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model)
    assert got.columns == ["doc_id", "text", "score"]
    assert {r["score"] for r in got.collect()} == {1 / 3} and got.count() == 4
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.fit(docs.limit(0), labels.limit(0)).weights == []


def test_held_out_accuracy(spark):
    from contactgate.llm.queries import op7_quality
    sf = "/root/testdata/sf0.01"
    got = op7_quality(spark, sf)
    assert got.count() == 1000 and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    held = got.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r["score"] for r in held if r["quality"] == 1]
    bad = [r["score"] for r in held if r["quality"] == 0]
    auc = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert auc > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in held)


def test_scores_as_by_one_unit_after_the_other(spark):
    import brute
    import pytest
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    rng = np.random.default_rng(3)
    x = np.stack([quality.features(r["text"]) for r in docs.collect()])
    model = quality.train(x[:60], x[60:], 0.6)
    model.weights = [w + rng.normal(0, 0.1, w.shape) for w in model.weights]
    for r in quality.score(docs, model).collect():
        assert r["score"] == pytest.approx(brute.quality(model, quality.features(r["text"])), abs=1e-9)


def test_the_risk_as_by_its_formula():
    """One step of training moves against the gradient of the non-negative risk."""
    rng = np.random.default_rng(0)
    p, u = rng.normal(1, 1, (200, 3)), rng.normal(0, 1, (400, 3))
    model = quality.train(p, u, 0.4)

    def risk(m):
        zp, zu = (quality._forward(m.weights, m.prepared(x))[1] for x in (p, u))
        rest = np.logaddexp(0, zu).mean() - 0.4 * np.logaddexp(0, zp).mean()
        return 0.4 * np.logaddexp(0, -zp).mean() + max(0.0, rest)
    start = quality.QualityModel(model.mean, model.scale, [np.zeros_like(w) for w in model.weights], 0.4)
    assert risk(model) < risk(start) - 0.02
