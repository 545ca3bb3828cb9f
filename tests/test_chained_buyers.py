"""The chained evaluation on predictions of the buyers alone."""

from boutique.operators import model, score
from boutique.plans import catalog_models


def test_buyers_apart_give_the_same_scores(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    pred = spark.createDataFrame([(f"c{i}", [float(v) for v in rng.normal(size=4)]) for i in range(9)], "customer_id string, pred array<double>")
    slots = spark.createDataFrame([(i, [i % 4, (i + 1 + i // 4) % 4]) for i in range(12)], "article_id long, slots array<int>")
    y = spark.createDataFrame([("c1", 3, 2), ("c1", 5, 1), ("c4", 0, 1), ("c8", 11, 4)], "customer_id string, article_id long, y long")
    buyers = pred.where("customer_id in ('c1', 'c4', 'c8')")
    scored = score.pair_predictions(y, buyers, slots).join(y, ["customer_id", "article_id"])
    one = catalog_models.evaluate_chained(pred, slots, 4, y, scored).first()
    two = catalog_models.evaluate_chained(pred, slots, 4, y, scored, buyers).first()
    assert one == two and one.n_pairs == 108


def test_only_buyers_are_predicted_for_the_pairs(spark, monkeypatch):
    """Wide predictions are written nowhere, and joins take the narrow inputs."""
    x = spark.createDataFrame([(f"c{i}", i % 3, float(i)) for i in range(30)], "customer_id string, age_idx int, z double")
    y = spark.createDataFrame([("c1", 1, 2), ("c2", 2, 1)], "customer_id string, article_id long, y long")
    slots = spark.createDataFrame([(1, [0]), (2, [1])], "article_id long, slots array<int>")
    given = []
    monkeypatch.setattr(catalog_models, "_fit", lambda *_: (None, x, 2, 5))
    monkeypatch.setattr(catalog_models, "_test_purchases", lambda *_: y)
    monkeypatch.setattr(catalog_models.R, "live_slots", lambda *_: slots)
    monkeypatch.setattr(model, "coef_matrix", lambda *_: None)

    def predict(rows, *_):
        given.append(rows.count())
        return rows.selectExpr("customer_id", "array(z, z + age_idx) as pred")
    monkeypatch.setattr(model, "predict_prefs", predict)
    row = catalog_models.eval_chained_fit(spark, "").first()
    assert row.n_pairs == 60 and sorted(given) == [2, 2, 30]
