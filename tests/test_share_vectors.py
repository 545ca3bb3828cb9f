"""Share vectors straight from purchases, on rows made here."""

import random

import pytest

from boutique.operators import prefs


@pytest.mark.parametrize("numbers", [1 << 22, 12])
def test_vectors_equal_those_of_the_long_shares(spark, monkeypatch, numbers):
    monkeypatch.setattr(prefs, "SLICE_NUMBERS", numbers)
    rng, width = random.Random(3), 6
    people = [None, "a", "b", "c", "hot", *[f"p{i}" for i in range(40)]]
    rows = [(rng.choice(people), rng.choice([None, *range(12)]), rng.randint(1, 4)) for _ in range(300)]
    rows += [("hot", rng.randrange(12), 1) for _ in range(500)] + [("none", 99, 1)]
    purch = spark.createDataFrame(rows, "customer_id string, article_id long, n long").repartition(3)
    art = [(a, rng.randrange(width)) for a in range(12) for _ in range(3)] + [(1, 5), (1, 5), (None, 2)]
    art = spark.createDataFrame(art, "article_id long, feature_idx long")
    want = prefs.pref_vectors(prefs.pref_shares(prefs.pref_counts(purch, art)), width)
    got = prefs.share_vectors(purch, art, width)
    assert got.dtypes == want.dtypes
    assert {r.customer_id: r.prefs for r in got.collect()} == {r.customer_id: r.prefs for r in want.collect()}
    assert got.count() == want.count()
    assert prefs.share_vectors(purch.limit(0), art, width).collect() == []
