"""Gram entries from share vectors against those of the long shares, on rows made here."""

import random

import pytest

from boutique.operators import model, prefs


@pytest.mark.parametrize("group", [None, "segment"])
def test_vector_gram_equals_the_gram_of_long_shares(spark, group):
    rng = random.Random(8)
    ids = [f"c{i}" for i in range(40)]
    shares = [(c, f, rng.random()) for c in [*ids, None, "no x"] for f in sorted(rng.sample(range(5), 3))]
    shares = spark.createDataFrame(shares, "customer_id string, feature_idx long, share double")
    rows = [(c, rng.randrange(4), rng.choice("ab"), float(rng.randrange(2)), rng.random()) for c in ids]
    rows += rows[:5] + [(None, 1, "a", 1.0, 1.0), ("no shares", 1, "a", 1.0, 1.0)]  # repeated and unmatched rows
    x = spark.createDataFrame(rows, "customer_id string, age_idx int, segment string, `p q` double, r double")
    cols = ["p q", "r"]
    key = lambda r: ((r.segment if group else None), r.block, r.i, r.j)
    want = {key(r): r.value for r in model.gram(x, shares, cols, group=group, n_age=4).collect() if r.value}
    vecs = prefs.pref_vectors(shares, 5)
    got = {key(r): r.value for r in model.vector_gram(x, vecs, cols, 5, group=group, n_age=4).collect()}
    assert got == pytest.approx(want, abs=1e-12) and set(got) == set(want)
    assert model.vector_gram(x.limit(0), vecs, cols, 5, group=group, n_age=4).collect() == []
