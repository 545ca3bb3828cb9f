"""Scores of several labelings, block by block."""

import numpy as np
from pyspark.sql import functions as F

from boutique.operators import cluster, quality


def test_scores_of_labels_match_the_sample_scores_in_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 3))
    x[40:60] = x[0]
    label = rng.integers(0, 7, 150)
    pts = spark.createDataFrame([(int(i // 2), [float(v) for v in x[i]], int(label[i])) for i in range(150)], "k0 long, v array<double>, l int")
    # Repeated keys: pairs of rows share one, and carry equal rows here.
    pts = pts.where("k0 * 2 < 150").dropDuplicates(["k0"])
    pts = pts.unionByName(pts.where("k0 < 10"))
    labels = pts.select("k0", F.explode(F.array(F.lit(2), F.lit(5))).alias("k"), "l").select("k", "k0", (F.col("l") % F.col("k")).alias("label"))
    monkeypatch.setattr(quality, "LABELING_NUMBERS", 60)
    monkeypatch.setattr(quality, "LABELING_ROWS", 16)
    rows = pts.collect()
    v, ls = np.array([r.v for r in rows]), np.array([r.l for r in rows])
    for r in cluster.score_labels(pts, "k0", "v", labels).collect():
        want = quality.sample_scores(v, ls % r.k)
        assert np.allclose((r.davies_bouldin_score, r.silhouette_score, r.calinski_harabasz_score), want, atol=2e-6)
        assert (r.method, r.n_features, r.n_noise) == ("given", len(np.unique(ls % r.k)), 0)
