"""Sweeps fit and score every row, held by one task or in blocks."""

import numpy as np

from boutique.operators import cluster, quality
from boutique.plans import catalog_models


def _points(spark, n=240):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, 3)) + 8 * rng.integers(0, 4, (n, 1))
    x[20:30] = x[3]
    return spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(n)], "k long, v array<double>").repartition(3)


def test_blocks_give_the_scores_of_one_task(spark, monkeypatch):
    df, ks = _points(spark), [2, 5, 9, 30]
    run = lambda: sorted(tuple(r) for r in cluster.sweep(df, "k", "v", ks, 42, methods=("kmeans", "tree")).collect())
    want = run()
    monkeypatch.setattr(cluster, "TASK_NUMBERS", 100)
    monkeypatch.setattr(cluster, "PASS_CLUSTERS", 12)
    monkeypatch.setattr(quality, "LABELING_ROWS", 50)
    monkeypatch.setattr(quality, "LABELING_NUMBERS", 90)
    got = run()
    assert [r[:2] for r in got] == [r[:2] for r in want] == sorted((m, k) for m in ("kmeans", "tree") for k in ks)
    for a, b in zip(got, want):
        assert a[5:] == b[5:] and np.allclose(a[2:5], b[2:5], atol=2e-6)


def test_the_queries_read_every_row(spark, monkeypatch):
    df = _points(spark)
    monkeypatch.setattr(catalog_models.P, "CLUSTER_SAMPLE", 50)
    monkeypatch.setattr(catalog_models, "_segment_vectors", lambda *_: df.withColumnsRenamed({"k": "customer_id", "v": "prefs"}))
    monkeypatch.setattr(catalog_models.P, "KGRID_FAMILY", (100, 102, 1))
    assert sorted(r["k"] for r in catalog_models.sweep_family(spark, "").collect()) == [100, 100, 101, 101]  # above 50 rows
    assert sorted(r["k"] for r in catalog_models.kmeans_sweep(spark, "").collect()) == [10, 20, 30]


def test_cuts_of_a_tree_share_the_sums_of_its_leaves():
    rng = np.random.default_rng(3)
    x, leaf = rng.normal(size=(200, 4)), rng.integers(0, 12, 200)
    labels = [leaf // 6, leaf // 3, leaf]
    joint, parts = quality._refinement(labels)
    assert joint.max() == 11 and [p.tolist() for p in parts] == [[i // 6 for i in range(12)], [i // 3 for i in range(12)], list(range(12))]
    assert np.allclose(quality.samples_scores(x, labels), [quality.sample_scores(x, label) for label in labels], atol=2e-6)
