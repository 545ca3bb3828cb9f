"""What the fits and scores of one sweep share."""

import numpy as np

from boutique.operators import cluster, quality


def test_labelings_share_the_distances_of_the_rows(monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, 4))
    labels = [rng.integers(0, k, 90) for k in (2, 7, 30)] + [np.zeros(90, int), np.arange(90)]
    want = [quality.sample_scores(x, label) for label in labels]
    calls, real = [], quality._distances
    monkeypatch.setattr(quality, "SILHOUETTE_BLOCK", 40)
    monkeypatch.setattr(quality, "_distances", lambda a, b: calls.append(len(b)) or real(a, b))
    got = quality.samples_scores(x, labels)
    assert np.allclose(got[:3], want[:3], atol=2e-6) and got[3:] == want[3:] == [(None, None, None)] * 2
    assert calls.count(90) == 3  # the blocks once, not once for each labeling


def test_only_centres_that_moved_are_measured_again(monkeypatch):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(200, 3)), rng.normal(size=(40, 3)) + 30])
    x = x[rng.permutation(len(x))]
    far, sizes = cluster._far, []
    monkeypatch.setattr(cluster, "_far", lambda a, c: sizes.append(len(c)) or far(a, c))
    label = cluster._fit_sample(x, 12)
    assert sizes[0] == 12 and min(sizes) < 12
    # The plain steps.
    centers, old = x[:12].copy(), np.full(len(x), -1)
    while not np.array_equal(new := np.round(((x[:, None] - centers) ** 2).sum(axis=2), 9).argmin(axis=1), old):
        old = new
        for c in np.unique(new):
            centers[c] = x[new == c].mean(axis=0)
    assert np.array_equal(label, old)
