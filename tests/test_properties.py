"""Properties of the pipeline on the driver's tables, and brute-force
checks of the operators that have no SQL oracle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from boutique import params as P
from boutique.operators import cluster, lifespan, model, quality, score, tree
from boutique.plans import catalog, catalog_models  # noqa: F401
from boutique.plans import retail as R
from conftest import SF001, SF01


def test_shares_sum_to_one(spark):
    s = R.shares(spark, SF001).groupBy("customer_id").agg(F.sum("share").alias("t"))
    assert all(abs(r.t - 1.0) < 1e-9 for r in s.collect())


def test_customer_codes_are_a_bijection(spark):
    codes = catalog.QUERIES["customer_codes"](spark, SF001)
    got = sorted(r.code for r in codes.collect())
    assert got == list(range(len(got)))
    ids = [r.customer_id for r in codes.orderBy("code").collect()]
    assert ids == sorted(ids)


def test_codes_partition_independent(spark):
    from boutique.operators import encode
    from boutique import sources
    base = {r[0]: r[1] for r in encode.dense_codes(sources.customers(spark, SF001), ["customer_id"],
                                                   "code", partitions=1).collect()}
    many = {r[0]: r[1] for r in encode.dense_codes(sources.customers(spark, SF001), ["customer_id"],
                                                   "code", partitions=7).collect()}
    assert base == many


def test_segment_counts_cover_every_customer(spark):
    got = {r.segment: r.n for r in catalog.QUERIES["segment_counts"](spark, SF001).collect()}
    assert got == {"female": 1, "family": 149}


def test_cutoffs_split_articles(spark):
    before = {r[0] for r in catalog.QUERIES["articles_before"](spark, SF001).select("article_id").collect()}
    after = {r[0] for r in catalog.QUERIES["articles_from"](spark, SF001).select("article_id").collect()}
    sold = {r[0] for r in R.lifespans(spark, SF001).select("article_id").collect()}
    assert not before & after and before | after == sold
    assert len(before) == 74


def test_unsold_and_live_counts(spark):
    articles = spark.createDataFrame([(1,), (2,), (3,)], "article_id long")
    sales = spark.createDataFrame([(1,), (1,), (3,), (None,)], "article_id long")
    assert [r.article_id for r in lifespan.unsold_articles(articles, sales).collect()] == [2]
    assert catalog.QUERIES["live_articles"](spark, SF001).count() == 154


def test_pref_shares_partition_independent(spark):
    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            return sorted(tuple(r) for r in R.shares(spark, SF001).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert run(1) == run(5)


def _grow(spark, rows, leaves, n=3):
    points = spark.createDataFrame([(i, g, [float(v) for v in x]) for i, g, x in rows], "k int, grp string, v array<double>")
    return points, tree.grow(points.repartition(n), "k", "v", leaves)


def test_tree_splits_groups_apart_and_ignores_the_layout(spark):
    rng = np.random.default_rng(3)
    spots = np.array([[0, 0], [10, 0], [0, 12], [30, 30]])
    rows = [(i, "a", spots[i % 4] + rng.normal(0, 0.3, 2)) for i in range(80)] + [(100 + i, "b", [1, 1]) for i in range(9)]
    rows += [(200 + i, "c", [i, 0]) for i in range(2)]
    results = []
    for n in (1, 7):
        points, grown = _grow(spark, rows, {"a": 4, "b": 5, "c": 9, "none": 3}, n)
        assert len(grown.leaves("a")) == 4 and grown.leaves("b") == [""] and len(grown.leaves("c")) == 2
        path = {(r.k, r.grp): r.path for r in grown.rows(points, "k", "v").collect()}
        assert {len({path[i, "a"] for i in range(80) if i % 4 == s}) for s in range(4)} == {1}
        cuts = grown.cuts("a")
        for k in range(1, 5):
            assert len({c[k - 1] for c in cuts.values()}) == k
        assert all(len({c[k] for c in cuts.values() if c[k - 1] == x}) <= 2 for k in range(1, 4) for x in range(k))
        ranks = tree.leaf_ranks(grown.rows(points, "k", "v"), "k").collect()
        assert sorted(r.order for r in ranks if r.grp == "a") == list(range(80))
        results.append((path, sorted(map(tuple, ranks)), grown.sse))
    assert results[0] == results[1]


def test_tree_of_nothing(spark):
    empty, grown = _grow(spark, [], {"a": 4})
    assert grown.leaves("a") == [] and grown.cuts("a") == {} and grown.rows(empty, "k", "v").count() == 0


def test_sums_of_squares_of_the_tree(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1e6, (200, 5))
    points, grown = _grow(spark, [(i, "a", v) for i, v in enumerate(x)], {"a": 6})
    label = {r.k: r.path for r in grown.rows(points, "k", "v").collect()}
    for leaf in grown.leaves("a"):
        own = x[[i for i in range(200) if label[i] == leaf]]
        assert len(own) == grown.size["a", leaf] and np.isclose(((own - own.mean(0)) ** 2).sum(), grown.sse["a", leaf])


def test_kmeans_of_large_values_and_bad_ones(spark):
    rows = [(i, [1e7 * (i % 3), float(i % 3)]) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, v array<double>")
    centers, got = cluster.kmeans(df, "k", "v", 3, 1)
    assert sorted(map(tuple, centers.tolist())) == [(0.0, 0.0), (1e7, 1.0), (2e7, 2.0)]
    assert len({(r.k % 3, r.cluster) for r in got.collect()}) == 3
    with pytest.raises(ValueError):
        cluster.kmeans(spark.createDataFrame([(1, [float("inf")]), (2, [1.0])], "k int, v array<double>"), "k", "v", 1, 1)


def test_predict_over_many_blocks(spark, monkeypatch):
    from boutique import sources
    from boutique.operators import blocks
    emb = sources.embeddings(spark, SF001)
    held = emb.where("vec_id % 3 = 0").select((F.col("vec_id") / 3).cast("int").alias("cluster"), F.col("embedding").alias("centre"))
    one = sorted(map(tuple, cluster.predict(emb, "vec_id", "embedding", held).collect()))
    x = np.array([r.embedding for r in emb.orderBy("vec_id").collect()])
    d = ((x[:, None, :] - x[None, ::3, :]) ** 2).sum(-1)
    assert one == [(i, int(c)) for i, c in enumerate(d.argmin(axis=1))]
    assert len(blocks.numbered(held, "cluster", 20)[0].collect()) > 1


def test_sweep_fits_and_scores(spark):
    rng = np.random.default_rng(5)
    spots = rng.normal(0, 50, (6, 4))
    rows = [(f"c{i}", [float(v) for v in spots[i % 6] + rng.normal(0, 1, 4)]) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, v array<double>")
    got = cluster.sweep(df, "k", "v", [2, 4, 6, 8, 500], 42, 1000, ("kmeans", "tree")).collect()
    assert sorted((r.method, r.k) for r in got) == [(m, k) for m in ("kmeans", "tree") for k in (2, 4, 6, 8)]
    assert max((r for r in got if r.method == "tree"), key=lambda r: r.silhouette_score).k == 6
    labels = df.select("k", (F.substring("k", 2, 9).cast("int") % 6).alias("label"))
    pts = df.join(labels, "k")
    want = (quality.davies_bouldin(pts, "v", "label").first()[0], quality.silhouette(pts, "k", "v", "label", block=20).first()[0],
            quality.calinski_harabasz(pts, "v", "label").first()[0])
    six = next(r for r in got if (r.method, r.k) == ("tree", 6))
    assert np.allclose((six.davies_bouldin_score, six.silhouette_score, six.calinski_harabasz_score), want, atol=2e-6)
    assert cluster.sweep(df.limit(0), "k", "v", [2], 42, 10, ("kmeans", "tree")).count() == 0


def test_rank_capped_fit(spark):
    rng = np.random.default_rng(6)
    X = np.hstack([np.ones((300, 1)), rng.normal(size=(300, 6)), np.zeros((300, 1))])
    Y = X @ rng.normal(size=(8, 9)) + rng.normal(size=(300, 9))
    G, C = X.T @ X, X.T @ Y
    B = model.reduced_rank(G, C, 300, 2)
    assert model.rank_conditions(G, C, 300, 2, B).all() and np.linalg.matrix_rank(B[1:]) == 2
    loss = lambda b: ((Y - X @ b) ** 2).sum()
    U, s, V = np.linalg.svd(np.linalg.lstsq(X, Y, rcond=None)[0][1:], full_matrices=False)
    other = np.vstack([Y.mean(0) - X[:, 1:].mean(0) @ ((U[:, :2] * s[:2]) @ V[:2]), (U[:, :2] * s[:2]) @ V[:2]])
    assert loss(B) <= loss(other) + 1e-9
    assert not model.rank_conditions(G, C, 300, 2, model.reduced_rank(G, C, 300, 3)).all()
    L = model.lasso_standardised(G, C, 300, 0.1)
    assert model.lasso_conditions(G, C, 300, 0.1, L).all() and not model.lasso_conditions(G, C, 300, 0.1, L * 1.01).all()


def test_lasso_optimality():
    rng = np.random.default_rng(0)
    X = np.hstack([np.ones((200, 1)), rng.normal(size=(200, 5))])
    Y = X @ rng.normal(size=(6, 3)) + 0.1 * rng.normal(size=(200, 3))
    lam = 0.05
    B = model.lasso_gram(X.T @ X, X.T @ Y, len(X), lam, tol=1e-12, max_iter=10000)
    grad = X.T @ (Y - X @ B) / len(X)
    assert np.allclose(grad[0], 0, atol=1e-6)
    nz = B[1:] != 0
    assert np.allclose(grad[1:][nz], lam * np.sign(B[1:][nz]), atol=1e-6)
    assert np.all(np.abs(grad[1:][~nz]) <= lam + 1e-6)


def _everything(spark, d):
    """Vectors, slots, width and the dense scores of every pair."""
    width = R.feature_width(spark, d)
    counts = R.counts(spark, d)
    slots = R.live_slots(spark, d)
    vec = {}
    for r in counts.collect():
        vec.setdefault(r.customer_id, {})[r.feature_idx] = r.n
    arts = {r.article_id: list(r.slots) for r in slots.collect()}
    raw = {(c, a): sum(v.get(f, 0) for f in s) for c, v in vec.items() for a, s in arts.items()}
    total = {c: sum(v.values()) for c, v in vec.items()}
    return score.count_vectors(counts, width), slots, width, raw, total


@pytest.mark.parametrize("right_rows", [4096, 40])
def test_scores_match_brute_force(spark, right_rows):
    vecs, slots, width, raw, total = _everything(spark, SF001)
    got = score.topk(vecs, slots, width, 5, right_rows=right_rows).collect()
    best = {}
    for (c, a), s in raw.items():
        best.setdefault(c, []).append((-s, a))
    for c, some in best.items():
        assert [(r.rank, r.article_id, r.raw_score) for r in sorted((r for r in got if r.customer_id == c), key=lambda r: r.rank)] == \
            [(i + 1, a, -s) for i, (s, a) in enumerate(sorted(some)[:5])]
    lse = {r.customer_id: r.lse for r in score.log_sum_exp(vecs, slots, width, right_rows=right_rows).collect()}
    for c in total:
        assert abs(lse[c] - np.log(sum(np.exp(-s / total[c]) for s, _ in best[c]))) < 1e-9
    groups = {r.score: r.n for r in score.score_groups(vecs, slots, width, right_rows=right_rows).collect()}
    want = {}
    for (c, a), s in raw.items():
        want[s / total[c]] = want.get(s / total[c], 0) + 1
    assert groups == want
    q = score.sum_of_squares(vecs, slots, width).first().q
    assert abs(q - sum((s / total[c]) ** 2 for (c, _), s in raw.items())) < 1e-6


def test_signatures_hold_every_article(spark):
    slots = spark.createDataFrame([(i, [1, 2] if i < 70 else [i % 3]) for i in range(100)] + [(100, [])], "article_id long, slots array<int>")
    got = {tuple(r.slots): (r.first, r.n, r.ids) for r in score.signatures(slots, 3).collect()}
    assert got[1, 2] == (0, 70, [0, 1, 2]) and sum(n for _, n, _ in got.values()) == 101 and got[()] == (100, 1, [100])


def test_exact_auc_with_ties(spark):
    rng = np.random.default_rng(8)
    s, y = rng.integers(0, 12, 400) / 7, rng.integers(0, 5, 400) == 0
    rows = {}
    for a, b in zip(s, y):
        n, p = rows.get(a, (0, 0))
        rows[a] = (n + 1, p + int(b))
    groups = spark.createDataFrame([(float(a), n) for a, (n, _) in rows.items()], "score double, n long")
    pos = spark.createDataFrame([(float(a), p) for a, (_, p) in rows.items() if p], "score double, p long")
    want = np.mean([(a > b) + 0.5 * (a == b) for a in s[y] for b in s[~y]])
    assert abs(score.rank_auc(groups, pos).first().auc - want) < 1e-9
    assert score.rank_auc(groups.limit(0), pos).first().auc is None


def test_chained_evaluation_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    pred = spark.createDataFrame([(f"c{i}", [float(v) for v in rng.normal(size=6)]) for i in range(9)], "customer_id string, pred array<double>")
    arts = [(i, sorted(rng.choice(6, rng.integers(0, 4), replace=False).tolist())) for i in range(14)]
    slots = spark.createDataFrame(arts, "article_id long, slots array<int>")
    bought = [(f"c{i}", int(a), int(y)) for i in range(7) for a, y in zip(rng.choice(14, 3, replace=False), rng.integers(1, 4, 3))]
    y = spark.createDataFrame(bought, "customer_id string, article_id long, y long")
    scored = score.pair_predictions(y, pred, slots).join(y, ["customer_id", "article_id"])
    got = catalog_models.evaluate_chained(pred, slots, 6, y, scored).first()
    p = {(r.customer_id, a): sum(r.pred[f] for f in s) for r in pred.collect() for a, s in arts}
    times = {(c, a): n for c, a, n in bought}
    mse = np.mean([(times.get(k, 0) - v) ** 2 for k, v in p.items()])
    lse = {f"c{i}": np.log(sum(np.exp(p[f"c{i}", a]) for a, _ in arts)) for i in range(9)}
    ce = sum(n * (lse[c] - p[c, a]) for (c, a), n in times.items()) / sum(times.values())
    top = {f"c{i}": min((-p[f"c{i}", a], a) for a, _ in arts)[1] for i in range(9)}
    acc = sum(n for (c, a), n in times.items() if top[c] == a) / sum(times.values())
    assert np.allclose((got.mse, got.cross_entropy, got.accuracy), (mse, ce, acc), atol=1e-8) and got.n_pairs == 9 * 14


def test_silhouette_over_blocks_matches_brute_force(spark):
    from boutique import sources
    emb = sources.embeddings(spark, SF001)
    full = quality.silhouette(emb, "vec_id", block=50).first()[0]
    x = np.array([r.embedding for r in emb.orderBy("vec_id").collect()])
    lab = np.array([r.label for r in emb.orderBy("vec_id").collect()])
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        own = (lab == lab[i])
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == l].mean() for l in set(lab) if l != lab[i])
        s.append((b - a) / max(a, b))
    assert abs(full - round(float(np.mean(s)), 6)) < 1e-6
    assert quality.sample_points(emb, "vec_id", 17, 1).count() == 17


def test_lloyd_cost_does_not_rise(spark):
    from boutique import sources
    emb = sources.embeddings(spark, SF001)
    costs = []
    for steps in (0, 1, 2, 3):
        lab = cluster.lloyd(emb, "vec_id", "embedding", 5, steps).join(emb, "vec_id")
        st = quality.cluster_stats(lab, "embedding", "cluster")
        costs.append(st.agg(F.sum("sse")).first()[0])
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_segment_regression_rejects_unknown(spark):
    with pytest.raises(ValueError):
        catalog_models.train_segment(spark, SF001, "x")


def test_topk_partition_independent(spark):
    width = R.feature_width(spark, SF001)

    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            top = score.topk(score.count_vectors(R.counts(spark, SF001), width), R.live_slots(spark, SF001), width, 5)
            return sorted(map(tuple, top.select("customer_id", "rank", "article_id").collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert run(1) == run(5)


def test_regression_depends_on_its_inputs(spark):
    from boutique.operators import model
    rng = np.random.default_rng(3)
    n, cols = 400, ["a", "b"]
    rows = [(f"c{i}", int(i % 4), float(rng.integers(2)), float(rng.integers(2))) for i in range(n)]
    x = spark.createDataFrame(rows, "customer_id string, age_idx int, a double, b double")
    shares = spark.createDataFrame(
        [(c, f, 0.01 * (1 + (f == 0) * a + (f == 1) * (g == 2))) for c, g, a, b in rows for f in (0, 1)],
        "customer_id string, feature_idx long, share double")
    g = model.gram(x, shares, cols, n_age=4)
    coefs = model.fit_pref_regression(g, 1 + 4 + 2, 2, 0.05)
    assert coefs.where("x_idx > 0").count() > 0
    B = model.coef_matrix(coefs, 7, 2)
    pred = {(r.age_idx, r.a): tuple(r.pred) for r in
            model.predict_prefs(x, B, cols, n_age=4).join(x, "customer_id").collect()}
    assert abs(pred[0, 1.0][0] - 0.02) < 1e-3 and abs(pred[0, 0.0][0] - 0.01) < 1e-3
    assert pred[2, 0.0][1] > pred[1, 0.0][1] + 0.005


def test_kmeans_does_not_depend_on_the_layout(spark):
    from boutique import sources
    emb = sources.embeddings(spark, SF001)
    runs = [cluster.kmeans(emb.repartition(n), "vec_id", "embedding", 7, 42) for n in (1, 4, 16)]
    labels = [sorted(map(tuple, rows.select("vec_id", "cluster").collect())) for _, rows in runs]
    assert labels[0] == labels[1] == labels[2]
    assert all((runs[0][0] == c).all() for c, _ in runs)
    with pytest.raises(ValueError):
        cluster.kmeans(emb.limit(3), "vec_id", "embedding", 4, 42)


def test_wide_rows_hold_every_nonzero_cell(spark):
    from boutique.operators import encode
    long = spark.createDataFrame([("a", 3, 2), ("a", 1, 5), ("b", 2, 7)], "k string, i int, v int")
    got = {r.k: (r.idx, r.val) for r in encode.wide_from_long(long, "k", "i", "v").collect()}
    assert got == {"a": ([1, 3], [5, 2]), "b": ([2], [7])}
