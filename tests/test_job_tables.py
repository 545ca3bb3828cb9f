"""The job adds the transactions up once, and its tables are what the operators give."""

import tempfile

import numpy as np

from boutique import params as P
from boutique import sources as src
from boutique.operators import blocks, encode, model, prefs, tree
from boutique.plans import catalog_models, jobs
from boutique.plans import retail as R
from conftest import SF001


def test_job_tables_come_from_one_aggregate(spark, monkeypatch):
    reads, read = [], src.transactions
    monkeypatch.setattr(src, "transactions", lambda *a, **k: reads.append(a) or read(*a, **k))
    paths = jobs.run(spark, SF001, tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/tables")
    assert len(reads) == 2  # the lines of the preferences, and one aggregate for all else
    table = {k: spark.read.parquet(p) for k, p in paths.items()}
    codes = encode.dense_codes(src.customers(spark, SF001), ["customer_id"], "code")
    for name, want in (("first_last_date", R.lifespans(spark, SF001)), ("pref", R.shares(spark, SF001)),
                       ("test_df", prefs.purchase_matrix(read(spark, SF001), codes)),
                       ("customer_info", catalog_models.cluster_orders(spark, SF001))):
        got = table[name].select(*want.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str), name
    cols = model.INFO_COLS + model.CLUSTER_COLS
    std = model.standardise(table["customer_info"].select("customer_id", *model.CLUSTER_COLS), model.CLUSTER_COLS)
    x = model.model_inputs(table["customer_info"], table["pref"], extra=std, extra_cols=model.CLUSTER_COLS)
    p, width = 1 + P.AGE_CATEGORIES + len(cols), R.feature_width(spark, SF001)
    want = model.coef_matrix(model.fit_pref_regression(model.gram(x, table["pref"], cols), p, width, P.L1_STRENGTH), p, width)
    assert np.allclose(model.coef_matrix(table["cx_pref"], p, width), want, atol=1e-7)


def test_tree_takes_large_blocks(spark, monkeypatch):
    sizes, pack = [], blocks.packed
    monkeypatch.setattr(blocks, "packed", lambda df, rows=blocks.LEFT_ROWS: sizes.append(rows) or pack(df, rows))
    rng = np.random.default_rng(3)
    rows = [(i, "ab"[i % 2], [float(v) for v in rng.integers(0, 9, 4)]) for i in range(300)]
    points = spark.createDataFrame(rows, "id long, grp string, v array<double>").coalesce(1)
    grown = tree.grow(points, "id", "v", {"a": 6, "b": 4})
    assert sizes == [tree.BLOCK_NUMBERS // 4]
    for g, most in (("a", 6), ("b", 4)):
        x = np.array([v for _, h, v in rows if h == g])
        assert len(grown.leaves(g)) == most
        for path, at in tree.descend(x, grown.splits[g]):
            assert grown.size[g, path] == len(at)
            assert abs(grown.sse[g, path] - ((x[at] - x[at].mean(axis=0)) ** 2).sum()) < 1e-6
