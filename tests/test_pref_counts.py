"""Preference counts on rows made here."""

from boutique.operators import prefs


def test_counts_of_repeated_articles_and_one_exchange_by_customer(spark):
    purch = spark.createDataFrame([("a", 1, 2), ("a", 2, 1), ("b", 2, 5), (None, 1, 1), ("b", 9, 1), ("c", None, 1)],
                                  "customer_id string, article_id long, n long")
    art = spark.createDataFrame([(1, 0), (1, 3), (2, 3), (2, 3), (None, 7)], "article_id long, feature_idx long")
    out = prefs.pref_counts(purch, art)
    got = {(r.customer_id, r.feature_idx): r.n for r in out.collect()}
    assert got == {("a", 0): 2, ("a", 3): 4, ("b", 3): 10, (None, 0): 1, (None, 3): 1}
    # Rows are summed where the shuffle by customer puts them, not shuffled again by feature.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any("hashpartitioning" in line and "feature_idx" in line for line in plan.splitlines())
