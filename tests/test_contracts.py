"""Golden toy frames for the one-hot, null, threshold and join contracts."""

import datetime as dt

from pyspark.sql import functions as F

from boutique.functions import clean
from boutique.operators import customers as cust
from boutique.operators import encode, lifespan


def test_onehot_null_and_drop_first(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id int, a string")
    out = {r["id"]: r for r in encode.onehot_columns(df, ["a"]).collect()}
    assert [out[i]["a_b"] for i in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert [out[i]["a_c"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert "a_a" not in encode.onehot_columns(df, ["a"]).columns


def test_numeric_categories_sort_as_numbers(spark):
    df = spark.createDataFrame([(1, 10), (2, 9), (3, 100)], "article_id long, x int")
    d = {r["value"]: r["feature_idx"] for r in encode.feature_dictionary(df, ["x"]).collect()}
    assert d["9"] is None and d["10"] == 0 and d["100"] == 1


def test_news_cleaning(spark):
    df = spark.createDataFrame([("NONE",), (None,), ("None",), ("Monthly",), ("Regularly",)], "n string")
    got = [r[0] for r in df.select(clean.clean_news("n")).collect()]
    assert got == ["NONE", "NONE", "NONE", "Regularly", "Regularly"]


def test_share_with_zero_total(spark):
    df = spark.createDataFrame([(0, 0), (1, 3)], "a long, b long")
    got = df.select(clean.share("a", F.col("a") + F.col("b")).alias("x"),
                    clean.share("b", F.col("a") + F.col("b")).alias("y")).collect()
    assert [(r.x, r.y) for r in got] == [(0.0, 0.0), (0.25, 0.75)]


def test_group_sum_of_nulls_is_zero(spark):
    purch = spark.createDataFrame([("k1", 1, 1), ("k1", 2, 1), ("k2", 3, 1)],
                                  "customer_id string, article_id long, n long")
    flags = spark.createDataFrame([(2, 1, 0, 0)], "article_id long, female int, male int, children int")
    got = {r.customer_id: r.female for r in cust.gender_sums(purch, flags).collect()}
    assert got == {"k1": 1, "k2": 0}


def test_segment_edge(spark):
    df = spark.createDataFrame([(0.75, 0.0), (0.8, 0.0), (0.2, 0.0)], "male double, female double")
    got = [r[0] for r in df.select(cust.segment_label()).collect()]
    assert got == ["boundary", "male", "family"]


def test_truncate_toward_zero(spark):
    df = spark.createDataFrame([(0.99999,), (-0.55555,)], "s double")
    assert [r[0] for r in df.select(clean.scale_trunc("s")).collect()] == [9999, -5555]


def test_date_range_with_null(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, None), (3, dt.date(2019, 1, 1))],
                               "id int, Last_Date date")
    got = [r.id for r in lifespan.last_sale_between(df, first_cutoff="2019-09-01").collect()]
    assert got == [1]
    assert lifespan.last_sale_between(df).count() == 3


def test_anti_join_with_null_in_list(spark):
    a = spark.createDataFrame([(1,), (2,)], "article_id long")
    t = spark.createDataFrame([(1,), (None,)], "article_id long")
    assert [r[0] for r in lifespan.unsold_articles(a, t).collect()] == [2]


def test_full_join_then_fill(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "customer_id int, x int")
    b = spark.createDataFrame([(2, 7), (3, 8)], "customer_id int, full_order int")
    got = sorted(tuple(r) for r in a.join(b, "customer_id", "full").na.fill(0).collect())
    assert got == [(1, 5, 0), (2, 6, 7), (3, 0, 8)]


def test_lookup_unknown_id(spark):
    df = spark.createDataFrame([("x",), ("q",)], "id string")
    d = spark.createDataFrame([("x", 0), ("y", 1)], "k string, code long")
    got = {r.id: r.code for r in encode.lookup(df, "id", d, "k", "code", "code").collect()}
    assert got == {"x": 0, "q": None}


def test_section_filter_keeps_null_on_exclude(spark):
    df = spark.createDataFrame([(1, 22), (2, None), (3, 5)], "article_id long, section_no int")
    assert sorted(r[0] for r in cust.section_filter(df, [22], exclude=True).collect()) == [2, 3]
    assert [r[0] for r in cust.section_filter(df, [22], exclude=False).collect()] == [1]
