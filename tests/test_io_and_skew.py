"""CSV sources/sinks with date parsing, and results under a hot key."""

import tempfile

from pyspark.sql import functions as F

from boutique import sources
from boutique.functions import clean
from boutique.operators import customers as cust
from boutique.operators import lifespan, prefs
from boutique.operators.cluster import best_k
from boutique.sources.files import TRANSACTIONS_SCHEMA, peek, read_transactions_csv
from boutique.sources.sinks import next_version, write_table
from conftest import SF001


def test_csv_round_trip_with_strict_dates(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    tx = sources.transactions(spark, SF001)
    out = tx.select(F.date_format("t_dat", "yyyy-MM-dd").alias("t_dat"), "customer_id",
                    "article_id", "price", "sales_channel_id")
    path = write_table(out, f"{root}/tx_csv", fmt="csv")
    back = read_transactions_csv(spark, path)
    assert [f.name for f in back.schema.fields] == [f.name for f in TRANSACTIONS_SCHEMA.fields]
    a = sorted(map(tuple, lifespan.lifespan(back).collect()))
    b = sorted(map(tuple, lifespan.lifespan(tx).collect()))
    assert a == b
    assert peek(back).count() == 1


def test_versions_never_overwrite(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    v0 = next_version(spark, f"{root}/t")
    write_table(spark.range(3), v0)
    v1 = next_version(spark, f"{root}/t")
    assert v0.endswith("/v0") and v1.endswith("/v1")


def test_lenient_date_parse(spark):
    df = spark.createDataFrame([("2020-08-27",), ("2020-08-27 10:11:12",), ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(clean.parse_date_lenient("s")).collect()]
    assert [str(g) if g else None for g in got] == ["2020-08-27", "2020-08-27", None, None]


def test_live_range_over_text_dates(spark):
    df = spark.createDataFrame([(1, "2020-08-27 10:11:12"), (2, "2020-08-26"), (3, "junk"), (4, None)],
                               "article_id long, Last_Date string")
    assert [r[0] for r in lifespan.last_sale_between(df, "2020-08-27").select("article_id").collect()] == [1]


def test_pref_counts_under_a_hot_article(spark):
    """One article holds a third of all purchase lines; the counts must not
    change when AQE splits its skewed join partition."""
    rows = [(f"c{i % 50}", 7 if i % 3 == 0 else i % 40) for i in range(3000)]
    tx = spark.createDataFrame(rows, "customer_id string, article_id long")
    art_long = spark.createDataFrame([(a, a % 5) for a in range(40)] + [(a, 5 + a % 3) for a in range(40)],
                                     "article_id long, feature_idx long")

    def run(skew: bool):
        conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1" if skew else "256MB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1" if skew else "5",
                "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
        old = {k: spark.conf.get(k, None) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            return sorted(map(tuple, prefs.pref_counts(cust.purchases(tx), art_long).collect()))
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    assert run(True) == run(False)


def test_best_k(spark):
    t = spark.createDataFrame([(10, 0.2), (20, 0.5), (30, 0.5), (40, None)],
                              "k int, silhouette_score double")
    assert best_k(t).first()["k"] == 20


def test_read_scope_reuses_within_and_refreshes_after(spark):
    from boutique.sources.tables import read_scope, read_table
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.range(3).write.parquet(f"{root}/t.parquet")
    with read_scope():
        a, b = read_table(spark, root, "t"), read_table(spark, root, "t")
        assert a is b
    spark.range(5).write.mode("append").parquet(f"{root}/t.parquet")
    assert read_table(spark, root, "t").count() == 8
