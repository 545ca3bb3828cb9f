"""The adapters read the original retail CSV layout when a folder has it;
queries then give the same answers as on the derived tables."""

import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from boutique import sources
from boutique.sources.files import ARTICLES_SCHEMA, CUSTOMERS_SCHEMA
from conftest import SF001


def _write_csv(df, path):
    df.coalesce(1).write.option("header", True).csv(path)


def test_queries_on_original_csv_layout(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    arts = sources.articles(spark, SF001)
    # Text-coded attributes become order-preserving integer codes, as in
    # the original files, so feature order (and feature_idx) is unchanged.
    for c in ["product_type_no", "colour_group_code"]:
        arts = arts.withColumn(c, F.dense_rank().over(Window.orderBy(c)))
    arts_full = arts.select(*[F.col(f.name).cast(f.dataType) if f.name in arts.columns
                              else F.lit(None).cast(f.dataType).alias(f.name)
                              for f in ARTICLES_SCHEMA.fields])
    _write_csv(arts_full, f"{root}/articles.csv")
    cx = sources.customers(spark, SF001)
    _write_csv(cx.select(*[f.name for f in CUSTOMERS_SCHEMA.fields]), f"{root}/customers.csv")
    tx = sources.transactions(spark, SF001)
    _write_csv(tx.select(F.date_format("t_dat", "yyyy-MM-dd").alias("t_dat"), "customer_id",
                         "article_id", "price", "sales_channel_id"), f"{root}/transactions_train.csv")
    qs = entry.queries()
    for name in ["article_lifespan", "customer_info", "segment_counts", "pref_counts",
                 "unsold_articles"]:
        a = sorted(map(tuple, qs[name](spark, root).collect()))
        b_df = qs[name](spark, SF001)
        if name == "unsold_articles":
            b_df = b_df.select("article_id")
            a = sorted(map(tuple, qs[name](spark, root).select("article_id").collect()))
        b = sorted(map(tuple, b_df.collect()))
        assert a == b, name
