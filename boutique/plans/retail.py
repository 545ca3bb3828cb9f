"""Named building blocks of the pipeline over the driver's tables.

Each function returns a lazy DataFrame; composing them gives one Catalyst
plan per query, so common scans are pruned and filters pushed per query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutique import params
from boutique import sources as src
from boutique.operators import customers as cust
from boutique.operators import encode, lifespan, prefs, score
from boutique.sources.tables import kept, once


def arts(spark: SparkSession, d: str) -> DataFrame:
    """Articles with the product-group merge applied."""
    return cust.merge_product_groups(src.articles(spark, d), params.ITEMS_GROUPS)


def dictionary(spark: SparkSession, d: str) -> DataFrame:
    """The article feature dictionary; its size is the number of distinct
    attribute values. A query computes it once, however many operators use it."""
    return once((id(spark), d, "dictionary"), lambda: kept(encode.feature_dictionary(
        arts(spark, d), params.ARTICLE_ATTRIBUTES)))


def kept_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Kept dictionary entries, size-checked once for broadcasting."""
    return once((id(spark), d, "kept"), lambda: encode.checked_kept(dictionary(spark, d)))


def art_long(spark: SparkSession, d: str) -> DataFrame:
    return encode.onehot_long(arts(spark, d), "article_id", params.ARTICLE_ATTRIBUTES,
                              dictionary(spark, d), checked=kept_dictionary(spark, d))


def feature_width(spark: SparkSession, d: str) -> int:
    """Number of kept features (the preference width)."""
    def count() -> int:
        row = encode.kept_features(dictionary(spark, d)).agg(F.max("feature_idx").alias("m")).first()
        return int(row["m"]) + 1 if row["m"] is not None else 0
    return once((id(spark), d, "width"), count)


def recent(spark: SparkSession, d: str) -> DataFrame:
    """Every transaction line counts towards shares and preferences."""
    return src.transactions(spark, d)


def lifespans(spark: SparkSession, d: str) -> DataFrame:
    return lifespan.lifespan(src.transactions(spark, d))


def info(spark: SparkSession, d: str) -> DataFrame:
    return cust.customer_info(src.customers(spark, d), recent(spark, d), src.articles(spark, d))


def segments(spark: SparkSession, d: str) -> DataFrame:
    return cust.customer_segments(info(spark, d))


def counts(spark: SparkSession, d: str) -> DataFrame:
    return prefs.pref_counts(cust.purchases(recent(spark, d)), art_long(spark, d))


def shares(spark: SparkSession, d: str) -> DataFrame:
    return prefs.pref_shares(counts(spark, d))


def purchases(spark: SparkSession, d: str) -> DataFrame:
    """(customer_id, article_id, n, n_train, n_test, First_Date, Last_Date): one
    aggregate of the transactions, from which a query with several uses of
    them takes counts, both sides of the test cutoff and lifespans."""
    return once((id(spark), d, "purchases"), lambda: kept(purchase_totals(spark, d)))


def purchase_totals(spark: SparkSession, d: str) -> DataFrame:
    """The rows of :func:`purchases`, not kept."""
    test = F.col("t_dat") >= F.lit(params.TEST_CUTOFF).cast("date")
    return recent(spark, d).groupBy("customer_id", "article_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(test, F.lit(True))).alias("n_train"),
        F.count_if(test).alias("n_test"), F.min("t_dat").alias("First_Date"), F.max("t_dat").alias("Last_Date"))


def purchased_shares(spark: SparkSession, d: str) -> DataFrame:
    """Preference shares from :func:`purchases`, kept for the query."""
    return once((id(spark), d, "purchased shares"), lambda: kept(prefs.pref_shares(prefs.pref_counts(
        purchases(spark, d).select("customer_id", "article_id", "n"), art_long(spark, d)))))


def purchased_vectors(spark: SparkSession, d: str) -> DataFrame:
    """(customer_id, prefs): the same shares as vectors, checkpointed once for the query."""
    return once((id(spark), d, "purchased vectors"), lambda: prefs.share_vectors(
        purchases(spark, d).select("customer_id", "article_id", "n"), art_long(spark, d),
        feature_width(spark, d)).checkpoint(eager=True))


def purchased_info(spark: SparkSession, d: str) -> DataFrame:
    """The customer feature table from :func:`purchases`, kept for the query."""
    return once((id(spark), d, "purchased info"), lambda: kept(cust.info_of_purchases(
        src.customers(spark, d), purchases(spark, d).select("customer_id", "article_id", "n"), src.articles(spark, d))))


def live_slots(spark: SparkSession, d: str) -> DataFrame:
    """Feature slots of the live articles, from :func:`purchases`."""
    def build():
        ends = purchases(spark, d).groupBy("article_id").agg(F.max("Last_Date").alias("Last_Date"))
        ids = lifespan.last_sale_between(ends, first_cutoff=params.LIVE_CUTOFF)
        return kept(score.article_slots(ids, art_long(spark, d)))
    return once((id(spark), d, "live slots"), build)


def live(spark: SparkSession, d: str) -> DataFrame:
    """Live article ids: last sale on/after the live cutoff."""
    return lifespan.last_sale_between(lifespans(spark, d),
                                      first_cutoff=params.LIVE_CUTOFF).select("article_id")
