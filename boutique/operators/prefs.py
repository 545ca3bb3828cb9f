"""Preference vectors in long form.

pref(customer, feature) = number of purchased article lines carrying that
one-hot feature; share = pref / customer's total over features. The plan
counts (customer, article) first, joins the ≤8 features per article as one
list, shuffles these rows by customer, and only then sums per (customer,
feature): the fact table is never shuffled 8× as wide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boutique import params
from boutique.functions import clean
from boutique.operators import encode
from boutique.operators.customers import purchases


def pref_counts(purch: DataFrame, art_long: DataFrame) -> DataFrame:
    """(customer_id, feature_idx, n) (A4). Purchases of articles without
    features contribute nothing (nulls count as 0, D18). The explicit partition
    count keeps the summing spread over tasks, as rows are few before it and
    eight times as many in it."""
    parts = int(purch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = art_long.groupBy("article_id").agg(F.collect_list("feature_idx").alias("_f"))
    j = (purch.select("customer_id", "article_id", "n").join(lists, "article_id", "inner").select("customer_id", "n", "_f")
         .repartition(parts, "customer_id").select("customer_id", "n", F.explode("_f").alias("feature_idx")))
    return j.groupBy("customer_id", "feature_idx").agg(F.sum("n").cast("bigint").alias("n"))


def pref_shares(counts: DataFrame) -> DataFrame:
    """Add ``total`` (over the customer's features only, D9) and
    ``share = n / total`` (A6, A7). The window's partition is one customer's
    features, so its size is bounded by the dictionary, not the data."""
    w = Window.partitionBy("customer_id")
    with_total = counts.withColumn("total", F.sum("n").over(w).cast("bigint"))
    return with_total.withColumn("share", clean.share("n", "total"))


def pref_int(shares: DataFrame, factor: int = params.INT_SCALE) -> DataFrame:
    """Shares × factor truncated to int."""
    return shares.select("customer_id", "feature_idx",
                         clean.scale_trunc("share", factor).alias("share_int"))


def article_pref_counts(art_long: DataFrame) -> DataFrame:
    """Per-article feature sums (A5) — one row per (article, feature)."""
    return art_long.groupBy("article_id", "feature_idx").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def preference_rows(tx: DataFrame, info: DataFrame, art_long: DataFrame,
                    article_cols: DataFrame) -> DataFrame:
    """Transaction lines with customer features and article one-hots (J3,
    J4), in long form: one row per (line, feature). Channel one-hot E3 is
    ``sales_channel_id_2``."""
    lines = tx.select("customer_id", "article_id",
                      (F.col("sales_channel_id") == 2).cast("int").alias("sales_channel_id_2"))
    j = lines.join(info, "customer_id", "left")
    j = j.join(article_cols.select("article_id", "product_code"), "article_id", "left")
    return j.join(art_long.select("article_id", "feature_idx"), "article_id", "left")


def segment_prefs(segments: DataFrame, shares: DataFrame,
                  keep: tuple[str, ...] = ("male", "female", "family")) -> DataFrame:
    """Segment members with their preference shares (J5): one join carrying
    the segment label instead of three files."""
    seg = segments.filter(F.col("segment").isin(list(keep)))
    return seg.join(shares.select("customer_id", "feature_idx", "share"), "customer_id", "left")


def purchase_matrix(tx: DataFrame, codes: DataFrame) -> DataFrame:
    """(customer_code, article_id, n): purchase counts with customers mapped
    through the code dictionary (J14, A8, J8)."""
    return coded_purchases(purchases(tx), codes)


def coded_purchases(purch: DataFrame, codes: DataFrame) -> DataFrame:
    """The same from purchase counts (customer_id, article_id, n)."""
    coded = encode.lookup(purch.select("customer_id", "article_id", "n"), "customer_id", codes, "customer_id", "code", "customer_code")
    return coded.select("customer_code", "article_id", "n")


def test_set(tx: DataFrame, info: DataFrame) -> DataFrame:
    """Purchase counts joined with customer features."""
    return purchases(tx).join(info, "customer_id", "inner")


def pref_vectors(shares: DataFrame, width: int, value_col: str = "share") -> DataFrame:
    """(customer_id, prefs array<double>[width]) — a dense vector per
    customer built from its ≤ width long rows; used by clustering and
    scoring. The group per customer is bounded by the dictionary size; the
    explicit partition count keeps CPU-bound consumers (k-means, scoring)
    spread over tasks."""
    n = int(shares.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = shares.repartition(n, "customer_id").groupBy("customer_id").agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.col("feature_idx").cast("int"), F.col(value_col).cast("double")))).alias("_m"))
    vec = F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                      lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0.0)))
    return grouped.select("customer_id", vec.alias("prefs"))


#: Numbers of the count matrix of one slice of rows in :func:`share_vectors`.
SLICE_NUMBERS = 1 << 22


def share_vectors(purch: DataFrame, art_long: DataFrame, width: int) -> DataFrame:
    """(customer_id, prefs array<double>[width]): the vectors of :func:`pref_vectors` over
    the shares of :func:`pref_counts`, straight from the purchases. Rows are shuffled by
    customer and sorted there; a task adds up one customer after the other as the rows
    pass by, so neither (customer, feature) rows nor a whole customer are held."""
    parts = int(purch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = art_long.groupBy("article_id").agg(F.collect_list(F.col("feature_idx").cast("int")).alias("_f"))
    rows = (purch.select("customer_id", "article_id", "n").join(lists, "article_id", "inner")
            .select("customer_id", "n", "_f").withColumn("_h", F.xxhash64("customer_id"))
            .repartition(parts, "customer_id").sortWithinPartitions("_h", "customer_id"))
    step = max(1, SLICE_NUMBERS // max(width, 1))

    def done(keys, counts):
        total = counts.sum(axis=1, keepdims=True)
        share = np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)
        ends = pa.array(np.arange(len(share) + 1) * width, pa.int32())
        return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(ends, pa.array(share.reshape(-1)))],
                                          names=["customer_id", "prefs"])

    def run(batches):
        held = None  # (key, counts) of the customer whose rows may go on
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                keys = part.column("customer_id")
                code = keys.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                lists = part.column("_f")
                long = lists.value_lengths().to_numpy(zero_copy_only=False)
                group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(code))))
                cell = np.repeat(group, long) * width + lists.flatten().to_numpy()
                n = part.column("n").to_numpy(zero_copy_only=False).astype(float)
                counts = np.bincount(cell, np.repeat(n, long), len(first) * width).reshape(-1, width)
                keys = keys.take(pa.array(first))
                if held is not None:
                    if keys.slice(0, 1).equals(held[0]):
                        counts[0] += held[1][0]
                    else:
                        yield done(*held)
                if len(counts) > 1:
                    yield done(keys.slice(0, len(keys) - 1), counts[:-1])
                held = pa.concat_arrays([keys.slice(len(keys) - 1)]), counts[-1:].copy()
        if held is not None:
            yield done(*held)

    return rows.select("customer_id", "n", "_f").mapInArrow(
        run, f"customer_id {dict(purch.dtypes)['customer_id']}, prefs array<double>")
