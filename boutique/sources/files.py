"""Readers for the original retail CSV files (customers, articles,
transactions) with fixed schemas, so no inference pass runs over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("FN", T.DoubleType()),
    T.StructField("Active", T.DoubleType()),
    T.StructField("club_member_status", T.StringType()),
    T.StructField("fashion_news_frequency", T.StringType()),
    T.StructField("age", T.DoubleType()),
    T.StructField("postal_code", T.StringType()),
])

ARTICLES_SCHEMA = T.StructType([
    T.StructField("article_id", T.LongType()),
    T.StructField("product_code", T.LongType()),
    T.StructField("prod_name", T.StringType()),
    T.StructField("product_type_no", T.IntegerType()),
    T.StructField("product_type_name", T.StringType()),
    T.StructField("product_group_name", T.StringType()),
    T.StructField("graphical_appearance_no", T.IntegerType()),
    T.StructField("graphical_appearance_name", T.StringType()),
    T.StructField("colour_group_code", T.IntegerType()),
    T.StructField("colour_group_name", T.StringType()),
    T.StructField("perceived_colour_value_id", T.IntegerType()),
    T.StructField("perceived_colour_value_name", T.StringType()),
    T.StructField("perceived_colour_master_id", T.IntegerType()),
    T.StructField("perceived_colour_master_name", T.StringType()),
    T.StructField("department_no", T.IntegerType()),
    T.StructField("department_name", T.StringType()),
    T.StructField("index_code", T.StringType()),
    T.StructField("index_name", T.StringType()),
    T.StructField("index_group_no", T.IntegerType()),
    T.StructField("index_group_name", T.StringType()),
    T.StructField("section_no", T.IntegerType()),
    T.StructField("section_name", T.StringType()),
    T.StructField("garment_group_no", T.IntegerType()),
    T.StructField("garment_group_name", T.StringType()),
    T.StructField("detail_desc", T.StringType()),
])

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("t_dat", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("article_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("sales_channel_id", T.IntegerType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             columns: list[str] | None = None) -> DataFrame:
    """Header CSV scan with a fixed schema (S1/S5); ``columns`` prunes.
    Ages are written as decimals in some exports, so they are read as
    doubles and cast to whole years. A malformed row fails the scan."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    if "age" in df.columns:
        df = df.withColumn("age", F.col("age").cast("bigint"))
    return df.select(*columns) if columns else df


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Transactions with ``t_dat`` parsed strictly as yyyy-MM-dd."""
    df = read_csv(spark, path, TRANSACTIONS_SCHEMA)
    return df.withColumn("t_dat", F.to_date("t_dat", "yyyy-MM-dd"))


def peek(df: DataFrame) -> DataFrame:
    """First-row peek (S6): the column list and one example row."""
    return df.limit(1)
