"""Readers for the driver's Parquet tables and the adapters that turn them
into the retail source tables (articles, customers, transactions).

The adapters are plain projections and one equi-join; Catalyst prunes the
scans to the columns each query uses and pushes date filters into the
orders scan.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


_SCOPE: dict | None = None
_KEPT: list[DataFrame] = []


def kept(df: DataFrame) -> DataFrame:
    """``df``, cached until the next query is built."""
    cached = df.cache()
    _KEPT.append(cached)
    return cached


def _release() -> None:
    while _KEPT:
        df = _KEPT.pop()
        if df.sparkSession.sparkContext._jsc is not None:  # its session still runs
            df.unpersist()


def once(key: tuple, build):
    """``build()``, computed once while one query is built; outside a scope,
    every time."""
    if _SCOPE is None:
        return build()
    if key not in _SCOPE:
        _SCOPE[key] = build()
    return _SCOPE[key]


@contextmanager
def read_scope():
    """Within one query's construction, read each table once: later reads of
    the same path reuse that reader (one file listing, identical scans that
    the planner can share). The scope ends with the query, so a later query
    sees new files; what the query cached is released when the next one
    begins."""
    global _SCOPE
    outer = _SCOPE
    if outer is None:
        _release()
        _SCOPE = {}
    try:
        yield
    finally:
        if outer is None:
            _SCOPE = None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (S1); callers select columns."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return once((id(spark), path), lambda: spark.read.parquet(path))


# File names of the original retail data; when a folder holds them, the
# adapters read them directly instead of deriving the tables.
ORIGINAL_FILES = {"articles": "articles.csv", "customers": "customers.csv",
                  "transactions": "transactions_train.csv"}

ARTICLE_COLUMNS = ["article_id", "product_code", "product_group_name", "product_type_no",
                   "graphical_appearance_no", "colour_group_code", "perceived_colour_master_id",
                   "department_no", "section_no", "garment_group_no", "index_group_no"]
CUSTOMER_COLUMNS = ["customer_id", "FN", "Active", "club_member_status",
                    "fashion_news_frequency", "age", "postal_code"]


def _original(spark: SparkSession, sf_dir: str, table: str) -> str | None:
    """Path of the original CSV for ``table`` in ``sf_dir``, if present."""
    path = f"{sf_dir.rstrip('/')}/{ORIGINAL_FILES[table]}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return path if fs.exists(p) else None


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article table with the surveyed schema: the original CSV when the
    folder has one, else derived from ``part``."""
    from boutique.sources import files
    csv = _original(spark, sf_dir, "articles")
    if csv:
        return files.read_csv(spark, csv, files.ARTICLES_SCHEMA, ARTICLE_COLUMNS)
    p = read_table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("article_id"),
        F.floor(F.col("p_partkey") / 10).cast("bigint").alias("product_code"),
        F.col("p_type").alias("product_group_name"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("product_type_no"),
        (size % 5).alias("graphical_appearance_no"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("colour_group_code"),
        (size % 7).alias("perceived_colour_master_id"),
        F.substring(F.col("p_brand"), 7, 1 << 20).cast("int").alias("department_no"),
        size.alias("section_no"),
        (size % 9).alias("garment_group_no"),
        (F.lit(1) + size % 6).alias("index_group_no"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer table with the surveyed schema: the original CSV when the
    folder has one, else derived from ``customer``."""
    from boutique.sources import files
    csv = _original(spark, sf_dir, "customers")
    if csv:
        return files.read_csv(spark, csv, files.CUSTOMERS_SCHEMA, CUSTOMER_COLUMNS)
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    news = F.col("c_nationkey") % 5
    return c.select(
        F.col("c_name").alias("customer_id"),
        F.when(key % 3 == 0, F.lit(1.0)).alias("FN"),
        F.when(key % 4 == 0, F.lit(1.0)).alias("Active"),
        F.when(seg == "FURNITURE", F.lit("PRE-CREATE"))
         .when(seg == "HOUSEHOLD", F.lit("LEFT CLUB"))
         .when(seg == "MACHINERY", F.lit(None).cast("string"))
         .otherwise(F.lit("ACTIVE")).alias("club_member_status"),
        F.when(news == 0, F.lit("NONE")).when(news == 1, F.lit("Regularly"))
         .when(news == 2, F.lit("Monthly")).when(news == 3, F.lit("None"))
         .alias("fashion_news_frequency"),
        F.when(key % 50 != 0, F.lit(16) + key * 7 % 86).alias("age"),
        F.col("c_nationkey").cast("string").alias("postal_code"),
    )


def _ntz(day: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{day} 00:00:00'")


def transactions(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    """Transaction lines (t_dat, customer_id, article_id, price,
    sales_channel_id) from ``lineitem`` joined to ``orders``.

    ``since`` keeps orders dated on or after that day; the predicate is on
    the raw order timestamp so it reaches the Parquet scan. A folder with
    the original transactions CSV is read directly (dates parsed strictly).
    """
    from boutique.sources import files
    csv = _original(spark, sf_dir, "transactions")
    if csv:
        tx = files.read_transactions_csv(spark, csv)
        return tx if since is None else tx.filter(F.col("t_dat") >= F.lit(since).cast("date"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if since is not None:
        o = o.filter(F.col("o_orderdate") >= _ntz(since))
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_linestatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_orderdate").cast("date").alias("t_dat"),
        F.concat(F.lit("Customer#"),
                 F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("customer_id"),
        F.col("l_partkey").alias("article_id"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(F.lit(2))
         .alias("sales_channel_id"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, embedding array<double>, label) — the given labelled points."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id",
                    F.transform("embedding", lambda x: x.cast("double")).alias("embedding"),
                    "label")


# SQL text of the same adapters, for DuckDB oracles (views ``part``,
# ``customer``, ``orders``, ``lineitem`` are registered by the checker).
ADAPTER_SQL = {
    "articles": """
SELECT p_partkey AS article_id,
       CAST(floor(p_partkey / 10) AS BIGINT) AS product_code,
       p_type AS product_group_name,
       split_part(p_name, ' ', 2) AS product_type_no,
       p_size % 5 AS graphical_appearance_no,
       split_part(p_name, ' ', 1) AS colour_group_code,
       p_size % 7 AS perceived_colour_master_id,
       CAST(substr(p_brand, 7) AS INT) AS department_no,
       p_size AS section_no,
       p_size % 9 AS garment_group_no,
       1 + p_size % 6 AS index_group_no
FROM part""",
    "customers": """
SELECT c_name AS customer_id,
       CASE WHEN c_custkey % 3 = 0 THEN CAST(1 AS DOUBLE) END AS FN,
       CASE WHEN c_custkey % 4 = 0 THEN CAST(1 AS DOUBLE) END AS Active,
       CASE c_mktsegment WHEN 'FURNITURE' THEN 'PRE-CREATE'
            WHEN 'HOUSEHOLD' THEN 'LEFT CLUB'
            WHEN 'MACHINERY' THEN NULL ELSE 'ACTIVE' END AS club_member_status,
       CASE c_nationkey % 5 WHEN 0 THEN 'NONE' WHEN 1 THEN 'Regularly'
            WHEN 2 THEN 'Monthly' WHEN 3 THEN 'None' END AS fashion_news_frequency,
       CASE WHEN c_custkey % 50 <> 0 THEN 16 + c_custkey * 7 % 86 END AS age,
       CAST(c_nationkey AS VARCHAR) AS postal_code
FROM customer""",
    "transactions": """
SELECT CAST(o_orderdate AS DATE) AS t_dat,
       concat('Customer#', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS customer_id,
       l_partkey AS article_id,
       l_extendedprice AS price,
       CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS sales_channel_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}
