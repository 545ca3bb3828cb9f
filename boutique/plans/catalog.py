"""Registry of the engine's queries: one Spark callable per operator of the
inventory, and where the answer is SQL-expressible, the DuckDB oracle text.

Every query reads the driver's tables (or data Spark derives from them)
over whole tables; none samples or caps rows unless sampling or top-k is the
operator itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutique import params
from boutique import sources as src
from boutique.operators import customers as cust
from boutique.operators import encode, lifespan, prefs
from boutique.plans import retail as R
from boutique.plans.oracle import q

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


P = params
ART_COLS = ("article_id, product_code, product_group_name, product_type_no, graphical_appearance_no, "
            "colour_group_code, perceived_colour_master_id, department_no, section_no, "
            "garment_group_no, index_group_no")

# ---------------------------------------------------------------- step 1: lifespans


@register("article_lifespan", q("SELECT * FROM lifespans"))
def article_lifespan(spark, d):
    return lifespan.lifespan(src.transactions(spark, d), "article_id")


@register("lifespan_by_customer", q("""
SELECT customer_id, min(t_dat) AS First_Date, max(t_dat) AS Last_Date,
       CAST(date_diff('day', min(t_dat), max(t_dat)) AS BIGINT) AS duration
FROM transactions GROUP BY customer_id"""))
def lifespan_by_customer(spark, d):
    return lifespan.lifespan(src.transactions(spark, d), "customer_id")


@register("live_articles", q(f"""
SELECT a.*, l.First_Date, l.Last_Date, l.duration
FROM articles a JOIN lifespans l ON a.article_id = l.article_id
WHERE l.Last_Date >= DATE '{P.LIVE_CUTOFF}'"""))
def live_articles(spark, d):
    return lifespan.live_articles(src.articles(spark, d), R.lifespans(spark, d), P.LIVE_CUTOFF)


def _articles_by_last_sale(spark, d, first_cutoff, last_cutoff):
    """One-hot rows of articles whose last sale falls in a half-open range
    (F7, J7): vocabulary from all articles (D23); an article without kept
    features keeps one row with null feature."""
    full = lifespan.with_lifespans(R.arts(spark, d).select("article_id"), R.lifespans(spark, d))
    picked = lifespan.last_sale_between(full, first_cutoff, last_cutoff).select("article_id")
    return picked.join(R.art_long(spark, d), "article_id", "left")


def _by_last_sale_sql(cond: str) -> str:
    return q(f"""
SELECT s.article_id, l.feature_idx, l.feature
FROM (SELECT article_id FROM lifespans WHERE {cond}) s
LEFT JOIN art_long l ON s.article_id = l.article_id""")


@register("articles_before", _by_last_sale_sql(f"Last_Date < DATE '{P.SPLIT_CUTOFF}'"))
def articles_before(spark, d):
    return _articles_by_last_sale(spark, d, None, P.SPLIT_CUTOFF)


@register("articles_from", _by_last_sale_sql(f"Last_Date >= DATE '{P.SPLIT_CUTOFF}'"))
def articles_from(spark, d):
    return _articles_by_last_sale(spark, d, P.SPLIT_CUTOFF, None)


@register("test_articles", _by_last_sale_sql(f"Last_Date >= DATE '{P.TEST_CUTOFF}'"))
def test_articles(spark, d):
    return _articles_by_last_sale(spark, d, P.TEST_CUTOFF, None)


@register("unsold_articles", q("""
SELECT a.* FROM articles a
WHERE NOT EXISTS (SELECT 1 FROM transactions t WHERE t.article_id = a.article_id)"""))
def unsold_articles(spark, d):
    return lifespan.unsold_articles(src.articles(spark, d), R.recent(spark, d))


@register("articles_lifespan_full", q("""
SELECT coalesce(a.article_id, l.article_id) AS article_id, a.product_code, a.product_group_name,
       a.product_type_no, a.graphical_appearance_no, a.colour_group_code,
       a.perceived_colour_master_id, a.department_no, a.section_no, a.garment_group_no,
       a.index_group_no, l.First_Date, l.Last_Date, l.duration
FROM articles a FULL OUTER JOIN
     (SELECT article_id, min(t_dat) AS First_Date, max(t_dat) AS Last_Date,
             CAST(date_diff('day', min(t_dat), max(t_dat)) AS BIGINT) AS duration
      FROM transactions GROUP BY article_id) l
ON a.article_id = l.article_id"""))
def articles_lifespan_full(spark, d):
    # Lifespans over the whole history, so unsold articles give null dates.
    return lifespan.with_lifespans(src.articles(spark, d), lifespan.lifespan(R.recent(spark, d)))


@register("date_bounds", q("""
SELECT max(First_Date) AS max_first_date, min(First_Date) AS min_first_date,
       max(Last_Date) AS max_last_date FROM lifespans"""))
def date_bounds(spark, d):
    return lifespan.date_bounds(R.lifespans(spark, d))


@register("distinct_article_counts", q("""
SELECT 'transactions' AS source,
       CAST(count(DISTINCT article_id) + max(CASE WHEN article_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n
FROM transactions
UNION ALL
SELECT 'articles', CAST(count(DISTINCT article_id) + max(CASE WHEN article_id IS NULL THEN 1 ELSE 0 END) AS BIGINT)
FROM articles"""))
def distinct_article_counts(spark, d):
    t = lifespan.distinct_count_with_null(src.transactions(spark, d), "article_id")
    a = lifespan.distinct_count_with_null(src.articles(spark, d), "article_id")
    return (t.select(F.lit("transactions").alias("source"), "n")
            .unionByName(a.select(F.lit("articles").alias("source"), "n")))


# ---------------------------------------------------------------- step 2: encoding


@register("customer_clean", q("SELECT * FROM cx_clean"))
def customer_clean(spark, d):
    return cust.clean_customers(src.customers(spark, d))


@register("customer_onehot", q("SELECT * FROM cx_onehot"))
def customer_onehot(spark, d):
    return cust.customer_onehot(cust.clean_customers(src.customers(spark, d)))


@register("channel_onehot", q("""
SELECT customer_id, article_id, CASE WHEN sales_channel_id = 2 THEN 1 ELSE 0 END AS sales_channel_id_2
FROM transactions"""))
def channel_onehot(spark, d):
    tx = src.transactions(spark, d).select("customer_id", "article_id", "sales_channel_id")
    return encode.onehot_columns(tx, ["sales_channel_id"])


@register("items_merge", q("SELECT article_id, product_group_name FROM arts"))
def items_merge(spark, d):
    return R.arts(spark, d).select("article_id", "product_group_name")


@register("feature_dictionary", q("SELECT * FROM dictionary"))
def feature_dictionary(spark, d):
    return R.dictionary(spark, d)


@register("article_onehot_long", q("SELECT * FROM art_long"))
def article_onehot_long(spark, d):
    return R.art_long(spark, d)


def _wide_sql(table: str, key: str, index: str, value: str) -> str:
    return q(f"""
SELECT {key}, list({index} ORDER BY {index}) AS idx, list({value} ORDER BY {index}) AS val
FROM {table} GROUP BY {key}""")


@register("article_onehot_wide", _wide_sql("art_long", "article_id", "feature_idx", "1"))
def article_onehot_wide(spark, d):
    long = R.art_long(spark, d).withColumn("one", F.lit(1))
    return encode.wide_from_long(long, "article_id", "feature_idx", "one")


@register("customer_codes", q("""
SELECT customer_id, CAST(row_number() OVER (ORDER BY customer_id) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT customer_id FROM customers)"""))
def customer_codes(spark, d):
    return encode.dense_codes(src.customers(spark, d), ["customer_id"], "code")


@register("article_labels", q(f"""
SELECT article_id, CAST(row_number() OVER (ORDER BY article_id) - 1 AS BIGINT) AS label
FROM (SELECT DISTINCT article_id FROM lifespans WHERE Last_Date >= DATE '{P.TEST_CUTOFF}')"""))
def article_labels(spark, d):
    test = lifespan.last_sale_between(R.lifespans(spark, d), first_cutoff=P.TEST_CUTOFF)
    return encode.dense_codes(test, ["article_id"], "label")


# ---------------------------------------------------------------- step 3: segments


@register("gender_flags", q("SELECT * FROM flags"))
def gender_flags(spark, d):
    return cust.article_flags(src.articles(spark, d))


@register("gender_shares", q("SELECT * FROM gshare"))
def gender_shares(spark, d):
    return cust.gender_shares(cust.gender_sums(cust.purchases(R.recent(spark, d)),
                                               cust.article_flags(src.articles(spark, d))))


@register("customer_info", q("SELECT * FROM cx_info"))
def customer_info(spark, d):
    return R.info(spark, d)


@register("customer_segments", q("SELECT * FROM segs"))
def customer_segments(spark, d):
    return R.segments(spark, d)


@register("segment_counts", q("SELECT segment, count(*) AS n FROM segs GROUP BY segment"))
def segment_counts(spark, d):
    return R.segments(spark, d).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@register("section_exclude", q(f"""
SELECT * FROM articles WHERE NOT coalesce(section_no IN ({", ".join(map(str, P.MALE_SECTIONS))}), false)"""))
def section_exclude(spark, d):
    return cust.section_filter(src.articles(spark, d), P.MALE_SECTIONS, exclude=True)


@register("section_keep", q(f"""
SELECT * FROM articles WHERE coalesce(section_no IN ({", ".join(map(str, P.FEMALE_SECTIONS))}), false)"""))
def section_keep(spark, d):
    return cust.section_filter(src.articles(spark, d), P.FEMALE_SECTIONS, exclude=False)


# ---------------------------------------------------------------- step 4: preferences


@register("preference_rows", q("""
SELECT t.article_id, t.customer_id,
       CASE WHEN t.sales_channel_id = 2 THEN 1 ELSE 0 END AS sales_channel_id_2,
       i.FN, i.age, i."fashion_news_frequency_Regularly", i."club_member_status_LEFT CLUB",
       i."club_member_status_PRE-CREATE", i.female, i.male, i.children,
       a.product_code, l.feature_idx
FROM transactions t
LEFT JOIN cx_info i ON t.customer_id = i.customer_id
LEFT JOIN articles a ON t.article_id = a.article_id
LEFT JOIN art_long l ON t.article_id = l.article_id"""))
def preference_rows(spark, d):
    return prefs.preference_rows(R.recent(spark, d), R.info(spark, d), R.art_long(spark, d),
                                 src.articles(spark, d))


@register("pref_counts", q("SELECT * FROM pcounts"))
def pref_counts(spark, d):
    return R.counts(spark, d)


@register("pref_shares", q("SELECT * FROM pshares"))
def pref_shares(spark, d):
    return R.shares(spark, d)


@register("pref_int", q(f"""
SELECT customer_id, feature_idx, CAST(trunc(share * {P.INT_SCALE}) AS INTEGER) AS share_int FROM pshares"""))
def pref_int(spark, d):
    return prefs.pref_int(R.shares(spark, d))


@register("pref_wide", _wide_sql("pshares", "customer_id", "feature_idx", "share"))
def pref_wide(spark, d):
    return encode.wide_from_long(R.shares(spark, d), "customer_id", "feature_idx", "share")


@register("article_pref_counts", q("""
SELECT article_id, feature_idx, count(*) AS n FROM art_long GROUP BY 1, 2"""))
def article_pref_counts(spark, d):
    return prefs.article_pref_counts(R.art_long(spark, d))


@register("segment_prefs", q("""
SELECT g.customer_id, g.segment, s.feature_idx, s.share
FROM (SELECT * FROM segs WHERE segment IN ('male', 'female', 'family')) g
LEFT JOIN pshares s ON g.customer_id = s.customer_id"""))
def segment_prefs(spark, d):
    return prefs.segment_prefs(R.segments(spark, d), R.shares(spark, d))


@register("purchase_matrix_long", q("""
SELECT c.code AS customer_code, p.article_id, p.n
FROM (SELECT customer_id, article_id, count(*) AS n FROM transactions GROUP BY 1, 2) p
LEFT JOIN (SELECT customer_id, CAST(row_number() OVER (ORDER BY customer_id) - 1 AS BIGINT) AS code
           FROM (SELECT DISTINCT customer_id FROM customers)) c
ON p.customer_id = c.customer_id"""))
def purchase_matrix_long(spark, d):
    codes = encode.dense_codes(src.customers(spark, d), ["customer_id"], "code")
    return prefs.purchase_matrix(src.transactions(spark, d), codes)


@register("test_set", q("""
SELECT p.customer_id, p.article_id, p.n, i.* EXCLUDE (customer_id)
FROM (SELECT customer_id, article_id, count(*) AS n FROM transactions GROUP BY 1, 2) p
JOIN cx_info i ON p.customer_id = i.customer_id"""))
def test_set(spark, d):
    return prefs.test_set(src.transactions(spark, d), R.info(spark, d))


def queries() -> dict[str, QueryFn]:
    # Later steps register on import.
    from boutique.plans import catalog_io, catalog_models  # noqa: F401
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from boutique.plans import catalog_io, catalog_models  # noqa: F401
    return dict(ORACLE)
