"""DuckDB text of the pipeline's building blocks, used only as the
independent oracle for the Spark queries. Every oracle query is
``base_ctes() + body``; DuckDB evaluates only the CTEs a body references.
"""

from __future__ import annotations

from boutique import params
from boutique.sources.tables import ADAPTER_SQL

# Attributes of the adapted article table that are numbers (sorted as
# numbers in the one-hot dictionary); the others are text.
NUMERIC_ARTICLE_ATTRIBUTES = {"graphical_appearance_no", "perceived_colour_master_id",
                              "department_no", "section_no", "garment_group_no"}


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _attr_long() -> str:
    parts = []
    for i, a in enumerate(params.ARTICLE_ATTRIBUTES):
        num = f"CAST({a} AS DOUBLE)" if a in NUMERIC_ARTICLE_ATTRIBUTES else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT article_id, '{a}' AS attribute, {i} AS attr_pos, "
                     f"CAST({a} AS VARCHAR) AS value, {num} AS value_num FROM arts")
    return "\nUNION ALL ".join(parts)


def _flag(groups, section) -> str:
    return (f"CAST(coalesce(index_group_no IN ({_sql_list(groups)}) OR section_no = {section}, "
            f"false) AS INTEGER)")


def base_ctes() -> str:
    p = params
    ctes = [f"{name} AS ({sql}\n)" for name, sql in ADAPTER_SQL.items()]
    ctes += [
        "embeds AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings)",
        f"""arts AS (SELECT * REPLACE (CASE WHEN product_group_name IN ({_sql_list(p.ITEMS_GROUPS)})
            THEN '{p.ITEMS_LABEL}' ELSE product_group_name END AS product_group_name) FROM articles)""",
        f"attr_long AS ({_attr_long()})",
        """dict_all AS (SELECT attribute, attr_pos, value, value_num,
            row_number() OVER (PARTITION BY attribute ORDER BY value_num NULLS FIRST, value) AS value_rank
            FROM (SELECT DISTINCT attribute, attr_pos, value, value_num FROM attr_long WHERE value IS NOT NULL))""",
        """dict_kept AS (SELECT attribute, value,
            CAST(row_number() OVER (ORDER BY attr_pos, value_rank) - 1 AS BIGINT) AS feature_idx
            FROM dict_all WHERE value_rank > 1)""",
        """dictionary AS (SELECT a.attribute, a.attr_pos, a.value, a.value_rank,
            a.attribute || '_' || a.value AS feature, k.feature_idx
            FROM dict_all a LEFT JOIN dict_kept k ON a.attribute = k.attribute AND a.value = k.value)""",
        """art_long AS (SELECT l.article_id, d.feature_idx, d.feature FROM attr_long l
            JOIN dictionary d ON l.attribute = d.attribute AND l.value = d.value
            WHERE d.feature_idx IS NOT NULL)""",
        f"""cx_clean AS (SELECT customer_id, coalesce(FN, 0) AS FN, club_member_status,
            coalesce(replace(replace(fashion_news_frequency, 'None', 'NONE'), 'Monthly', 'Regularly'),
                     '{p.NEWS_NULL_FILL}') AS fashion_news_frequency,
            coalesce(age - {p.AGE_SHIFT}, 0) AS age FROM customers)""",
        """cx_onehot AS (SELECT customer_id, FN, age,
            CASE WHEN fashion_news_frequency = 'Regularly' THEN 1 ELSE 0 END AS "fashion_news_frequency_Regularly",
            CASE WHEN club_member_status = 'LEFT CLUB' THEN 1 ELSE 0 END AS "club_member_status_LEFT CLUB",
            CASE WHEN club_member_status = 'PRE-CREATE' THEN 1 ELSE 0 END AS "club_member_status_PRE-CREATE"
            FROM cx_clean)""",
        f"""flags AS (SELECT article_id,
            {_flag(p.FEMALE_INDEX_GROUPS, p.FEMALE_SECTION)} AS female,
            {_flag(p.MALE_INDEX_GROUPS, p.MALE_SECTION)} AS male,
            {_flag(p.CHILDREN_INDEX_GROUPS, p.CHILDREN_SECTION)} AS children FROM articles)""",
        """purch AS (SELECT customer_id, article_id, count(*) AS n FROM transactions GROUP BY 1, 2)""",
        """gsum AS (SELECT p.customer_id,
            CAST(coalesce(sum(f.female * p.n), 0) AS BIGINT) AS female,
            CAST(coalesce(sum(f.male * p.n), 0) AS BIGINT) AS male,
            CAST(coalesce(sum(f.children * p.n), 0) AS BIGINT) AS children
            FROM purch p LEFT JOIN flags f ON p.article_id = f.article_id GROUP BY p.customer_id)""",
        """gshare AS (SELECT customer_id,
            coalesce(CAST(female AS DOUBLE) / nullif(female + male + children, 0), 0.0) AS female,
            coalesce(CAST(male AS DOUBLE) / nullif(female + male + children, 0), 0.0) AS male,
            coalesce(CAST(children AS DOUBLE) / nullif(female + male + children, 0), 0.0) AS children
            FROM gsum)""",
        """cx_info AS (SELECT o.*, coalesce(g.female, 0.0) AS female, coalesce(g.male, 0.0) AS male,
            coalesce(g.children, 0.0) AS children
            FROM cx_onehot o LEFT JOIN gshare g ON o.customer_id = g.customer_id)""",
        f"""segs AS (SELECT customer_id, CASE
            WHEN male > {p.SEGMENT_THRESHOLD} THEN 'male'
            WHEN male < {p.SEGMENT_THRESHOLD} AND female > {p.SEGMENT_THRESHOLD} THEN 'female'
            WHEN male < {p.SEGMENT_THRESHOLD} AND female < {p.SEGMENT_THRESHOLD} THEN 'family'
            ELSE 'boundary' END AS segment FROM cx_info)""",
        """pcounts AS (SELECT p.customer_id, a.feature_idx, CAST(sum(p.n) AS BIGINT) AS n
            FROM purch p JOIN art_long a ON p.article_id = a.article_id GROUP BY 1, 2)""",
        """pshares AS (SELECT customer_id, feature_idx, n, total,
            coalesce(CAST(n AS DOUBLE) / nullif(total, 0), 0.0) AS share
            FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY customer_id) AS BIGINT) AS total FROM pcounts))""",
        """lifespans AS (SELECT article_id, min(t_dat) AS First_Date, max(t_dat) AS Last_Date,
            CAST(date_diff('day', min(t_dat), max(t_dat)) AS BIGINT) AS duration
            FROM transactions GROUP BY article_id)""",
        f"""live AS (SELECT article_id FROM lifespans WHERE Last_Date >= DATE '{p.LIVE_CUTOFF}')""",
    ]
    return "WITH " + ",\n".join(ctes) + "\n"


def q(body: str) -> str:
    return base_ctes() + body
