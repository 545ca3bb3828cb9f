"""Article lifespans and date-based article subsets (A2, A3, A9, A10,
F6-F8, J6, J7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutique.functions.clean import days_between, parse_date_lenient


def lifespan(tx: DataFrame, by: str | list[str] = "article_id",
             date_col: str = "t_dat") -> DataFrame:
    """First / last sale date and duration in days per key (A2, A3).

    Plain ``min``/``max`` (decision D3): partial aggregation runs before the
    shuffle, so a key holding a third of all rows costs no more than any
    other after the map side.
    """
    keys = [by] if isinstance(by, str) else list(by)
    out = tx.groupBy(*keys).agg(F.min(date_col).alias("First_Date"),
                                F.max(date_col).alias("Last_Date"))
    return out.withColumn("duration", days_between("Last_Date", "First_Date"))


def lifespan_of_purchases(purch: DataFrame, by: str = "article_id") -> DataFrame:
    """The same from purchases that carry their own First_Date and Last_Date."""
    out = purch.groupBy(by).agg(F.min("First_Date").alias("First_Date"), F.max("Last_Date").alias("Last_Date"))
    return out.withColumn("duration", days_between("Last_Date", "First_Date"))


def last_sale_between(df: DataFrame, first_cutoff: str | None = None,
                      last_cutoff: str | None = None, col: str = "Last_Date") -> DataFrame:
    """Half-open range on the last sale date, each bound optional.

    A null date is dropped once any bound is set, kept otherwise. Dates read
    back as text are parsed leniently (X7)."""
    date = parse_date_lenient(col) if dict(df.dtypes)[col] == "string" else F.col(col)
    if first_cutoff is not None:
        df = df.filter(date >= F.lit(first_cutoff).cast("date"))
    if last_cutoff is not None:
        df = df.filter(date < F.lit(last_cutoff).cast("date"))
    return df


def live_articles(articles: DataFrame, lifespans: DataFrame, cutoff: str) -> DataFrame:
    """Articles still selling on/after ``cutoff``, with their dates."""
    live = last_sale_between(lifespans, first_cutoff=cutoff)
    return articles.join(live, "article_id", "inner")


def unsold_articles(articles: DataFrame, tx: DataFrame) -> DataFrame:
    """Articles with no transaction (F8/J15): an anti join, which — unlike
    SQL ``NOT IN`` — is not emptied by a null id on the other side."""
    return articles.join(tx.select("article_id").distinct(), "article_id", "left_anti")


def with_lifespans(articles: DataFrame, lifespans: DataFrame) -> DataFrame:
    """Full outer join of articles and lifespans on the id."""
    return articles.join(lifespans, "article_id", "full")


def date_bounds(lifespans: DataFrame) -> DataFrame:
    """Global bounds of the lifespan dates (A10)."""
    return lifespans.agg(F.max("First_Date").alias("max_first_date"),
                         F.min("First_Date").alias("min_first_date"),
                         F.max("Last_Date").alias("max_last_date"))


def distinct_count_with_null(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values, counting null as one value (A9), like
    ``len(series.unique())``."""
    return df.agg((F.countDistinct(col)
                   + F.max(F.col(col).isNull().cast("int"))).cast("bigint").alias("n"))


#: log2 of a sketch's buckets: its standard error is 1.04 / sqrt(2**LOG_BUCKETS), 0.8 %.
LOG_BUCKETS = 14
#: Stated relative error: over three standard errors, and a unit for tiny counts.
SKETCH_ERROR = 0.03


def distinct_sketches(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """(by..., sketch, has_null): a mergeable distinct-count sketch per group (A9 at
    scale). Its size is fixed, whatever the number of rows or values."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(col, LOG_BUCKETS).alias("sketch"),
                               F.max(F.col(col).isNull()).alias("has_null"))


def merged_distinct(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by..., n_estimate): the distinct count over the union of sketches, null
    a value of its own, within SKETCH_ERROR of the exact count (about 1 in 4,000 sketches is not)."""
    return sketches.groupBy(*by).agg(
        (F.hll_sketch_estimate(F.hll_union_agg("sketch")) + F.max("has_null").cast("long")).alias("n_estimate"))
