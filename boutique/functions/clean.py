"""Scalar column expressions.

All are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from boutique import params


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_all(c: str | Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Case-sensitive substring replacements applied in order."""
    out = _col(c)
    for pat, repl in pairs:
        out = F.replace(out, F.lit(pat), F.lit(repl))
    return out


def clean_news(c: str | Column = "fashion_news_frequency") -> Column:
    """Newsletter cleaning: None→NONE, Monthly→Regularly, null→NONE."""
    return F.coalesce(replace_all(c, params.NEWS_REPLACEMENTS), F.lit(params.NEWS_NULL_FILL))


def merge_groups(c: str | Column, groups: list[str], label: str = params.ITEMS_LABEL) -> Column:
    """Exact-name merge of some categories into one label (X3, decision D1).
    An empty list leaves the column as it is."""
    if not groups:
        return _col(c)
    return F.when(_col(c).isin(groups), F.lit(label)).otherwise(_col(c))


def fill_zero(c: str | Column) -> Column:
    """Null → 0 (X5)."""
    return F.coalesce(_col(c), F.lit(0))


def shift(c: str | Column, by: int = params.AGE_SHIFT) -> Column:
    """Subtract a constant once (P5, decision D7)."""
    return _col(c) - F.lit(by)


def flag(index_group: str | Column, section: str | Column, groups: list[int],
         section_value: int) -> Column:
    """0/1 flag: index group in ``groups`` or section equal to a value
    (F1-F3). Nulls compare as false, as in the pandas original."""
    hit = _col(index_group).isin(groups) | (_col(section) == F.lit(section_value))
    return F.coalesce(hit, F.lit(False)).cast("int")


def female_flag(ig="index_group_no", sec="section_no") -> Column:
    return flag(ig, sec, params.FEMALE_INDEX_GROUPS, params.FEMALE_SECTION)


def male_flag(ig="index_group_no", sec="section_no") -> Column:
    return flag(ig, sec, params.MALE_INDEX_GROUPS, params.MALE_SECTION)


def children_flag(ig="index_group_no", sec="section_no") -> Column:
    return flag(ig, sec, params.CHILDREN_INDEX_GROUPS, params.CHILDREN_SECTION)


def share(part: str | Column, total: str | Column) -> Column:
    """part / total, 0 when the total is 0 or null (A7; D22).

    ``try_divide`` never raises under ANSI mode and never yields NaN, which
    would compare as larger than any threshold."""
    return F.coalesce(F.try_divide(_col(part).cast("double"), _col(total)), F.lit(0.0))


def scale_trunc(c: str | Column, factor: int = params.INT_SCALE) -> Column:
    """Multiply, then truncate toward zero to int."""
    return (_col(c) * F.lit(factor)).cast("int")


def in_list(c: str | Column, values: list, exclude: bool = False) -> Column:
    """Membership with pandas null semantics: a null value is never in the
    list, so it is kept by an exclusion (F5)."""
    hit = F.coalesce(_col(c).isin(values), F.lit(False))
    return ~hit if exclude else hit


def parse_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Strict date parse."""
    return F.to_date(_col(c), fmt)


def parse_date_lenient(c: str | Column) -> Column:
    """Lenient parse (X7): any leading timestamp text, bad values → null."""
    return F.coalesce(F.try_to_timestamp(_col(c)),
                      F.try_to_timestamp(F.substring(_col(c), 1, 10),
                                         F.lit("yyyy-MM-dd"))).cast("date")


def days_between(end: str | Column, start: str | Column) -> Column:
    """Whole days end - start (A3, X8) as bigint."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def squared_distance(a: str | Column, b: str | Column) -> Column:
    """Squared Euclidean distance of two equal-length double arrays."""
    diffs = F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)


def distance(a: str | Column, b: str | Column) -> Column:
    return F.sqrt(squared_distance(a, b))
