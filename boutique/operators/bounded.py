"""Size-checked broadcast.

A side is broadcast only after its bytes are measured and found under a
bound; otherwise the planner chooses. The measured frame stays cached until
the next query, so the measuring does not cost a second evaluation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boutique.sources.tables import kept

# Bytes of a small dimension (dictionaries, centroids) that may be shipped to
# every executor.
MAX_BYTES = 64 * 1024 * 1024


def _bytes(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(F.size(c), F.lit(0)) * 8 + 16
    return F.lit(8)


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if its values take at most ``max_bytes``, else
    ``df``. Columns are numbers, strings or arrays of numbers."""
    cached = kept(df)
    row = sum((_bytes(f) for f in df.schema.fields), F.lit(0))
    size = cached.agg(F.sum(row.cast("long")).alias("b")).first()["b"] or 0
    return F.broadcast(cached) if size <= max_bytes else cached
