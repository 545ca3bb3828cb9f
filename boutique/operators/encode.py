"""One-hot encoding in long form, the feature dictionary and dense id codes
(E1-E6, W1-W3, J14).

One-hot contract: categories are the sorted non-null values of an
attribute (numbers sort as numbers, text as text); the first is dropped; a
null encodes as all zeros. Instead of one column per value, an article is a
handful of ``(article_id, feature_idx)`` rows, so 620 features or one
column per article never reach the plan; a wide row is a pair of index and
value arrays, whatever the width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boutique.operators.bounded import bounded_broadcast

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def _long_values(df: DataFrame, key: str | None, attributes: list[str]) -> DataFrame:
    """Unpivot attributes to (key, attribute, attr_pos, value, value_num)."""
    numeric = {f.name for f in df.schema.fields
               if f.name in attributes and isinstance(f.dataType, _NUMERIC)}
    ids = [key] if key else []
    casted = df.select(*ids, *[F.col(a).cast("string").alias(a) for a in attributes])
    long = casted.unpivot(ids, attributes, "attribute", "value")
    # One CASE per derived column (a single parse, not nested column objects).
    pos = F.expr("CASE attribute " + " ".join(
        f"WHEN '{a}' THEN {i}" for i, a in enumerate(attributes)) + " END")
    num_attrs = [a for a in attributes if a in numeric]
    num = (F.expr("CASE WHEN attribute IN (" + ", ".join(f"'{a}'" for a in num_attrs)
                  + ") THEN try_cast(value AS DOUBLE) END")
           if num_attrs else F.lit(None).cast("double"))
    return long.select(*long.columns, pos.cast("int").alias("attr_pos"),
                       num.cast("double").alias("value_num"))


def feature_dictionary(df: DataFrame, attributes: list[str]) -> DataFrame:
    """(attribute, attr_pos, value, value_rank, feature, feature_idx) for
    every non-null value; ``feature_idx`` is null for the dropped first
    value of each attribute and numbers the kept ones 0.. in
    (attribute order, value order).

    Work: one distinct aggregation over the attribute values; the rest runs
    on the dictionary, whose size is the number of distinct values.
    """
    vals = (_long_values(df, None, attributes)
            .filter(F.col("value").isNotNull())
            .select("attribute", "attr_pos", "value", "value_num").distinct())
    ranked = vals.withColumn(
        "value_rank",
        F.row_number().over(Window.partitionBy("attribute").orderBy("value_num", "value"))
        .cast("bigint"))
    # Offset of each attribute = kept values of the attributes before it.
    per_attr = ranked.groupBy("attr_pos").agg((F.count(F.lit(1)) - 1).alias("n_kept"))
    offsets = per_attr.withColumn(
        "offset",
        F.coalesce(F.sum("n_kept").over(Window.orderBy("attr_pos").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    out = ranked.join(F.broadcast(offsets.select("attr_pos", "offset")), "attr_pos")
    return out.select(
        "attribute", "attr_pos", "value", "value_rank",
        F.concat_ws("_", "attribute", "value").alias("feature"),
        F.when(F.col("value_rank") > 1,
               F.col("offset") + F.col("value_rank") - 2).cast("bigint").alias("feature_idx"))


def kept_features(dictionary: DataFrame) -> DataFrame:
    return dictionary.filter(F.col("feature_idx").isNotNull())


def checked_kept(dictionary: DataFrame) -> DataFrame:
    """Kept dictionary entries, broadcast-hinted if their count is under
    the bound (see :func:`bounded_broadcast`)."""
    return bounded_broadcast(kept_features(dictionary).select(
        "attribute", "value", "feature_idx", "feature"))


def onehot_long(df: DataFrame, key: str, attributes: list[str],
                dictionary: DataFrame, checked: DataFrame | None = None) -> DataFrame:
    """(key, feature_idx, feature) — one row per kept one-hot 1.

    The dictionary is broadcast after its size is checked; the big side is
    never shuffled for this join when the check passes. ``checked`` passes
    an already size-checked kept dictionary."""
    long = _long_values(df, key, attributes).filter(F.col("value").isNotNull())
    dic = checked if checked is not None else checked_kept(dictionary)
    return long.join(dic, ["attribute", "value"], "inner").select(key, "feature_idx", "feature")


def categories(df: DataFrame, attributes: list[str]) -> dict[str, list]:
    """Sorted distinct non-null values of several low-cardinality
    attributes in one job (numbers sorted as numbers). The distinct raw
    values are counted down before they are unpivoted; the driver gets one
    row per value, each of which names a column."""
    rows = (_long_values(df.select(*attributes).distinct(), None, attributes)
            .filter(F.col("value").isNotNull())
            .select("attribute", "value", "value_num").distinct().collect())
    types = dict(df.dtypes)
    out: dict[str, list] = {a: [] for a in attributes}
    for r in rows:
        out[r["attribute"]].append(r)
    for a, vals in out.items():
        vals.sort(key=lambda r: (r["value_num"] is None, r["value_num"], r["value"]))
        integral = types[a] in ("tinyint", "smallint", "int", "bigint")
        out[a] = [int(r["value_num"]) if integral else
                  (r["value_num"] if r["value_num"] is not None else r["value"]) for r in vals]
    return out


def onehot_columns(df: DataFrame, attributes: list[str], drop_first: bool = True) -> DataFrame:
    """Wide one-hot of low-cardinality columns, pandas ``get_dummies``
    style (E1, E3): the attribute columns are replaced by ``attr_value``
    0/1 columns appended after the untouched ones."""
    keep = [c for c in df.columns if c not in attributes]
    new_cols = []
    cats = categories(df, attributes)
    for a in attributes:
        vals = cats[a]
        for v in (vals[1:] if drop_first else vals):
            new_cols.append(F.when(F.col(a) == F.lit(v), F.lit(1)).otherwise(F.lit(0))
                            .alias(f"{a}_{v}"))
    return df.select(*keep, *new_cols)


def wide_from_long(long: DataFrame, key: str, index_col: str, value_col: str) -> DataFrame:
    """One wide row per key (E5) in a fixed schema: the sorted indices of its
    non-zero cells and their values. Every other cell is 0. An array holds at
    most one entry per column of the wide frame."""
    cells = F.sort_array(F.collect_list(F.struct(F.col(index_col).alias("i"), F.col(value_col).alias("v"))))
    return long.groupBy(key).agg(cells.alias("c")).select(
        key, F.col("c.i").alias("idx"), F.col("c.v").alias("val"))


def dense_codes(df: DataFrame, keys: list[str], code_col: str = "code",
                partitions: int | None = None) -> DataFrame:
    """Codes 0..n-1 over the distinct keys in key order (W1, W2; D6).

    No single-task window: distinct keys are range-partitioned and sorted,
    each row gets (partition, position) from ``monotonically_increasing_id``,
    and a per-partition offset table (one row per partition, so its size is
    bounded by the partition count) turns that into a global rank. The
    sorted keys are checkpointed to the cluster's checkpoint folder so both
    uses of them see the same partitions, and the lineage is cut.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = df.select(*keys).distinct()
    ranged = (distinct.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)
    located = (ranged.withColumn("_pid", F.shiftright("_mid", 33))
               .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = located.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    out = located.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
    return out.select(*keys, (F.col("_off") + F.col("_pos")).cast("bigint").alias(code_col))


def lookup(df: DataFrame, col: str, dictionary: DataFrame, dict_key: str,
           dict_value: str, out_col: str | None = None) -> DataFrame:
    """Map a column through a dictionary table (J14); a missing key gives
    null. A left join, so the dictionary may be as large as the data."""
    out_col = out_col or col
    d = dictionary.select(F.col(dict_key).alias("_k"), F.col(dict_value).alias("_v"))
    j = df.join(d, F.col(col) == F.col("_k"), "left")
    cols = [F.col("_v").alias(out_col) if (c == col and out_col == col) else F.col(c)
            for c in df.columns]
    if out_col != col:
        cols.append(F.col("_v").alias(out_col))
    return j.select(*cols)
