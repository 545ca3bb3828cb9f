"""Document fingerprints: threshold-scaled sketches, in DataFrame operations.

A text's sketch keeps every distinct hash of its five-word shingles that falls in the lowest
``1 / SCALE`` of the hash space. Its size is proportional to the text, so sketches
of very unequal texts can be compared, and sketches merge by union: the share of
common hashes estimates resemblance or containment of the full shingle sets.
A text with shingles but none below the threshold keeps its smallest hash instead
(a merge drops it again, as it is above the threshold).

Words are separated by ASCII white space and lower-cased; a text of one to four words is one
shingle. Null, empty and wordless texts have an empty sketch; two empty sketches
are alike (1.0), an empty and another one not (0.0).

The next document in descending order of ids comes from windows over id ranges
of about ``ROWS_PER_RANGE`` rows (from ``MAX_RANGES`` ranges on they grow: at 10^10 rows to
some 150,000); the first row of each range is handed to the range before. Rows with equal ids follow
each other by descending text hash, rows without an id come last, in 256 ranges of that hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
SCALE = 4
ROWS_PER_RANGE = 500
MAX_RANGES = 1 << 16
#: Smallest hash; hashes are compared by their distance from it.
_LOWEST = -(1 << 63)
_BELOW = _LOWEST + (1 << 64) // SCALE
#: Hexadecimal digits of a hash in a fingerprint string.
DIGITS = 12


def with_sketch(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the sketch of ``text_col`` (a text without nulls), a sorted array of longs."""
    w = F.col("_words")
    n = F.size("_words")
    # Each step is its own projection, so none is computed twice.
    df = df.withColumn("_words", F.filter(F.split(F.lower(F.col(text_col)), "[\\x20\\x09-\\x0D]+"), lambda x: x != ""))
    runs = F.transform(F.sequence(F.lit(0), n - SHINGLE),
                       lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
    df = df.withColumn("_hashes", F.when(n >= SHINGLE, runs).when(n > 0, F.array(F.xxhash64(F.array_join(w, " "), F.lit(0))))
                       .otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_low", F.filter("_hashes", lambda h: h < _BELOW))
    df = df.withColumn(out, F.when((F.size("_low") > 0) | (F.size("_hashes") == 0), F.array_sort(F.array_distinct("_low")))
                       .otherwise(F.array(F.array_min("_hashes"))))
    return df.drop("_words", "_hashes", "_low")


def fingerprint(sketch: str) -> Column:
    """A sketch as text: the leading digits of its hashes, joined by commas."""
    def digits(h):
        return F.lower(F.substring(F.lpad(F.hex(h.bitwiseXOR(F.lit(_LOWEST))), 16, "0"), 1, DIGITS))
    return F.array_join(F.transform(sketch, digits), ",")


def resemblance(a: str, b: str) -> Column:
    """Estimated share of common shingles in the union of both."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: str, b: str) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too."""
    return (F.when(F.size(a) == 0, F.when(F.size(b) == 0, 1.0).otherwise(0.0))
            .otherwise(F.size(F.array_intersect(a, b)) / F.size(a)))


def merged(sketches: DataFrame, by: list[str], sketch: str = "sketch") -> DataFrame:
    """One sketch per group: the union of the sketches of its rows."""
    part = sketches.select(*by, F.explode(sketch).alias("h")).where(F.col("h") < _BELOW)
    return part.groupBy(*by).agg(F.array_sort(F.collect_set("h")).alias(sketch))


def _ranges(docs: DataFrame) -> tuple[list[int], int]:
    """Descending cut points of the ids, and rows without an id included, their number."""
    n = docs.count()
    cuts = max(1, min(MAX_RANGES, n // ROWS_PER_RANGE))
    found = docs.agg(F.percentile_approx("doc_id", [i / cuts for i in range(1, cuts)], max(10_000, 10 * cuts)).alias("q")).first()["q"] if cuts > 1 else []
    return sorted(set(found or []), reverse=True), n


def _range_of(cuts: list[int]) -> Column:
    """Number of the range of an id, in two short searches over the cut points."""
    unknown = F.lit(len(cuts) + 128) - F.shiftright("h", 56)  # by descending hash
    if not cuts:
        return F.when(F.col("doc_id").isNull(), unknown).otherwise(F.lit(0))
    step = max(1, int(len(cuts) ** 0.5))
    coarse, fine = cuts[step - 1::step], cuts
    lit = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>") if xs else F.array().cast("array<bigint>")
    skipped = F.size(F.filter(lit(coarse), lambda c: c > F.col("doc_id"))) * step
    rest = F.size(F.filter(F.slice(lit(fine), skipped + 1, F.lit(step)), lambda c: c > F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), unknown).otherwise(skipped + rest)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Each row with its fingerprint, that of its edited text (the last third
    replaced by the beginning of the next document), how alike they are, and the
    share of each that the other holds."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts, n = _ranges(own.select("doc_id"))
    keyed = own.withColumn("h", F.xxhash64("text")).withColumn("part", _range_of(cuts))
    # The first row of every range, in order; the last range is followed by the first.
    place = F.struct(F.coalesce("doc_id", F.lit(_LOWEST)).alias("k"), F.col("doc_id").isNotNull().alias("known"), F.col("h").alias("h"))
    firsts = keyed.groupBy("part").agg(F.max(place).alias("m"))
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    following = (firsts.withColumn("before", F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy(F.lit(0)))))
                 .select("before", F.when(F.col("m.known"), F.col("m.k")).alias("k"), F.col("m.h").alias("mh")))
    heads = (keyed.select(F.col("doc_id").alias("k2"), F.col("h").alias("h2"), F.col("text").alias("head"))
             .join(F.broadcast(following), F.col("k").eqNullSafe(F.col("k2")) & (F.col("mh") == F.col("h2")))
             .groupBy(F.col("before").alias("part")).agg(F.max("head").alias("head")))
    sketched = with_sketch(keyed, "text", "sketch")
    heads = with_sketch(heads, "head", "head_sketch")
    follows = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"), F.desc("h"))
    lined = (sketched.withColumn("next", F.lead("text").over(follows))
             .withColumn("next_sketch", F.lead("sketch").over(follows))
             .join(heads, "part", "left"))
    n_chars = F.length("text")
    replaced = F.floor(F.col("n_chars") / 3).cast("int")
    lined = (lined.withColumn("n_chars", n_chars)
             .withColumn("next_sketch", F.when(F.col("next").isNull(), F.col("head_sketch")).otherwise(F.col("next_sketch")))
             .withColumn("next", F.coalesce("next", "head")).drop("head", "head_sketch")
             .withColumn("edited", F.concat(F.col("text").substr(F.lit(1), F.col("n_chars") - replaced),
                                            F.col("next").substr(F.lit(1), replaced))))
    lined = with_sketch(lined.drop("text", "next"), "edited", "edited_sketch")
    return lined.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("sketch").alias("fingerprint"), fingerprint("edited_sketch").alias("edited_fingerprint"),
        resemblance("sketch", "edited_sketch").alias("near_edited"), resemblance("sketch", "next_sketch").alias("near_next"),
        containment("sketch", "edited_sketch").alias("kept_in_edited"), containment("edited_sketch", "sketch").alias("edited_from_own"))
