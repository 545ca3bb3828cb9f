"""MinHash near-duplicate detection: one-permutation hashing with optimal
densification, banded buckets and star-shaped candidate edges.

1. Each text becomes its set of distinct word shingles (64-bit hashes). Texts
   with equal sets are one class, represented by the smallest id; only
   classes go on, so thousands of copies cost as much as one text.
2. One permutation of the hash space splits a set into ``BINS`` bins, each
   keeping its smallest hash. An empty bin takes the value of the first
   filled bin in its own fixed random order (optimal densification).
3. Rows of ``BAND_ROWS`` bins make ``BANDS`` bucket keys. Every bucket is a
   star: each member pairs with a centre of another component, so the pairs of
   a turn are at most ``BANDS`` per class; the one closest by sketch is confirmed on the
   full sets. Confirmed links are contracted to components, and ``TURNS``
   turns with changing centres leave few buckets with several components.
4. In those, the members outside the bucket's largest component are compared
   with its members of other components, so that no link found by the
   buckets is lost to the star shape. Hopeless pairs are discarded inside the join: by
   sizes and by the shingles that only one member has, an exact bound, then by
   sketches (four bits of each bin). The rest is confirmed on full sets.

Probability that a pair at similarity 0.8 shares no bucket:
(1 - 0.8**4)**32 = 5e-8; that the sketch discards it: about 3e-6. The result
has no false link.

Null, empty and word-free texts have an empty set and no link. Repeated ids
keep one row each; they share the class of the id's smallest set.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutique.llm.common import each_shingle_set, mix64, signed, written

BINS = 1024
BANDS = 32
BAND_ROWS = 4
#: Differing bins up to which a pair is confirmed on the full sets: the
#: expectation at 0.8 (0.2 * 15/16 of the bins) plus 4.5 deviations.
MAX_DIFFERENT = 248
#: Turns of star edges before the remaining pairs are compared.
TURNS = 3
#: Rows of one or two longs that may be broadcast (16 MB), after a count; more are shuffled.
BROADCAST_ROWS = 1_000_000
#: Probes of an empty bin before all filled bins are ranked at once.
PROBES = 16
#: Of four bits, one in each position that a sketch word holds 16 times.
_NIBBLES = 0x1111111111111111

SIGNED_SCHEMA = ("id long, n_shingles long, set_id binary, bands array<long>, sketch array<long>")


def _probe_order() -> tuple[np.ndarray, np.ndarray]:
    """rank[e, j]: place of bin j in the fixed random probing order of bin e;
    and the first bins of each order."""
    e, j = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(BINS, dtype=np.uint64),
                       indexing="ij")
    rank = mix64(mix64(e + np.uint64(1)) + j * np.uint64(0x9E3779B97F4A7C15))
    return rank, np.argsort(rank, axis=1)[:, :PROBES]


def bin_minima(hashes: np.ndarray, order: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Smallest hash of each bin of a sorted, non-empty set, empty bins
    densified."""
    bins = (hashes >> np.uint64(64 - 10)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    filled = bins[first]
    out = np.zeros(BINS, np.uint64)
    out[filled] = hashes[first]
    full = np.zeros(BINS, bool)
    full[filled] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        rank, probes = order
        tried = full[probes[empty]]
        place = tried.argmax(axis=1)
        donor = probes[empty, place]
        far = np.flatnonzero(~tried[np.arange(len(empty)), place])
        if len(far):
            donor[far] = filled[np.argmin(rank[np.ix_(empty[far], filled)], axis=1)]
        out[empty] = out[donor]
    return out


def _sign(size: int):
    def run(batches):
        order = _probe_order()
        factors = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                            0x27D4EB2F165667C5], np.uint64)
        band_no = np.arange(1, BANDS + 1, dtype=np.uint64)
        shifts = (np.arange(16, dtype=np.uint64) * np.uint64(4))[None, :]
        for batch in batches:
            counts, sets, bands, sketches = [], [], [], []
            for s in each_shingle_set(batch.column("text"), size):
                counts.append(len(s))
                sets.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                if not len(s):
                    bands.append(None)
                    sketches.append(None)
                    continue
                minima = bin_minima(s, order)
                rows = minima[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
                bands.append(signed(mix64((rows * factors).sum(axis=1, dtype=np.uint64) + band_no)))
                bits = (mix64(minima) & np.uint64(15)).reshape(BINS // 16, 16)
                sketches.append(signed((bits << shifts).sum(axis=1, dtype=np.uint64)))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(sets, pa.binary()),
                 pa.array(bands, longs), pa.array(sketches, longs)],
                names=["id", "n_shingles", "set_id", "bands", "sketch"])
    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            sets = [s.tobytes() for s in each_shingle_set(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())],
                                             names=["id", "shingles"])
    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            sets_a, sets_b = batch.column("set_a"), batch.column("set_b")
            for i in range(batch.num_rows):
                a = np.frombuffer(sets_a[i].as_buffer(), np.uint64)
                b = np.frombuffer(sets_b[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def contract(edges: DataFrame) -> DataFrame:
    """One pass over edges (u, v): each node's larger neighbours, then its
    smaller ones, are linked to its smallest neighbour instead. What is connected stays so."""
    links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    both = links.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
                        .alias("e")).select("e.u", "e.v")
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small_low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(small_low, "u").select(F.explode(F.array(
        F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return written(small.select("e.u", "e.v").where("u != v").distinct(), "links")


def labels(links: DataFrame) -> DataFrame:
    """(id, comp): the smallest neighbour of each larger end."""
    return links.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("comp"))


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) contracted until every one points to the smallest id of its
    component; the number of passes grows with the logarithm of a component's
    size. Links stay in the cluster."""
    before = None
    while True:
        links = contract(links)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return links
        before = now


def _different(x: str, y: str):
    """Number of differing bins of two sketches (words of 16 four-bit values)."""
    def differ(p, q):
        d = p.bitwiseXOR(q)
        d = d.bitwiseOR(F.shiftright(d, 1))
        d = d.bitwiseOR(F.shiftright(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(_NIBBLES)))
    return F.aggregate(F.zip_with(x, y, differ), F.lit(0), lambda s, v: s + v)


def _sizes_fit(x: str, y: str, percent: int):
    return ((F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent))


def _light(df: DataFrame) -> DataFrame:
    """``df`` (written, narrow), marked for broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose full shingle sets are similar."""
    with_b = sets.withColumnsRenamed({"id": "b", "shingles": "set_b"}).join(_light(pairs), "b")
    centres = _light(written(pairs.select(F.col("a").alias("id")).distinct(), "centres"))
    of_a = sets.join(centres, "id", "left_semi").withColumnsRenamed({"id": "a", "shingles": "set_a"})
    joined = with_b.join(of_a.hint("merge"), "a")
    return written(joined.select("a", "b", "set_a", "set_b").mapInArrow(_confirm(percent), "u long, v long"), "confirmed")


def _best_stars(rows: DataFrame, sketches: DataFrame, turn: int, percent: int) -> DataFrame:
    """One promising pair for each class: its bucket centres of other
    components (the two ends of a bucket by a hash that changes each turn), the
    closest by sketch. ``rows`` has id, band, key, comp."""
    place = F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "comp") if turn else F.struct("id", "comp")
    ends = (rows.groupBy("band", "key").agg(F.min(place).alias("x"), F.max(place).alias("y"),
                                            F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 != c2"))
    centre = F.when(F.col("x.comp") != F.col("comp"), F.col("x.id")).when(F.col("y.comp") != F.col("comp"), F.col("y.id"))
    pairs = (rows.join(ends.select("band", "key", "x", "y"), ["band", "key"])
             .select(centre.alias("a"), F.col("id").alias("b")).where("a is not null").distinct())
    pairs = written(pairs, "stars")
    def side(s):
        return sketches.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"s_{s}"))
    best = (pairs.join(side("a"), "a").join(side("b"), "b").where(_sizes_fit("n_a", "n_b", percent))
            .withColumn("diff", _different("s_a", "s_b")).where(F.col("diff") <= MAX_DIFFERENT)
            .groupBy("b").agg(F.min(F.struct("diff", "a")).alias("m")).select(F.col("m.a").alias("a"), "b"))
    return written(best, "pairs")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links (pairs whose
    shingle sets share at least ``percent`` % of their union); ``kept`` marks
    that id. Rows with a null id have a null component and are kept.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed_rows = written(texts.mapInArrow(_sign(size), SIGNED_SCHEMA), "sketches")
    known = signed_rows.where("id is not null and n_shingles > 0")
    classes = written(known.groupBy("set_id").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"),
                                                  F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
                      "classes")
    # An id with two different texts (repeated rows) stands for the smaller set's class.
    chosen = classes.groupBy("id").agg(F.min("set_id").alias("set_id"))
    reps = classes.join(chosen, ["id", "set_id"], "left_semi") if not _unique_ids(known) else classes

    # Buckets with one member have no pair.
    rows = reps.select("id", F.posexplode("bands").alias("band", "key"))
    full = rows.groupBy("band", "key").agg(F.count("*").alias("m")).where("m > 1").select("band", "key")
    rows = written(rows.join(full, ["band", "key"], "left_semi"), "rows")
    candidates = _light(written(rows.select("id").distinct(), "candidates"))
    one_text = texts.where("id is not null").join(candidates, "id", "left_semi")
    if not _unique_ids(known):
        one_text = _text_of_class(one_text, chosen, size)
    sets = written(one_text.mapInArrow(_sets(size), "id long, shingles binary"), "sets")
    narrow = written(reps.join(candidates, "id", "left_semi").select("id", "n", "bands", "sketch"), "narrow")

    links = None
    for turn in range(TURNS):
        placed = rows.withColumn("comp", F.col("id")) if links is None else _placed(rows, links)
        found = _confirmed(_best_stars(placed, narrow, turn, percent), sets, percent)
        links = found if links is None else links.unionByName(found)
        links = contract(links) if turn < TURNS - 1 else components(links)

    # Buckets that still hold several components.
    placed = _placed(rows, links)
    per_comp = placed.groupBy("band", "key", "comp").agg(F.count("*").alias("m"))
    mixed = (per_comp.groupBy("band", "key").agg(F.max(F.struct("m", "comp")).alias("t"),
                                                 F.count("*").alias("comps"))
             .where("comps > 1").select("band", "key", F.col("t.comp").alias("largest")))
    members = written(placed.join(mixed, ["band", "key"]), "mixed")
    members = written(members.join(narrow, "id").join(_light(_own_shingles(members, sets)), "id", "left")
                      .withColumn("own", F.coalesce("own", F.lit(0))), "members")
    left = members.where("comp != largest").select(
        "band", "key", *[F.col(c).alias(f"{c}_a") for c in ("id", "comp", "n", "own", "bands", "sketch")])
    right = members.select(
        "band", "key", "largest", *[F.col(c).alias(f"{c}_b") for c in ("id", "comp", "n", "own", "bands", "sketch")])
    shared_before = (F.col("left.band") > 0) & F.exists(
        F.slice(F.zip_with("bands_a", "bands_b", lambda p, q: p == q), 1, F.greatest(F.col("left.band"), F.lit(1))),
        lambda e: e)
    rest = left.alias("left").join(
        right.alias("right"),
        (F.col("left.band") == F.col("right.band")) & (F.col("left.key") == F.col("right.key"))
        & (F.col("comp_a") != F.col("comp_b"))
        & ((F.col("comp_b") == F.col("largest")) | (F.col("id_a") < F.col("id_b")))
        & (100 * F.least(F.col("n_a") - F.col("own_a"), F.col("n_b") - F.col("own_b"))
           >= percent * F.greatest(F.col("n_a") + F.col("own_b"), F.col("n_b") + F.col("own_a")))
        & (_different("sketch_a", "sketch_b") <= MAX_DIFFERENT) & ~shared_before)
    rest = written(rest.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), "pairs")
    more = _confirmed(rest, sets, percent)
    final = labels(components(links.unionByName(more)))
    by_set = classes.select("set_id", "id").join(final, "id", "left").select(
        "set_id", F.coalesce("comp", "id").alias("comp"))
    return (signed_rows.select(F.col("id").alias(id_col), "n_shingles", "set_id")
            .join(by_set, "set_id", "left")
            .select(id_col, "n_shingles",
                    F.when(F.col(id_col).isNotNull() & (F.col("n_shingles") > 0), F.col("comp")).otherwise(F.col(id_col)).alias("component_id"))
            .withColumn("component_id", F.coalesce("component_id", id_col))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def _own_shingles(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, own): shingles of a member that no other member has. They are in no
    intersection and in every union, which bounds a pair's similarity."""
    ids = _light(written(members.select("id").distinct(), "member_ids"))
    shingles = sets.join(ids, "id", "left_semi").mapInArrow(_each_shingle, "id long, g long")
    single = shingles.groupBy("g").agg(F.count("*").alias("m"), F.min("id").alias("id")).where("m = 1")
    return written(single.groupBy("id").agg(F.count("*").alias("own")), "own")


def _each_shingle(batches):
    for batch in batches:
        for one, data in zip(batch.column("id"), batch.column("shingles")):
            g = np.frombuffer(data.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), one.as_py()), pa.int64()), pa.array(g, pa.int64())],
                                             names=["id", "g"])


def _placed(rows: DataFrame, links: DataFrame) -> DataFrame:
    return rows.join(_light(written(labels(links), "labels")), "id", "left").select("id", "band", "key", F.coalesce("comp", "id").alias("comp"))


def _unique_ids(known: DataFrame) -> bool:
    n = known.agg(F.count("*").alias("n"), F.count_distinct("id").alias("u")).first()
    return n["n"] == n["u"]


def _text_of_class(texts: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """With repeated ids: the one text per id whose set represents it."""
    ids = texts.mapInArrow(_sign_text(size), "id long, text string, set_id binary")
    return (ids.join(nodes, ["id", "set_id"], "left_semi").groupBy("id")
            .agg(F.min("text").alias("text")))


def _sign_text(size: int):
    def run(batches):
        for batch in batches:
            sets = [hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    for s in each_shingle_set(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text"), pa.array(sets, pa.binary())],
                names=["id", "text", "set_id"])
    return run
