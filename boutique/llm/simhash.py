"""SimHash near-duplicates by Golay-code fuzzy hashing.

A text's fingerprint has 64 bits: each is 1 if it is set in more than half of
the XXH64 hashes of the text's three-word shingles, repeats included. Texts
link if their fingerprints differ in at most ``DISTANCE`` (2) bits.

1. Equal fingerprints are one node, whatever the number of rows.
2. A fingerprint is three segments of 21, 21 and 22 bits. Two errors cannot
   touch all three (pigeonhole): one segment is equal, and its neighbour has at
   most two errors.
3. The perfect binary Golay code of length 23 gives the neighbour segment its
   keys: the indices of the codewords nearest to the segment and to each segment
   one bit away. Segments at distance two or less have a segment in between that
   is at most one bit away from both, so they share a codeword: one to six keys
   instead of all neighbours. A key is (which segment, its bits, codeword index).
4. Fingerprints of a bucket are joined and verified by their exact distance. A
   bucket of more than ``BUCKET`` fingerprints is refined from the codeword to the
   in-between fingerprint itself: members meet at the fingerprints one bit away
   in the unequal segments, at most 44 each, and everything that meets there is linked.
   That is exact too, and linear in the members.
5. Links are contracted to components inside the cluster.

Null, empty and word-free texts have fingerprint zero and link like any other.
Rows with a null id take part; the smallest id of a component leaves nulls out,
so a component without any id has a null one. Repeated ids keep one row for each row.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutique.llm.common import signed, written
from boutique.llm.dedup import components, labels

WORDS = 3
SEED = 42
DISTANCE = 2
#: Lowest bit and width of each segment.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Members of a bucket that are compared with each other; larger buckets are refined.
BUCKET = 64
#: Generator polynomial of the Golay code (fixed value).
GOLAY = 0b110001110101
#: Bytes of a text that are split into words at once.
PIECE_BYTES = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_CACHE: dict = {}


def _pieces(data: bytes):
    """Parts of a text, cut at white space."""
    at = 0
    while at < len(data):
        end = at + PIECE_BYTES
        gap = _SPACE.search(data, end) if end < len(data) else None
        end = gap.end() if gap else len(data)
        yield data[at:end]
        at = end


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit, lowest bit first."""
    if "bits" not in _CACHE:
        _CACHE["bits"] = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(columns[:, k], minlength=256) @ _CACHE["bits"] for k in range(8)])


def fingerprint(text: str | None) -> int:
    """The 64 bits of a whole text."""
    digest, counts, n, held = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []
    for piece in _pieces((text or "").encode().lower()):
        words = held + piece.split()
        if len(words) >= WORDS:
            joined = b" ".join(words)
            size = np.fromiter(map(len, words), np.int64, len(words))
            end = np.cumsum(size + 1) - 1
            spans = zip((end - size)[:len(words) - WORDS + 1].tolist(), end[WORDS - 1:].tolist())
            hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
            counts += _bit_counts(hashes)
            n += len(hashes)
            words = words[1 - WORDS:]
        held = words
    if not n:
        return digest(b" ".join(held), SEED) if held else 0
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def _fingerprints(batches):
    for batch in batches:
        values = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(signed(values), pa.int64())], names=["id", "fp"])


def codeword_index() -> np.ndarray:
    """For each of the 2**23 words, the twelve information bits of its nearest codeword."""
    if "golay" not in _CACHE:
        def remainder(x):
            for shift in range(22, 10, -1):
                if x >> shift & 1:
                    x ^= GOLAY << (shift - 11)
            return x
        syndrome = np.zeros(1, np.uint16)
        for i in range(23):
            syndrome = np.concatenate([syndrome, syndrome ^ np.uint16(remainder(1 << i))])
        error = np.zeros(2048, np.uint32)
        for k in (1, 2, 3):
            for bits in combinations(range(23), k):
                e = sum(1 << b for b in bits)
                error[remainder(e)] = e
        _CACHE["golay"] = ((np.arange(1 << 23, dtype=np.uint32) ^ error[syndrome]) >> 11).astype(np.uint16)
    return _CACHE["golay"]


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints (unsigned) and the row that each belongs to."""
    index = codeword_index()
    part = [(fp >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1) for low, width in SEGMENTS]
    keys, rows = [], []
    for i in range(len(SEGMENTS)):
        j = (i + 1) % len(SEGMENTS)
        near = np.array([0, *(1 << b for b in range(SEGMENTS[j][1]))])
        found = np.sort(index[part[j][:, None] ^ near[None, :]], axis=1)
        fresh = np.diff(found.astype(np.int64), axis=1, prepend=-1) != 0
        row, place = np.nonzero(fresh)
        keys.append((i << 40) | (part[i][row] << 12) | found[row, place])
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def _keys(batches):
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        for at in range(0, len(fp), 4096):
            some = fp[at:at + 4096]
            keys, rows = golay_keys(some.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(some[rows], pa.int64())], names=["key", "fp"])


def _distance(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints ``fp`` (long) within
    the distance, directly or by way of others within it."""
    keys = written(fps.mapInArrow(_keys, "key long, fp long"), "keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    rows = written(keys.join(sizes, "key"), "buckets")
    small = rows.where(F.col("m") <= bucket)
    near = (small.select("key", F.col("fp").alias("u")).join(small.select("key", F.col("fp").alias("v")), "key")
            .where((F.col("u") < F.col("v")) & (_distance("u", "v") <= DISTANCE)).select("u", "v"))
    # Of a large bucket: the fingerprints one bit away, outside the equal segment.
    ball = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
    segment = F.shiftright("key", 40)
    outside = F.filter(ball, lambda x: F.element_at(
        F.array(*[F.lit(_mask(low, width)).cast("long") for low, width in SEGMENTS]), (segment + 1).cast("int"))
        .bitwiseAND(x) == 0)
    large = (rows.where(F.col("m") > bucket).select("fp", segment.alias("segment"), outside.alias("flips")).distinct()
             .select("fp", F.explode("flips").alias("flip"))
             .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("between")).distinct())
    large = written(large, "balls")
    first = large.groupBy("between").agg(F.min("fp").alias("v"), F.count("*").alias("m")).where("m > 1")
    met = large.join(first, "between").where("fp != v").select(F.col("fp").alias("u"), "v")
    return written(near.unionByName(met).distinct(), "near")


def _mask(low: int, width: int) -> int:
    bits = ((1 << width) - 1) << low
    return bits - (1 << 64) if bits >> 63 else bits


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: id_col, fingerprint (16 hexadecimal digits),
    component_id (smallest id reachable over links, the row's own included)."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = written(texts.mapInArrow(_fingerprints, "id long, fp long"), "simhash")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    comps = labels(components(links(nodes.select("fp"), bucket))).withColumnRenamed("id", "fp")
    placed = written(nodes.join(comps, "fp", "left").withColumn("comp", F.coalesce("comp", "fp")), "placed")
    smallest = placed.groupBy("comp").agg(F.min("first").alias("component_id"))
    by_fp = placed.join(smallest, "comp").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
