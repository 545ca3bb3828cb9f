"""Helpers shared by the operators: shared scratch, materialised steps and
vectorised word hashing on Arrow string buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boutique.session import scratch_path
from boutique.sources.tables import read_table

#: Bytes of text worked on at once inside a task; temporary arrays take about
#: 60 times as much.
BLOCK_BYTES = 1 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLES: dict = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the
    lineage ends there and a lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows no model learns from (null ids are held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, elementwise."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; kept per process, grown as
    needed up to one block."""
    have = _TABLES.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES)
        inverse = pow(_BASE, -1, 1 << 64)
        have = tuple(
            np.concatenate((np.ones(1, _U64), np.cumprod(np.full(size - 1, b, _U64), dtype=_U64)))
            for b in (_BASE, inverse))
        _TABLES["powers"] = have
    return have


def ascii_lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def not_space() -> np.ndarray:
    """Bytes of words: everything but 0x20 and 0x09-0x0D."""
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edge[0::2], edge[1::2]


def run_hashes(data: np.ndarray, inside: np.ndarray, starts: np.ndarray,
               ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of ``data`` (already folded bytes)."""
    if not len(starts):
        return np.zeros(0, _U64)
    power, inverse = _powers(len(data))
    terms = (data.astype(_U64) + _U64(1)) * power[:len(data)]
    terms[~inside] = 0
    total = np.add.reduceat(terms, starts)
    return mix64(total * inverse[starts] + (ends - starts).astype(_U64))


def blocks(data: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of a long byte string of at most a block, cut between words (a
    word longer than a block stays whole)."""
    at = 0
    while at < len(data):
        end = min(len(data), at + BLOCK_BYTES)
        if end < len(data):
            gaps = np.flatnonzero(~word[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                rest = np.flatnonzero(~word[data[end:]])
                end = end + int(rest[0]) + 1 if len(rest) else len(data)
        yield at, end
        at = end


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and offsets of an Arrow string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def row_groups(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose bytes fill about one block."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the ASCII-lower-cased words of one text, block by block."""
    lower, word = ascii_lower(), not_space()
    out = []
    for a, b in blocks(data, word):
        piece = lower[data[a:b]]
        inside = word[piece]
        out.append(run_hashes(piece, inside, *spans(inside)))
    return np.concatenate(out) if out else np.zeros(0, _U64)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` words; fewer words make one shingle of
    the whole sequence; none, none."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, size)
    total = np.zeros(n - k + 1, _U64)
    factor = 1
    for i in range(k):
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        total += words[i:n - k + 1 + i] * _U64(factor)
    return mix64(total + _U64(k))


def each_shingle_set(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    lower, word = ascii_lower(), not_space()
    data, offsets = string_bytes(column)
    for a, b in row_groups(offsets):
        if b == a + 1:
            yield np.unique(shingle_hashes(word_hashes(data[offsets[a]:offsets[b]]), size))
            continue
        # Several short texts at once, a separator byte between them.
        base = offsets[a]
        piece = lower[data[base:offsets[b]]]
        inside = word[piece]
        starts, ends = spans(inside)
        cuts = offsets[a + 1:b] - base
        cross = np.searchsorted(starts, cuts, side="left")
        joined = np.zeros(len(cuts), bool)
        has = cross > 0
        joined[has] = ends[cross[has] - 1] > cuts[has]
        if joined.any():  # a word that runs over a text's end belongs to two texts
            at = np.unique(cuts[joined])
            starts = np.sort(np.concatenate((starts, at)))
            ends = np.sort(np.concatenate((ends, at)))
        hashes = run_hashes(piece, inside, starts, ends)
        bounds = np.searchsorted(starts, offsets[a:b + 1] - base, side="left")
        for i in range(b - a):
            yield np.unique(shingle_hashes(hashes[bounds[i]:bounds[i + 1]], size))


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed long."""
    return x.view(np.int64)
