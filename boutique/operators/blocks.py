"""Work between every row of one table and every row of another, block by block.

Both tables are packed into blocks of bounded size; a task takes one block of each
and returns a summary (a top-k, a sum, a count), never the pairs. The smaller table's
blocks are numbered evenly by a hash of its key, and joined to the larger table's
blocks on that number: by broadcast if their bytes are under the bound, else by a
shuffle. Nothing goes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block of each side.
LEFT_ROWS = 512
RIGHT_ROWS = 4096
#: Packed bytes of the right side that may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024

#: Tasks that add up the sums of all others in :func:`add_up`.
MERGERS = 2

Work = Callable[[pa.Table, pa.Table], Iterator[pa.RecordBatch]]


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(data) -> pa.Table:
    with pa.ipc.open_stream(data.as_buffer()) as r:
        return r.read_all()


def matrix(column) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


def add_up(parts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``parts`` (node int, s binary: a row of longs): the nodes, and the exact sums of their rows
    as halves (high, low) that no total overflows. Tasks' rows meet by node on the executors;
    the driver gets one row per node."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for node, data in zip(batch.column("node").to_pylist(), batch.column("s")):
                s = np.frombuffer(data.as_buffer(), np.int64)
                halves = held.setdefault(node, np.zeros((2, len(s)), np.int64))
                halves[0] += s >> 32
                halves[1] += s & 0xFFFFFFFF
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([h.tobytes() for h in held.values()], pa.binary())],
                                         names=["node", "s"])

    merged = parts.repartition(min(MERGERS, parts.sparkSession.sparkContext.defaultParallelism), "node").mapInArrow(run, "node int, s binary")
    rows = merged.toArrow().sort_by("node")
    halves = np.frombuffer(b"".join(rows.column("s").to_pylist()), np.int64).reshape(len(rows), 2, -1) if len(rows) else np.zeros((0, 2, 0), np.int64)
    return rows.column("node").to_numpy(), halves[:, 0], halves[:, 1]


def packed(df: DataFrame, rows: int = LEFT_ROWS) -> DataFrame:
    """(data): the rows of each task, ``rows`` at a time."""
    def run(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, rows - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == rows:
                    yield _one(held)
                    held, n = [], 0
        if held:
            yield _one(held)

    def _one(parts):
        return pa.RecordBatch.from_arrays([pa.array([to_bytes(pa.Table.from_batches(parts))], pa.binary())], names=["data"])

    return df.mapInArrow(run, "data binary")


def numbered(df: DataFrame, key: str, rows: int = RIGHT_ROWS) -> tuple[DataFrame, int]:
    """(block, packed) and the number of blocks; ``key`` is unique in ``df``."""
    blocks = max(1, -(-df.count() // rows))

    def run(table):
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()),
                         "packed": pa.array([to_bytes(table.drop_columns(["block"]))], pa.binary())})

    number = F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")
    return df.select(number, "*").groupBy("block").applyInArrow(run, "block long, packed binary"), blocks


def meet(left: DataFrame, right: DataFrame, key: str, work: Work, schema: str,
         left_rows: int = LEFT_ROWS, right_rows: int = RIGHT_ROWS,
         broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``work`` on every pair of blocks of ``left`` and ``right`` (with unique ``key``)."""
    sides, blocks = numbered(right, key, right_rows)
    sides = sides.checkpoint(eager=True)
    size = sides.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    if size <= broadcast_bytes:
        sides = F.broadcast(sides)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    pairs = packed(left, left_rows).select("data", every).join(sides, "block").select("data", "packed")

    def run(batches):
        for batch in batches:
            for one, two in zip(batch.column("data"), batch.column("packed")):
                yield from work(from_bytes(one), from_bytes(two))

    return pairs.mapInArrow(run, schema)


def streamed(left: DataFrame, right: DataFrame, key: str, left_rows: int, right_rows: int,
             broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """(left, data, block, packed), and the number of right blocks: every left block with every right block,
    the pairs of one left block one after the other in one task."""
    sides, count = numbered(right, key, right_rows)
    sides = sides.checkpoint(eager=True)
    size = sides.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias("block")
    # Block numbers without rows meet nothing.
    count = sides.count()
    ones = packed(left, left_rows).withColumn("left", F.monotonically_increasing_id()).select("left", "data", every)
    if size <= broadcast_bytes:
        return ones.join(F.broadcast(sides), "block").select("left", "data", "block", "packed"), count
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = ones.join(sides, "block").select("left", "data", "block", "packed")
    return pairs.repartition(parts, "left").sortWithinPartitions("left"), count
