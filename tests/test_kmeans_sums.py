"""Sums of a k-means step: one row of whole numbers per centre and task."""

import numpy as np
import pyarrow as pa

from boutique.operators import blocks, cluster


def test_sums_meet_by_node_and_exceed_a_long(spark):
    big = 2 ** 62
    rows = [(n, np.array([big, -big, 7 * n, -1], np.int64).tobytes()) for n in (0, 3) for _ in range(5)]
    parts = spark.createDataFrame([(n, bytearray(s)) for n, s in rows], "node int, s binary").repartition(4)
    node, high, low = blocks.add_up(parts)
    whole = (high.astype(object) << 32) + low.astype(object)
    assert node.tolist() == [0, 3]
    assert whole.tolist() == [[5 * big, -5 * big, 0, -5], [5 * big, -5 * big, 105, -5]]
    assert blocks.add_up(parts.limit(0))[0].tolist() == []


def test_a_task_sends_one_row_for_each_centre_that_has_rows():
    x = np.array([[0.0, 0.0], [0.25, 0.0], [1.0, 1.0]])
    table = pa.table({"v": pa.array(x.tolist(), pa.list_(pa.float64()))})
    block = pa.RecordBatch.from_arrays([pa.array([blocks.to_bytes(table)] * 3, pa.binary())], names=["data"])
    out = list(cluster._sums("v", np.array([[0.0, 0.0], [9.0, 9.0], [1.0, 1.0]]), 0.25)(iter([block])))
    assert len(out) == 1 and out[0].column("node").to_pylist() == [0, 2]
    assert [np.frombuffer(s, np.int64).tolist() for s in out[0].column("s").to_pylist()] == [[3, 0, 6], [12, 12, 3]]
