"""Blocks of vectors go to the Python workers a few MB at a time."""

import __spark_entry__ as entry
import numpy as np
import pyarrow as pa

from boutique import session
from boutique.operators import blocks, tree

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_a_batch_holds_one_block_of_the_tree(spark):
    held = spark.conf.get(KEY)
    try:
        for value, want in (("64m", 4 << 20), ("1m", 1 << 20)):
            spark.conf.set(KEY, value)
            entry._prepare(spark)
            assert spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(KEY)) == want
        spark.conf.set(KEY, "64m")
        session.bound_batches(spark)

        def wide(batches):
            for batch in batches:
                ends = pa.array(np.arange(batch.num_rows + 1) * 128, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(np.ones(batch.num_rows * 128)))], names=["v"])

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["b"])

        packed = blocks.packed(spark.range(0, 40_000, 1, 1).mapInArrow(wide, "v array<double>"), tree.BLOCK_NUMBERS // 128).checkpoint(eager=True)
        assert max(r["b"] for r in packed.mapInArrow(sizes, "b long").collect()) < 9 << 20
    finally:
        spark.conf.set(KEY, held)
