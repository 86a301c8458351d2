"""Batches of rows with long values are bounded in bytes, not in rows alone."""

import pyarrow as pa
from pyspark.sql import functions as F

from tallyframe.llm import arrays, shinglejoin


def test_batches_of_large_rows_are_small(spark):
    arrays.bound_batches(spark)
    rows = spark.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    found = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(found) == 40 and max(found) <= 2 * arrays.BATCH_BYTES >> 20


def test_sets_link(spark):
    def packed(*hashes):
        return b"".join(h.to_bytes(8, "little") for h in hashes)

    data = [(packed(1, 2, 3, 4), packed(1, 2, 3)), (packed(1, 2, 3, 4), packed(1, 2, 5)), (packed(9), packed(9))]
    rows = spark.createDataFrame(data, "a binary, b binary")
    assert [r[0] for r in rows.select(shinglejoin.sets_link("a", "b")).collect()] == [True, False, True]
