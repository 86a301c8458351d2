import threading

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.holding import _tables, held


def test_threads_with_one_plan_share_one_copy(spark):
    made = spark.sparkContext.accumulator(0)
    started, checked = threading.Barrier(4), []

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    source = spark.range(1000).mapInArrow(count, "id long")
    plans = [source.select((F.col("id") * 2).alias("twice")) for _ in range(4)]

    def use(i):
        with held(plans[i]) as rows:
            started.wait(30)
            if i == 0:
                rows.count()
            started.wait(60)
            rows.agg(F.sum("twice")).first()
            if i == 0:
                return
            # the first user is gone, the copy is still there
            checked.append(rows.storageLevel.useMemory)
            rows.agg(F.sum("twice")).first()

    threads = [threading.Thread(target=use, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert checked == [True] * 3
    assert made.value == 1000
    assert not plans[0].storageLevel.useMemory and not _tables


def test_a_callers_copy_stays(spark):
    mine = spark.range(5).persist()
    with held(mine):
        pass
    assert mine.storageLevel.useMemory
    mine.unpersist()


def test_freed_after_an_error(spark):
    rows = spark.range(6).select("id")
    with pytest.raises(ValueError), held(rows):
        raise ValueError
    assert not rows.storageLevel.useMemory and not _tables
