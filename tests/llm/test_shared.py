"""What the helpers of all operators leave on the disks and send to the workers."""

import time

import pyarrow as pa

from haulgrain.llm.shared import BATCH, CLEANUP, cut, importable


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_cut_leaves_no_shuffle_files(spark):
    before, set_to = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    rows = spark.range(1000).selectExpr("id % 10 as k").groupBy("k").count()
    kept = cut(rows)
    new = True
    for _ in range(50):  # they go behind the action's end
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not new
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, rows.collect())) == [(k, 100) for k in range(10)]
    assert spark.conf.get(CLEANUP, None) == set_to


def test_batches_of_long_texts_are_small(spark):
    """60 texts of 300,000 bytes in one partition."""

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    def counted(spark):
        docs = spark.range(0, 60, 1, 1).selectExpr("repeat('x', 300000) as text")
        return [r.n for r in docs.mapInArrow(work, "n bigint").collect()]

    own = spark.conf.get(BATCH, None)
    try:
        spark.conf.unset(BATCH)
        sizes = importable(counted)(spark)
        assert sum(sizes) == 60 and max(sizes) <= 15
        spark.conf.set(BATCH, "64m")
        assert importable(counted)(spark) == [60]
    finally:
        spark.conf.unset(BATCH) if own is None else spark.conf.set(BATCH, own)
