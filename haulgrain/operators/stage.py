"""Optional materialisation of a stage that several later steps read.

A stage is a function ``(df, name) -> df``.  Plans take one as a parameter and call it at the
frames worth keeping; the default keeps everything in one lazy plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[DataFrame, str], DataFrame]


def no_stage(df: DataFrame, name: str) -> DataFrame:
    return df


def persisted(df: DataFrame, name: str) -> DataFrame:
    """Keep the stage on the executors; a lost block is computed again from its lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a folder inside the warehouse, which the executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages").rstrip("/")


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def written(spark: SparkSession, *only: str) -> Stage:
    """Stage that writes each frame as Parquet below the shared folder and reads it back.

    Later steps then prune columns and see real sizes, so small stages are broadcast safely.
    Given names, it writes just those frames and leaves the others in the plan.  Writing runs a job
    at once, so a plan built with this stage is not lazy up to the written frames.
    """
    base = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"

    def stage(df: DataFrame, name: str) -> DataFrame:
        if only and name not in only:
            return df
        path = f"{base}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return spark.read.parquet(path)

    return stage


@contextmanager
def _joined_as_dealt(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a join takes both sides as they are if they are dealt out alike by some of its keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def buckets_for(rows: int, per_bucket: int = 250_000, least: int = 8) -> int:
    """Number of buckets that keeps a bucket, which one task sorts and holds, at ``per_bucket`` rows."""
    return max(least, -(-rows // per_bucket))


class Bucketed:
    """Stage that writes its frames bucketed and sorted by their keys, so that they meet without exchanges.

    ``keys`` names the frames and the columns each is bucketed by; all get the same number of
    ``buckets``.  Rows are dealt out by these columns once, while they are written; every aggregate
    and join on a bucket key, or on more columns than it, then works inside the buckets.  Frames that are
    not named go to ``other``.  A bucket is one task, so the number of buckets has to suit the
    largest frame, and a key that holds a large share of the rows makes one task as large: for such
    frames stay with ``written``, whose joins adaptive execution splits.

    The tables lie below the shared folder under names of their own; ``drop`` removes them.
    """

    def __init__(self, spark: SparkSession, keys: Mapping[str, Sequence[str]], buckets: int, other: Stage = no_stage):
        if buckets < 1:
            raise ValueError("buckets must be positive")
        self.spark, self.keys, self.buckets, self.other = spark, dict(keys), buckets, other
        self._own = uuid.uuid4().hex
        self.tables: dict[str, str] = {}

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        if name not in self.keys:
            return self.other(df, name)
        keys = list(self.keys[name])
        table = f"bucketed_{name}_{self._own}"
        path = f"{shared_folder(self.spark)}/bucketed-{self._own}/{name}"
        # a bucket is one sorted file
        dealt = self.dealt(df, name)
        with _joined_as_dealt(self.spark):
            dealt.write.format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
        self.tables[name] = table
        return self.spark.table(table)

    def dealt(self, df: DataFrame, name: str) -> DataFrame:
        """Rows dealt out as the buckets of a frame are.

        Where both sides of a join on the bucket key and more columns are, neither the join nor the
        writing of its result needs a further exchange.
        """
        return df.repartition(self.buckets, *self.keys[name])

    def together(self, *names: str) -> bool:
        """Whether these frames are bucketed on the same keys."""
        return all(n in self.keys for n in names) and len({tuple(self.keys[n]) for n in names}) == 1

    def drop(self) -> None:
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()
