"""What all operators of this folder share: the folder for written stages, the input columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Spark setting: bytes of the rows that go to a Python worker at once; rows of long texts fill tens of megabytes otherwise
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def importable(call: Callable) -> Callable:
    """Let Python workers find this package where the driver has it, before ``call(spark, ...)`` runs.

    A cluster without that folder gets the package in its usual way, such as ``--py-files``.  Unless the
    session says otherwise, workers get batches of at most ``BATCH_BYTES``.
    """

    @wraps(call)
    def ready(spark: SparkSession, *args):
        root, env = str(Path(__file__).parents[2]), spark.sparkContext.environment
        known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in known:
            env["PYTHONPATH"] = os.pathsep.join([*known, root])
        if spark.conf.get(BATCH, None) is None:
            spark.conf.set(BATCH, BATCH_BYTES)
        return call(spark, *args)

    return ready


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder in the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark setting: the shuffle files of an action go when it ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Frames made inside leave no shuffle files behind their actions; each is to be run once only.

    Otherwise these files stay until the driver's JVM happens to collect its garbage, and a loop of
    many small jobs fills the disks meanwhile.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint; its files go when the frame is no longer used."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    with shuffles_dropped(spark):
        return df.select("*").checkpoint()  # a frame of its own: the setting counts when a frame is made


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v): one row (node, component) per node that has an edge.

    The component is the smallest node reachable.  Alternates a large and a small star step, each
    one aggregate and one join, so no node's neighbours are ever gathered in one row.  The number
    of rounds grows with the logarithm of the number of nodes.  Loops and nulls are left out; an
    empty input gives an empty result.
    """

    def star(pairs: DataFrame, small: bool) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        if small:
            moved = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            moved = moved.union(least.select("u", F.col("m").alias("v")))
        else:
            moved = pairs.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.where("u <> v").distinct()

    now = cut(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct()
    )
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, small=False)
        after = cut(star(large, small=True))
        same = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if same == now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first():
            break
        now = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
