"""Stages kept under a fingerprint of what they were computed from, and used again.

A stage of the store is named by its plan and by the files it reads.  A later query or job of any session
that reaches the same plan over the same files reads the stage instead of computing it; other
files, other formulas or another library version that plans differently give another fingerprint.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..sources.versions import MARKER, _Files
from .stage import Stage, no_stage, shared_folder


def input_state(df: DataFrame) -> list[str]:
    """Path, length and modification time of the files below a frame, one listing per folder."""
    spark = df.sparkSession
    files = {f.rsplit("/", 1)[0]: None for f in df.inputFiles()}
    wanted = set(df.inputFiles())
    path = spark._jvm.org.apache.hadoop.fs.Path
    state = []
    for folder in sorted(files):
        at = path(folder)
        for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
            name = f"{folder}/{status.getPath().getName()}"
            if name in wanted:
                state.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    if len(state) != len(wanted):
        raise ValueError("input files changed while the plan was read")
    return sorted(state)


def fingerprint(df: DataFrame) -> str:
    """Hash of the canonical plan, which knows no names of this session, and of the input files."""
    spark = df.sparkSession
    shown = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(shown)
    spark.conf.set(shown, str(1 << 20))  # the plan's text is cut otherwise
    try:
        plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        spark.conf.set(shown, before)
    columns = ",".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return hashlib.sha256("\n".join([plan, columns, *input_state(df)]).encode()).hexdigest()[:32]


class StageStore:
    """A stage that keeps the named frames in ``folder`` and reads them where they are there already.

    Only frames over files are kept: a plan that holds rows of its own, of a local list or of an
    earlier session's memory, has no files that would tell whether they are the same, and stays in
    the plan.  ``keep`` versions of each name stay after a write.  ``used`` and ``written`` name what
    this object did.
    """

    def __init__(self, spark: SparkSession, *only: str, folder: str | None = None, keep: int = 2, other: Stage = no_stage):
        if keep < 1:
            raise ValueError("keep must be positive")
        self.spark, self.only, self.keep, self.other = spark, only, keep, other
        self.folder = folder or f"{shared_folder(spark)}/stage-store"
        self.used: list[str] = []
        self.written: list[str] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        if (self.only and name not in self.only) or not df.inputFiles():
            return self.other(df, name)
        path = f"{self.folder}/{name}/{fingerprint(df)}"
        files = _Files(self.spark, path)
        if files.exists(f"{path}/{MARKER}"):
            self.used.append(name)
        else:
            df.write.mode("overwrite").parquet(path)
            self.written.append(name)
            self._retain(name, path)
        return self.spark.read.parquet(path)

    def _retain(self, name: str, newest: str) -> None:
        files, folder = _Files(self.spark, self.folder), f"{self.folder}/{name}"
        paths = [f"{folder}/{n}" for n in files.names(folder)]
        complete = [p for p in paths if p != newest and files.exists(f"{p}/{MARKER}")]
        by_age = sorted(complete, key=lambda p: files.modified(f"{p}/{MARKER}"), reverse=True)
        for path in by_age[self.keep - 1 :]:
            files.remove(path)
