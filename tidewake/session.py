"""Session helper for local runs, and the shared staging area used by multi-pass jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def local_session(app: str = "tidewake", cores: int | str = "*", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_STAGED: list[str] = []
# Shuffle files of an execution go when it ends; else they stay until the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: the one the cluster names; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tidewake-stage-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def stage(df: DataFrame, label: str, lean: bool = False, slices: Sequence[Column] = ()) -> DataFrame:
    """Write ``df`` once and read it back.

    For frames that several passes of one job read: the passes prune columns of the written
    table, see its real size, and survive the loss of executors. A ``lean`` one is packed closer, and
    the shuffle files of its write are deleted at once. ``slices`` are conditions of which each row meets
    one; what meets one is written before the next, so that the shuffle files of one are on disk at a time.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    if lean:
        spark.conf.set(_CLEANUP, "true")
    try:
        for part in [df.filter(s) for s in slices] or [df]:
            part.write.parquet(path, mode="append", compression="zstd" if lean else None)
    finally:
        if lean:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    _STAGED.append(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unstage(*staged: DataFrame) -> None:
    """Delete the folders of frames returned by ``stage``; only when nothing that reads them is still to run."""
    for df in staged:
        _STAGED.remove(df._staged_at)
        _delete(df.sparkSession, df._staged_at)


def drop_staged(spark: SparkSession) -> None:
    """Delete the folders staged so far; call it once the results that read them are written."""
    while _STAGED:
        _delete(spark, _STAGED.pop())
