"""Parquet tables in versions: a keyed batch rewrites only the buckets it hits.

A table is a folder with ``data/<version>/_bucket=<k>/`` and ``manifests/<version>.json``. A row's bucket
is a hash of its key. A manifest names for every bucket the version whose files are current; it is written
under another name and renamed, which fails if another writer has made that version meanwhile. So readers
see the old version or the new one, and files of older versions are never touched.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"
BUCKETS = 64


class VersionConflict(RuntimeError):
    """Another writer has committed this version first."""


class _Files:
    """The few calls on Spark's own file system that a commit needs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(folder).getFileSystem(self.conf)
        self.gateway = spark.sparkContext._gateway

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        """False if ``new`` is there already."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        none = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.path(old), self.path(new), none)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _commit(files: _Files, folder: str, version: int, manifest: dict) -> int:
    name = f"{folder}/manifests/{version:08d}.json"
    draft = f"{folder}/manifests/.{uuid.uuid4().hex}"
    files.write(draft, json.dumps(manifest))
    if not files.rename(draft, name):
        raise VersionConflict(f"version {version} of {folder} exists")
    return version


def current_version(spark: SparkSession, folder: str) -> int:
    """Highest committed version, 0 without one."""
    names = _Files(spark, folder).names(f"{folder}/manifests")
    return max([int(n.removesuffix(".json")) for n in names if n.endswith(".json")], default=0)


def _manifest(files: _Files, folder: str, version: int) -> dict:
    return json.loads(files.read(f"{folder}/manifests/{version:08d}.json"))


def _write(rows: DataFrame, folder: str, files: _Files) -> tuple[str, list[int]]:
    """(name of the new data folder, buckets that have rows in it)."""
    place = uuid.uuid4().hex
    rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{folder}/data/{place}")
    found = [int(n.split("=")[1]) for n in files.names(f"{folder}/data/{place}") if n.startswith(f"{BUCKET}=")]
    return place, found


def create_versioned(df: DataFrame, folder: str, keys: list[str], buckets: int = BUCKETS) -> int:
    """Version 1 of a table with the given key columns."""
    files = _Files(df.sparkSession, folder)
    place, found = _write(df.withColumn(BUCKET, _bucket(keys, buckets)), folder, files)
    return _commit(files, folder, 1, {"keys": keys, "buckets": buckets, "schema": df.schema.json(), "places": {str(b): place for b in found}})


def _read(spark: SparkSession, folder: str, manifest: dict, only: set[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(manifest["schema"]))
    paths = [f"{folder}/data/{place}/{BUCKET}={b}" for b, place in manifest["places"].items() if only is None or int(b) in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the current one by default."""
    files = _Files(spark, folder)
    version = version or current_version(spark, folder)
    if not version:
        raise FileNotFoundError(f"{folder} has no version")
    return _read(spark, folder, _manifest(files, folder, version))


def merge_batch(batch: DataFrame, folder: str, deleted: str = "_deleted", base: int | None = None) -> int:
    """Commit a new version with the batch merged in: its rows replace those of the same key.

    The batch has the table's columns and, if rows go, a flag ``deleted``; one row per key. Only buckets
    with a key of the batch are read and written again; an empty batch commits nothing. The new version
    follows ``base``, by default the current one; if another writer has committed that meanwhile, nothing
    changes and VersionConflict is raised. The batch is read twice: pass a staged or cheap frame.
    """
    spark = batch.sparkSession
    files = _Files(spark, folder)
    base = base or current_version(spark, folder)
    manifest = _manifest(files, folder, base)
    keys, buckets = manifest["keys"], manifest["buckets"]
    changed = batch.withColumn(BUCKET, _bucket(keys, buckets))
    hit = {r[BUCKET] for r in changed.select(BUCKET).distinct().collect()}  # at most the number of buckets
    if not hit:
        return base
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted in batch.columns else F.lit(False)
    columns = StructType.fromJson(json.loads(manifest["schema"])).names
    old = _read(spark, folder, manifest, hit)
    touched = batch.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    kept = old.join(touched, same, "left_anti").withColumn(BUCKET, _bucket(keys, buckets))
    place, found = _write(kept.select(*columns, BUCKET).unionByName(changed.filter(~gone).select(*columns, BUCKET)), folder, files)
    places = {b: p for b, p in manifest["places"].items() if int(b) not in hit} | {str(b): place for b in found}
    return _commit(files, folder, base + 1, manifest | {"places": places})
