"""Helpers for the operators: reading tables, row keys, Arrow output."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def spark_schema(schema: pa.Schema):
    return from_arrow_schema(schema)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the identifier and the text, under fixed names; other columns cannot clash with later ones."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def row_key(*cols: str) -> Column:
    """Key of a row by its content: equal rows share it, and so get equal results."""
    return F.xxhash64(*cols)


BATCH_BYTES = 1 << 20
_SHIPPED = "spark.tidewake.llm.shipped"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they run; once per application."""
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidewake-py-")) / "tidewake_llm.zip"
    with zipfile.ZipFile(archive, "w") as out:
        out.write(root / "__init__.py", "tidewake/__init__.py")
        for path in sorted((root / "llm").glob("*.py")):
            out.write(path, f"tidewake/llm/{path.name}")
        out.write(root / "session.py", "tidewake/session.py")
    context.addPyFile(str(archive))
    setattr(context, _SHIPPED, True)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """mapInArrow with the package at hand in the workers; ``schema`` is Arrow's or Spark's.

    Batches are limited by bytes, since texts have any length. Workers are reused by later tasks, so each
    task gives back what it has freed.
    """
    spark = df.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return df.mapInArrow(bounded, spark_schema(schema) if isinstance(schema, pa.Schema) else schema)


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call
        pass
