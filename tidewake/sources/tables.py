"""Sources and sinks: declared-schema Parquet in, partitioned Parquet out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.functions import voyage_length_days
from tidewake.schema import TABLES, struct_of

Tables = dict[str, DataFrame]


def with_derived(table: str, df: DataFrame) -> DataFrame:
    """Add the generated column of a table (voyage length)."""
    if table == "CruiseVoyage" and "VoyageLengthDays" not in df.columns:
        return df.withColumn("VoyageLengthDays", voyage_length_days("DepartureDateTime", "ArrivalDateTime"))
    return df


def load_tables(spark: SparkSession, folder: str, names: Iterable[str] | None = None) -> Tables:
    """One DataFrame per table from ``folder/<table>``; nothing is inferred, nothing is read yet."""
    return {
        name: with_derived(name, spark.read.schema(struct_of(name)).parquet(f"{folder}/{name}"))
        for name in (names or TABLES)
    }


def write_tables(tables: Tables, folder: str, mode: str = "errorifexists") -> None:
    for name, df in tables.items():
        columns = [f.name for f in struct_of(name).fields]
        df.select(*columns).write.mode(mode).parquet(f"{folder}/{name}")


def write_split(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write checked rows under status=valid and status=rejected by their ``violations`` column."""
    status = F.when(F.size("violations") > 0, F.lit("rejected")).otherwise(F.lit("valid"))
    df.withColumn("status", status).write.mode(mode).partitionBy("status").parquet(path)


def register_views(tables: Tables) -> None:
    """Expose every table as a temporary view for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
