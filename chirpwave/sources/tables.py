"""Table and file-stream sources.

Batch reads go through ``spark.read.parquet`` so Catalyst prunes columns
and pushes filters into the scan.  Stream reads always declare their
schema (a stream never infers one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied parquet tables (``events``, ``documents`` ...)."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet folder as an unbounded source; new files become new rows."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
