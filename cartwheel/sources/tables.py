"""Parquet scans of the input tables.

Only the columns a caller names are read, so Catalyst prunes the scan
(``ReadSchema`` in the plan) and pushes filters into it. Timestamps written
without a zone load as ``TimestampNTZType``; they are turned into session
(UTC) timestamps here so that ``unix_timestamp`` / ``withWatermark`` work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return with_session_timestamps(df)


def with_session_timestamps(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP_NTZ column to TIMESTAMP (session zone, UTC)."""
    ntz = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    if not ntz:
        return df
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in ntz else F.col(c) for c in df.columns])
