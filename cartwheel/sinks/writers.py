"""Sinks (K1-K12): file writers, partitioned overwrite, load counts, size report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def write_csv(df: DataFrame, path: str) -> str:
    """K1: CSV with a header row, no index. Leading/trailing blanks are kept
    (they are data: ' completed' is not a valid status), NULL is written as an
    empty field and the empty string as ``""``; our readers take both as NULL,
    as the original's does. Timestamps are ISO text, the layout the typed reader expects."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", ISO_TS)
        .csv(path)
    )
    return path


def write_json(df: DataFrame, path: str) -> str:
    """K2: JSON lines with ISO timestamps (splittable, unlike one indented array)."""
    df.write.mode("overwrite").option("timestampFormat", ISO_TS).json(path)
    return path


def write_json_array(df: DataFrame, path: str, indent: int = 2) -> str:
    """K2 array form: each part file is one array of objects, indented by
    ``indent``. Spark makes the objects' text; the rows of a partition only get
    their brackets, commas and indentation on the way out."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"timestampFormat": ISO_TS, "pretty": "true"})
    pad = " " * indent

    def run(batches):
        import pandas as pd

        held = None  # the last object so far: whether a comma follows is not known yet
        for pdf in batches:
            out = []
            for x in pdf["value"]:
                start = "[\n" if held is None else ""
                if held is not None:
                    out.append(held + ",")
                held = start + pad + x.replace("\n", "\n" + pad)
            if out:
                yield pd.DataFrame({"value": out})
        if held is not None:
            yield pd.DataFrame({"value": [held + "\n]"]})

    df.select(text.alias("value")).mapInPandas(run, "value string").write.mode("overwrite").text(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    """K3/K9: Parquet, overwrite."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: str, dynamic: bool = False) -> str:
    """K8: Parquet partitioned by ``by``.

    A ``rebalance`` hint clusters rows on the partition column so each task
    writes few files per directory, and lets AQE split a hot partition value
    over several tasks (and merge small ones) instead of one task per value.
    ``dynamic=True`` replaces only the partitions present in ``df`` (re-running
    a few days); the default replaces the whole table.
    """
    writer = df.hint("rebalance", by).write.mode("overwrite").partitionBy(by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def write_three_formats(df: DataFrame, root: str) -> dict[str, str]:
    """K1-K3 of the same rows: ``df`` is computed once (written as Parquet),
    CSV and JSON are written from the stored Parquet table."""
    parquet = write_parquet(df, f"{root}/format=parquet")
    stored = df.sparkSession.read.parquet(parquet)
    return {
        "csv": write_csv(stored, f"{root}/format=csv"),
        "json": write_json(stored, f"{root}/format=json"),
        "parquet": parquet,
    }


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per ``format=`` directory under ``root``.

    Only ``path`` and ``length`` are selected, so the binary content is not read.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "false")
        .option("pathGlobFilter", "part-*")
        .load(root)
        .select("format", "length")
    )
    return listing.groupBy("format").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").cast("bigint").alias("bytes")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for each table, one aggregate per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
