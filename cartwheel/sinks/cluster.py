"""A layout that prunes on several columns.

Rows sorted by time let a time predicate skip files, but every file then holds
keys from all over, and the other way round. Here rows are ordered along a
space-filling curve: each column is cut into 2**bits parts of equal size
(quantiles), the bits of the part numbers are interleaved, and files hold
stretches of that order. A file then covers a small box, so the minima and
maxima that Parquet keeps let a predicate on any of the columns skip files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ORDER = "_cw_curve"


def _number(column: str, df: DataFrame) -> Column:
    """The column as a number in the same order (dates and times as seconds)."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("date", "timestamp"):
        return F.unix_seconds(F.col(column).cast("timestamp"))
    return F.col(column).cast("double")


def curve(df: DataFrame, by: list[str], bits: int = 5) -> Column:
    """The place of each row along the curve over ``by`` (numbers, dates or times;
    NULL counts as part 0). The parts' bounds are approximate quantiles of the
    whole table: 2**bits - 1 numbers a column reach the driver."""
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    bounds = df.agg(*[F.percentile_approx(_number(c, df), shares, 10_000).alias(f"b{i}") for i, c in enumerate(by)]).first()
    spread: list[Column] = []
    for i, c in enumerate(by):
        edges = F.array(*[F.lit(float(b)) for b in bounds[f"b{i}"] or []]).cast("array<double>")
        value = _number(c, df).cast("double")
        part = F.coalesce(F.size(F.filter(edges, lambda e: e <= value)), F.lit(0))
        part = F.when(value.isNull(), 0).otherwise(part).cast("bigint")
        for bit in range(bits):
            one = F.shiftright(part, bit).bitwiseAND(1)
            spread.append(F.shiftleft(one, bit * len(by) + i))
    return reduce(lambda a, b: a.bitwiseOR(b), spread)


def write_clustered(df: DataFrame, path: str, by: list[str], files: int | None = None, bits: int = 5) -> str:
    """``df`` as Parquet in the order of the curve over ``by``, in about ``files``
    files (the session's shuffle width unless given). One range shuffle; inside
    a file rows are in the curve's order, so row groups are small boxes, too."""
    placed = df.withColumn(_ORDER, curve(df, by, bits))
    ranged = placed.repartitionByRange(files, _ORDER) if files else placed.repartitionByRange(_ORDER)
    ranged.sortWithinPartitions(_ORDER, *by).drop(_ORDER).write.mode("overwrite").parquet(path)
    return path


def file_boxes(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """Per file its rows and the least and largest value of each column of ``by``."""
    limits = [f(c).alias(f"{n}_{c}") for c in by for f, n in ((F.min, "min"), (F.max, "max"))]
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), *by)
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *limits)
