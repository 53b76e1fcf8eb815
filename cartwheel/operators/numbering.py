"""Parallel dense numbering 1..N.

``row_number()`` over an un-partitioned window moves every row into one task.
Instead the rows are range-partitioned on the ordering key and sorted inside
each partition, and the result is written as Parquet with each row's
partition and position (so counting and numbering read the same rows, also
after an executor loss). Row number = rows of earlier partitions + position;
the table of partition counts has one row per partition, is written once, and
is broadcast, so the stored rows are not shuffled again. The result equals the
global ``row_number()`` over the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_LOW_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits
#: Rows of one range (its sort takes 100 to 200 MB); more rows make more ranges.
ROWS_PER_RANGE = 1_000_000


def dense_row_number(
    df: DataFrame,
    order_by: list[str | Column],
    out_col: str,
    num_partitions: int | None = None,
    start: int | Column = 1,
    rows: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = global row number by ``order_by`` (ascending), starting at ``start``.

    Without ``num_partitions`` the session's shuffle width is the upper bound
    and adaptive execution merges small ranges by size; with ``rows`` (about how
    many there are) the ranges become more as the rows do. The result reads the
    stored rows: a caller needs no copy of its own.
    """
    spark = df.sparkSession
    if num_partitions is None and rows is not None and rows > ROWS_PER_RANGE * int(spark.conf.get("spark.sql.shuffle.partitions")):
        num_partitions = -(-rows // ROWS_PER_RANGE)
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    mid = F.monotonically_increasing_id()
    tagged = ranged.sortWithinPartitions(*cols).withColumn("_cw_mid", mid)
    path = scratch_path(spark, "numbered")
    tagged.write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path).withColumn("_cw_pid", F.shiftright("_cw_mid", _LOW_BITS))
    before = Window.orderBy("_cw_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_cw_pid")
        .agg(F.count(F.lit(1)).alias("_cw_n"))
        .select("_cw_pid", F.coalesce(F.sum("_cw_n").over(before), F.lit(0)).alias("_cw_off"))
    )
    path = scratch_path(spark, "numbered_offsets")
    offsets.write.parquet(path)
    offsets = F.broadcast(spark.read.schema(offsets.schema).parquet(path))  # a row a partition
    start_col = start if isinstance(start, Column) else F.lit(start)
    local_pos = F.col("_cw_mid") - F.shiftleft(F.col("_cw_pid"), _LOW_BITS)
    return (
        stored.join(offsets, "_cw_pid")
        .withColumn(out_col, (F.col("_cw_off") + local_pos + start_col).cast("bigint"))
        .drop("_cw_mid", "_cw_pid", "_cw_off")
    )
