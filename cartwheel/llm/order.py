"""Running totals over a global order without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import saved


def running_start(df: DataFrame, keys: list[str | Column], n: str, into: str, name: str) -> DataFrame:
    """``df`` with ``into``: the sum of ``n`` over all rows before this one in
    the order of ``keys`` (which must tell rows apart).

    The rows are range-partitioned and written; totals per range (one row per
    partition) give the offsets, a window inside each range the rest.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id())
    kept = saved(ranged, name)
    totals = kept.groupBy("_range").agg(F.sum(n).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    out = kept.withColumn("_inside", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    # one row per range partition
    out = out.join(offsets, "_range").withColumn(into, (F.col("_offset") + F.col("_inside")).cast("bigint"))
    return out.drop("_range", "_inside", "_offset")
