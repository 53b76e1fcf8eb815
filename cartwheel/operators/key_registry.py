"""Surrogate keys that stay.

Numbering a refreshed table anew moves the keys of every row behind an
inserted one, and facts that were loaded before point to the wrong member. The
registry keeps which natural key has which surrogate key. A load looks its
keys up in the buckets they fall into; those that are new get one block of
numbers behind the last one given, in the order of the natural key, by the
parallel numbering. Given keys are never changed or given again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.snapshot import BUCKET, BucketedTable
from .dimensions import UNKNOWN_MEMBER
from .numbering import dense_row_number


class KeyRegistry:
    """Surrogate ``key`` by ``natural`` columns, at ``root``."""

    def __init__(self, spark: SparkSession, root: str, natural: str | list[str], key: str, buckets: int | None = None):
        self.spark, self.key = spark, key
        self.table = BucketedTable(spark, root, natural, buckets)
        self.natural = self.table.keys

    def register(self, df: DataFrame, load: str) -> int:
        """Gives every natural key of ``df`` that has none yet a number; returns how
        many were given. ``load`` names the load: a load that was committed is
        not registered again. Keys with a NULL column have no number."""
        if load in self.table.tags():
            return 0
        asked = df.select(*self.natural).na.drop("any").distinct()
        path = scratch_path(self.spark, "registry")
        self.table.with_bucket(asked).write.partitionBy(BUCKET).parquet(path)
        asked = self.spark.read.parquet(path)
        known = self.table.read(self.table.buckets_in(asked))
        new = asked.drop(BUCKET)
        if known is not None:
            new = new.join(known.select(*self.natural), self.natural, "left_anti")
        # every number up to the registry's rows is given: its manifest says where to go on
        block = self.table.rows()
        self.table.append(dense_row_number(new, self.natural, self.key, start=block + 1, rows=asked.count()), tag=load)
        return self.table.rows() - block

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with its surrogate key, -1 where there is none."""
        known = self.table.read()
        if known is None:
            return df.withColumn(self.key, F.lit(UNKNOWN_MEMBER).cast("bigint"))
        found = df.join(known, self.natural, "left")
        return found.withColumn(self.key, F.coalesce(self.key, F.lit(UNKNOWN_MEMBER)).cast("bigint"))
