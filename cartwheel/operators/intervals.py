"""Type 2 history from snapshots in any order.

A merge that closes and opens versions at the newest date cannot take a
snapshot that arrives late. Here the history is kept as runs: (key, values,
first_seen, last_seen), the longest stretches of consecutive snapshots that
show a key with the same values; last_seen is NULL while the newest snapshot
still shows them. A snapshot for a date between two others cuts the runs
around that date, puts what it saw in between, and joins what is equal again.
The runs are the same for every order of arrival, and so is the history that
is read from them. Only keys whose runs change are written; a snapshot that
is sent again for its date replaces what it said before.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks.snapshot import BucketedTable
from .dimensions import unique_or_fail


class SnapshotHistory:
    """The history of ``tracked`` columns by ``natural`` key at ``root``.

    A key that is missing from a snapshot keeps its last values (its run ends,
    its version goes on). NULL values are values; rows with a NULL key are
    left out; two rows for one key in a snapshot fail."""

    def __init__(self, spark: SparkSession, root: str, natural: str, tracked: list[str], buckets: int | None = None):
        self.spark, self.natural, self.tracked = spark, natural, tracked
        self.runs = BucketedTable(spark, f"{root}/runs", natural, buckets)

    def dates(self) -> list[dt.date]:
        """The snapshots that were taken in, in order of their dates."""
        return sorted(dt.date.fromisoformat(t) for t in self.runs.tags())

    def apply(self, snapshot: DataFrame, as_of: dt.date) -> dict:
        """Takes in the snapshot of ``as_of``; returns how many buckets were written."""
        known = [d for d in self.dates() if d != as_of]
        before = max((d for d in known if d < as_of), default=None)
        after = min((d for d in known if d > as_of), default=None)
        day = lambda d: F.lit(d).cast("date")
        nat = self.natural
        seen = unique_or_fail(snapshot.where(F.col(nat).isNotNull()).select(nat, *self.tracked), nat, "snapshot")
        seen = seen.select(nat, F.struct(*self.tracked).alias("mid"))
        old = self.runs.read()
        if old is None:
            last = day(as_of) if after else F.lit(None).cast("date")
            rows = seen.select(nat, "mid.*", day(as_of).alias("first_seen"), last.alias("last_seen"))
            return self.runs.replace(seen.select(nat), rows, tag=as_of.isoformat())

        def holds(date: dt.date | None) -> Column:
            if date is None:
                return F.lit(False)
            return (F.col("first_seen") <= day(date)) & (F.col("last_seen").isNull() | (F.col("last_seen") >= day(date)))

        run = F.struct(F.struct(*self.tracked).alias("is"), "first_seen", "last_seen")
        near = old.where(holds(before) | holds(as_of) | holds(after))
        # one run at most holds each of the three dates
        around = near.groupBy(nat).agg(
            F.max(F.when(holds(before), run)).alias("left"), F.max(F.when(holds(as_of), run)).alias("here"),
            F.max(F.when(holds(after), run)).alias("right"),
        )
        j = around.join(seen, nat, "full_outer")
        left, right, mid = F.col("left"), F.col("right"), F.col("mid")
        joins_left = left.isNotNull() & mid.isNotNull() & left["is"].eqNullSafe(mid)
        joins_right = right.isNotNull() & mid.isNotNull() & right["is"].eqNullSafe(mid)
        newest = F.lit(None).cast("date")
        ends = right["last_seen"] if after else newest
        piece = lambda values, first, last: F.struct(values.alias("is"), first.alias("first_seen"), last.alias("last_seen"))
        new = F.filter(
            F.array(
                F.when(left.isNotNull() & ~joins_left, piece(left["is"], left["first_seen"], day(before))),
                F.when(
                    mid.isNotNull(),
                    piece(
                        mid,
                        F.when(joins_left, left["first_seen"]).otherwise(day(as_of)),
                        F.when(joins_right, ends).otherwise(day(as_of) if after else newest),
                    ),
                ),
                F.when(right.isNotNull() & ~joins_right, piece(right["is"], day(after), ends)),
            ),
            lambda r: r.isNotNull(),
        )
        was = F.array_distinct(F.filter(F.array(left, F.col("here"), right), lambda r: r.isNotNull()))
        j = j.withColumn("new", new).where(~F.col("new").eqNullSafe(was))  # the other keys' runs stay where they are
        made = j.select(nat, F.explode("new").alias("r")).select(nat, "r.is.*", "r.first_seen", "r.last_seen")
        keys = j.select(nat)
        rest = old.where(~(holds(before) | holds(as_of) | holds(after))).join(keys, nat, "left_semi")
        return self.runs.replace(keys, made.unionByName(rest.select(made.columns)), tag=as_of.isoformat())

    def versions(self) -> DataFrame:
        """natural, tracked, valid_from, valid_to (NULL: current), is_current: runs
        with equal values that follow each other are one version."""
        runs = self.runs.read()
        order = Window.partitionBy(self.natural).orderBy("first_seen")
        values = F.struct(*self.tracked)
        starts = runs.withColumn("_cw_before", F.lag(F.struct(values.alias("is"))).over(order))
        starts = starts.where(~F.col("_cw_before.is").eqNullSafe(values) | F.col("_cw_before").isNull())
        until = F.lead("first_seen").over(order)
        return starts.select(
            self.natural, *self.tracked, F.col("first_seen").alias("valid_from"), until.alias("valid_to"),
            until.isNull().cast("int").alias("is_current"),
        )
