"""As-of join by merging instead of comparing.

An equi join with a range residual compares every fact of a key with every
version of it. Here facts and versions are put into one order and the latest
version is carried forward to the facts behind it: work grows with the rows,
not with their product.

The order is cut into spans of time, so one key's facts are many groups. The
version valid at the start of a span is carried in as a row of its own: it is
found by the same merge over versions and spans alone, which has one row for
each span in which a key has facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dimensions import resolve_key
from .skew import heavy_keys

#: Length of a span of time.
SPAN_SECONDS = 30 * 86_400


def asof_merge(
    facts: DataFrame,
    versions: DataFrame,
    natural: str,
    ts: str,
    key: str,
    policy: str = "unknown_member",
    open_first: bool = True,
    span_seconds: int = SPAN_SECONDS,
) -> DataFrame:
    """The dimension version valid at each fact's time, as ``asof_version`` gives
    it, for versions of a key that do not overlap.

    Every fact stays; one without a version (no such key, a NULL key or time,
    a time outside all versions) gets ``policy``. With ``open_first`` the
    earliest version of a key also covers all earlier facts. Facts of a key
    and span that are more than a task's share are dealt over several groups,
    each with the span's versions.
    """
    span = lambda at: F.floor(F.unix_seconds(at) / span_seconds).cast("bigint")
    start = lambda number: F.timestamp_seconds(number * span_seconds)
    kind = facts.schema[natural].dataType
    carried = [c for c in versions.columns if c != natural]
    v = versions.where(F.col(natural).isNotNull()).select(
        F.col(natural).cast(kind).alias("_cw_k"), F.col("valid_from").cast("timestamp").alias("_cw_at"), F.struct(*carried).alias("_cw_v")
    )
    if open_first:
        first = v.groupBy("_cw_k").agg(F.min("_cw_at").alias("_cw_first"))
        early = F.lit("0001-01-01 00:00:00").cast("timestamp")
        v = v.join(first, "_cw_k").withColumn("_cw_at", F.when(F.col("_cw_at") == F.col("_cw_first"), early).otherwise(F.col("_cw_at")))
        v = v.drop("_cw_first")
    v = v.withColumn("_cw_span", span(F.col("_cw_at")))

    at = F.col(ts).cast("timestamp")
    placed = F.col(natural).isNotNull() & at.isNotNull()
    row = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    f = facts.where(placed).select(
        F.col(natural).alias("_cw_k"), span(at).alias("_cw_span"), at.alias("_cw_at"), row.alias("_cw_row")
    )
    f = f.withColumn("_cw_g", F.xxhash64("_cw_k", "_cw_span"))
    hot = F.broadcast(heavy_keys(f, "_cw_g"))  # as many rows as reducers at most
    dealt = f.join(hot, F.col("_cw_g") == F.col("_cw_hot"), "left").withColumn(
        "_cw_part", F.pmod(F.xxhash64("_cw_row"), F.coalesce("_cw_parts", F.lit(1))).cast("int")
    )
    spans = f.groupBy("_cw_k", "_cw_span", "_cw_g").agg(F.lit(1).alias("_cw_one")).drop("_cw_one")

    # what is valid when a span begins: versions and span starts in one order
    no_version = F.lit(None).cast(v.schema["_cw_v"].dataType)
    starts = spans.select("_cw_k", "_cw_span", "_cw_g", start(F.col("_cw_span")).alias("_cw_at"), no_version.alias("_cw_v"), F.lit(1).alias("_cw_kind"))
    known = v.select("_cw_k", "_cw_span", F.lit(None).cast("bigint").alias("_cw_g"), "_cw_at", "_cw_v", F.lit(0).alias("_cw_kind"))
    order = Window.partitionBy("_cw_k").orderBy("_cw_at", "_cw_kind").rowsBetween(Window.unboundedPreceding, 0)
    begun = known.unionByName(starts).withColumn("_cw_v", F.last("_cw_v", ignorenulls=True).over(order)).where("_cw_kind = 1")
    inside = v.where(F.col("_cw_at") > start(F.col("_cw_span"))).join(spans, ["_cw_k", "_cw_span"])
    cols = ["_cw_k", "_cw_span", "_cw_g", "_cw_at", "_cw_v"]
    events = begun.select(*cols).unionByName(inside.select(*cols)).join(hot, F.col("_cw_g") == F.col("_cw_hot"), "left")
    events = events.withColumn("_cw_part", F.explode(F.sequence(F.lit(0), F.coalesce("_cw_parts", F.lit(1)) - 1)))

    no_row = F.lit(None).cast(f.schema["_cw_row"].dataType)
    both = events.select("_cw_k", "_cw_span", "_cw_part", "_cw_at", "_cw_v", no_row.alias("_cw_row"), F.lit(0).alias("_cw_kind")).unionByName(
        dealt.select("_cw_k", "_cw_span", "_cw_part", "_cw_at", no_version.alias("_cw_v"), "_cw_row", F.lit(1).alias("_cw_kind"))
    )
    order = Window.partitionBy("_cw_k", "_cw_span", "_cw_part").orderBy("_cw_at", "_cw_kind").rowsBetween(Window.unboundedPreceding, 0)
    merged = both.withColumn("_cw_v", F.last("_cw_v", ignorenulls=True).over(order)).where("_cw_kind = 1")
    ended = F.col("_cw_v.valid_to").isNotNull() & (F.col("_cw_at") >= F.col("_cw_v.valid_to").cast("timestamp"))
    found = merged.select("_cw_row", F.when(~ended, F.col("_cw_v")).alias("_cw_v"))
    rest = facts.where(~placed).select(row.alias("_cw_row"), no_version.alias("_cw_v"))
    out = found.unionByName(rest).select("_cw_row.*", *[F.col(f"_cw_v.{c}").alias(c) for c in carried])
    return out.withColumn(key, resolve_key(F.col(key), key, natural, policy))
