"""Dimensional operators: key lookup (J12), promotion bucket (D5), type 2
merge (D9) and the as-of version join (J16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cleaning import spread_key_left, spread_key_right
from ..session import scratch_path
from .numbering import dense_row_number

UNKNOWN_MEMBER = -1


def unique_or_fail(df: DataFrame, key: str, what: str) -> DataFrame:
    """``df``, failing while it is read if two rows share a (non-NULL) ``key``.

    The count is a window over the key, whose partitioning a join on that key
    reuses, so a duplicated natural key stops the job instead of silently
    multiplying facts."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    message = F.concat(F.lit(f"{what}: more than one row for {key}="), F.col(key).cast("string"))
    guarded = F.when((n > 1) & F.col(key).isNotNull(), F.raise_error(message).cast(df.schema[key].dataType))
    return df.withColumn(key, guarded.otherwise(F.col(key)))


def resolve_key(found: Column, key: str, natural: str, policy: str) -> Column:
    """The surrogate key a lookup found, or what ``policy`` says when it found none."""
    if policy == "fail":
        value = F.coalesce(F.col(natural).cast("string"), F.lit("NULL"))
        message = F.concat(F.lit(f"no {key} for {natural}="), value)
        return F.when(found.isNull(), F.raise_error(message).cast("bigint")).otherwise(found.cast("bigint"))
    if policy == "unknown_member":
        return F.coalesce(found.cast("bigint"), F.lit(UNKNOWN_MEMBER).cast("bigint"))
    raise ValueError(policy)


def lookup_key(
    facts: DataFrame, dim: DataFrame, natural: str, dim_natural: str, key: str, policy: str = "fail", small: bool = False
) -> DataFrame:
    """Natural -> surrogate key by a join with the dimension.

    ``policy='fail'`` stops the job when a natural key has no dimension row
    (the check runs inside the plan with ``raise_error``, no extra pass);
    ``'unknown_member'`` maps it to -1. A dimension with two rows for one
    natural key fails. No size hint: adaptive execution broadcasts a dimension
    it has measured as small; otherwise NULL natural keys (unknown members)
    are spread over the reducers instead of all hashing to one. ``small`` is
    for a dimension of a fixed list: it is broadcast, and the facts, which would
    meet in as many reducers as it has rows, stay where they are.
    """
    nat = F.col(dim_natural).cast(facts.schema[natural].dataType)
    d = dim.where(nat.isNotNull()).select(nat.alias("_cw_nat"), F.col(key).alias("_cw_key"))
    d = unique_or_fail(d, "_cw_nat", f"dimension of {key}")
    if small:
        joined = facts.join(F.broadcast(d), facts[natural] == d["_cw_nat"], "left").drop("_cw_nat")
        return joined.withColumn(key, resolve_key(F.col("_cw_key"), key, natural, policy)).drop("_cw_key")
    d = d.select(*spread_key_right(F.col("_cw_nat")), "_cw_key")
    joined = facts.select("*", *spread_key_left(facts, natural)).join(d, ["_cw_k", "_cw_s"], "left").drop("_cw_k", "_cw_s")
    return joined.withColumn(key, resolve_key(F.col("_cw_key"), key, natural, policy)).drop("_cw_key")


def promotion_bucket(order_id: Column, rate_per_2_32: int = 644245094, n_promotions: int = 3) -> Column:
    """Deterministic ~15% of orders get promotion 1..3, others 0.

    Multiplicative hash h = ((id + 1) * 2654435761) mod 2^32, computed in
    16-bit halves so the product never overflows BIGINT for any id; an order
    is promoted when h < 0.15 * 2^32, and gets promotion 1 + h mod 3.
    """
    a = (order_id + 1) % F.lit(4294967296)
    lo, hi = 31153, 40503  # 2654435761 = 40503 * 65536 + 31153
    h = (a * lo + ((a * hi) % 65536) * 65536) % F.lit(4294967296)
    return F.when(h < rate_per_2_32, 1 + h % n_promotions).otherwise(0).cast("bigint")


def scd2_merge(
    dim: DataFrame,
    source: DataFrame,
    natural: str,
    tracked: list[str],
    as_of: Column,
    key: str,
) -> DataFrame:
    """Type 2 merge of a source snapshot into a versioned dimension.

    Current versions are full-outer-joined to the source on the natural key
    and the tracked columns compared NULL-safely: unchanged rows stay; changed
    ones are closed (``valid_to = as_of``, ``is_current = 0``) and a new
    current version opens at ``as_of``; unseen keys get their first version;
    keys missing from the source stay as they are. Closed history is copied.

    Tracked columns only decide whether a version opens. A new version takes
    every column the source has from the source, and the others from the
    version it closes (NULL for an unseen key). New surrogate keys continue
    after the current maximum (parallel numbering). A source with two rows
    for one natural key fails. The compared rows are written once and read by
    every branch.
    """
    own = {key, "valid_from", "valid_to", "is_current"}
    given = [c for c in dim.columns if c in source.columns and c not in own]
    hist = dim.where(F.col("is_current") == 0)
    cur = dim.where(F.col("is_current") == 1)
    src = unique_or_fail(source.select(*given), natural, "source").select(*[F.col(c).alias(f"_s_{c}") for c in given])
    j = cur.join(src, cur[natural] == src[f"_s_{natural}"], "full_outer")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    both = F.col(natural).isNotNull() & F.col(f"_s_{natural}").isNotNull()
    # the compared rows feed three branches, one of them (new keys) in its
    # own job: written once, so the full outer join runs once
    path = scratch_path(dim.sparkSession, "scd2")
    j.withColumn("_changed", both & ~same).write.parquet(path)
    j = dim.sparkSession.read.parquet(path)
    dim_cols = dim.columns
    kept = j.where(F.col(natural).isNotNull() & ~F.col("_changed")).select(*dim_cols)
    closed = (
        j.where(F.col("_changed"))
        .withColumn("valid_to", as_of.cast("date"))
        .withColumn("is_current", F.lit(0))
        .select(*dim_cols)
    )
    opened = j.where(F.col("_changed") | F.col(natural).isNull()).select(
        *[F.col(f"_s_{c}").alias(c) if c in given else F.col(c) for c in dim_cols if c not in own]
    )
    max_key = dim.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    fresh = dense_row_number(opened, [natural], key, start=max_key + 1).withColumns(
        {
            "valid_from": as_of.cast("date"),
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(1),
        }
    )
    out = hist.unionByName(kept).unionByName(closed).unionByName(fresh.select(*dim_cols))
    return out.withColumn("is_current", F.col("is_current").cast("int"))


def asof_version(
    facts: DataFrame,
    versions: DataFrame,
    natural: str,
    ts: str,
    key: str,
    policy: str = "unknown_member",
    open_first: bool = True,
) -> DataFrame:
    """Attach the dimension version valid at the fact's time.

    Left join on the natural key plus the range ``valid_from <= ts <
    valid_to`` (open end when NULL), so the join stays a hash/sort-merge join
    with a residual filter and no fact is lost: one without a version (NULL or
    unknown natural key) gets ``policy`` as in :func:`lookup_key`, -1 or a
    failure. With ``open_first`` the earliest version of each key also covers
    all earlier facts.
    """
    if open_first:
        first = versions.groupBy(natural).agg(F.min("valid_from").alias("_first_from"))
        v = versions.join(first, natural).withColumn(
            "_from", F.when(F.col("valid_from") != F.col("_first_from"), F.col("valid_from"))
        ).drop("_first_from")
    else:
        v = versions.withColumn("_from", F.col("valid_from"))
    nat = F.col(natural).cast(facts.schema[natural].dataType)
    v = v.where(nat.isNotNull()).select("*", *spread_key_right(nat)).drop(natural)
    f = facts.select("*", *spread_key_left(facts, natural))
    cond = (
        (f["_cw_k"] == v["_cw_k"])
        & (f["_cw_s"] == v["_cw_s"])
        & (v["_from"].isNull() | (f[ts] >= v["_from"]))
        & (v["valid_to"].isNull() | (f[ts] < v["valid_to"]))
    )
    joined = f.join(v, cond, "left").drop("_cw_k", "_cw_s", "_from")
    return joined.withColumn(key, resolve_key(F.col(key), key, natural, policy))


def attach_calendar(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """The calendar's columns by ``date_key``; a day the calendar does not
    cover fails instead of dropping its facts."""
    others = [c for c in calendar.columns if c != "date_key"]
    joined = facts.join(calendar.withColumn("_cw_day", F.lit(True)), "date_key", "left")
    message = F.concat(F.lit("the calendar has no day "), F.coalesce(F.col("date_key").cast("string"), F.lit("NULL")))
    checked = F.when(F.col("_cw_day").isNull(), F.raise_error(message).cast("bigint")).otherwise(F.col("date_key"))
    return joined.select(checked.alias("date_key"), *[c for c in facts.columns if c != "date_key"], *others)
