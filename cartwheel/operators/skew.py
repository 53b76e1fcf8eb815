"""Joins with hot keys.

A shuffled join sends all rows of one key to one task: a customer with a third
of the orders makes one task a third of the job. ``heavy_keys`` finds such
keys with one pass of a frequent-items sketch over the key column, and
``skew_join`` deals each of them over as many tasks as its share of the rows
is worth: its rows get a part number, and the other side's rows of that key
are repeated once for each part. All other keys join as before, in the same
join, with part 0; NULL keys of the kept side match nothing and are spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cleaning import shuffle_width

#: Counters of the sketch for each reducer: its error stays far below a reducer's share.
COUNTERS = 16


def heavy_keys(df: DataFrame, key: str, width: int | None = None) -> DataFrame:
    """(key, parts) of the keys that hold more than one of ``width`` equal shares
    of the rows (the session's shuffle width), with how many shares they hold.

    At most ``width`` keys can; they and their parts are a local table. The
    sketch is combined map-side, so the pass moves ``width`` x COUNTERS items
    a task."""
    width = width or shuffle_width(df)
    k = F.col(key)
    found = df.where(k.isNotNull()).agg(
        F.call_function("approx_top_k", k, F.lit(width), F.lit(COUNTERS * max(width, 64))).alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    share = max(1, found["n"] / width)
    rows = [(t["item"], int(-(-t["count"] // share))) for t in found["top"] or [] if t["count"] > share]
    schema = T.StructType([T.StructField("_cw_hot", df.schema[key].dataType), T.StructField("_cw_parts", T.IntegerType())])
    return df.sparkSession.createDataFrame(rows, schema)


def skew_join(
    facts: DataFrame, other: DataFrame, key: str, how: str = "inner", heavy: DataFrame | None = None, width: int | None = None
) -> DataFrame:
    """``facts JOIN other USING (key)``, ``how`` inner or left, with hot keys dealt
    over several tasks. ``heavy`` is what ``heavy_keys`` returned, if it is known
    already. Rows and columns are those of the plain join; ``other`` may have
    several rows for a key."""
    if how not in ("inner", "left"):
        raise ValueError(how)
    width = width or shuffle_width(facts)
    hot = heavy if heavy is not None else heavy_keys(facts, key, width)
    # at most `width` rows of a key and a number: small whatever the data
    hot = F.broadcast(hot)
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in facts.schema if not isinstance(f.dataType, T.MapType)])
    parts = F.when(F.col(key).isNull(), F.lit(width)).otherwise(F.coalesce("_cw_parts", F.lit(1)))
    left = facts.join(hot, F.col(key).eqNullSafe(F.col("_cw_hot")), "left").withColumn("_cw_part", F.pmod(row, parts).cast("int"))
    left = left.drop("_cw_hot", "_cw_parts")
    same = other.where(F.col(key).isNotNull()).withColumn(key, F.col(key).cast(facts.schema[key].dataType))
    repeated = same.join(hot, F.col(key) == F.col("_cw_hot"), "left").withColumn(
        "_cw_part", F.explode(F.sequence(F.lit(0), F.coalesce("_cw_parts", F.lit(1)) - 1))
    )
    return left.join(repeated.drop("_cw_hot", "_cw_parts"), [key, "_cw_part"], how).drop("_cw_part")
