"""Row cleaning operators (F1-F25): DataFrame -> DataFrame, built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """drop 2nd and later copies of identical rows (NULLs compare equal)."""
    return df.dropDuplicates()


def blank_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """'' becomes NULL (whitespace is kept, as in the original)."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """keep rows with a value in every column of ``columns``."""
    return df.na.drop(how="any", subset=columns)


def normalize_domain(c: Column, domain: list[str], default: str = "unknown") -> Column:
    """lower-case; values outside ``domain`` (and NULL) become ``default``. No trim."""
    low = F.lower(c)
    return F.when(low.isin(domain), low).otherwise(F.lit(default))


def strip_literal(c: Column, literal: str) -> Column:
    """Remove every occurrence of ``literal`` (no regex)."""
    return F.replace(c, F.lit(literal), F.lit(""))


def keep_first_by(df: DataFrame, key: str | list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the first by ``order`` (first arrival wins).

    Written as a ``min_by`` aggregate rather than a ``row_number`` window:
    the aggregate combines map-side, so a key holding a third of all rows is
    reduced inside each input partition before the shuffle, instead of being
    sorted in one task. (With string columns in the row the buffer is
    variable-width and Spark runs it as a sort-based aggregate, partial step
    included; ``explain`` shows ``SortAggregate``.)
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order_cols)).alias("_cw_first"))
    return picked.select(*keys, *[F.col("_cw_first")[c].alias(c) for c in rest]).select(*df.columns)


def first_failing_reason(checks: list[tuple[str, Column]]) -> Column:
    """The first reason (in the given order) whose failure condition holds, else NULL.

    A NULL condition is treated as "not failed".
    """
    expr = None
    for reason, failed in checks:
        cond = F.coalesce(failed, F.lit(False))
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def split_by_reason(df: DataFrame, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with their reason) from one flagged frame."""
    return df.where(F.col(reason_col).isNull()).drop(reason_col), df.where(F.col(reason_col).isNotNull())


def shuffle_width(df: DataFrame) -> int:
    """Reducers of the session: as many as NULL keys can be spread over."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def spread_key_left(df: DataFrame, key: str, spread: int | None = None) -> list[Column]:
    """Join key pair (``_cw_k``, ``_cw_s``) for the probing side of a LEFT join.

    NULL keys never match, but a hash shuffle would still send every one of
    them to the same reducer. Non-NULL rows get (key, 0); NULL rows get
    (0, 1 + a hash of the row mod ``spread``), which spreads them over
    ``spread`` reducers (the session's shuffle width unless given) and matches nothing on the other side (whose spread is
    0). The hash is of the row's values, so a retried task routes every row
    as before.
    """
    spread = spread or shuffle_width(df)
    dtype = df.schema[key].dataType
    is_null = F.col(key).isNull()
    # map columns cannot be hashed; every other column takes part
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return [
        F.when(is_null, F.lit(0).cast(dtype)).otherwise(F.col(key)).alias("_cw_k"),
        F.when(is_null, 1 + F.pmod(F.xxhash64(*hashable), F.lit(spread))).otherwise(0).cast("int").alias("_cw_s"),
    ]


def spread_key_right(key: Column) -> list[Column]:
    """The matching pair for the build side (rows with a non-NULL key).

    Spread 0 is written as an expression of the key, not a literal: a literal
    would be folded into a join filter, dropping the spread column from the
    shuffle keys (seen in ``explain``)."""
    return [key.alias("_cw_k"), F.when(key.isNotNull(), F.lit(0)).alias("_cw_s")]


def mark_membership(
    df: DataFrame, catalog: DataFrame, key: str, flag: str, catalog_key: str | None = None,
    spread: int | None = None,
) -> DataFrame:
    """``df`` plus a boolean ``flag``: TRUE when ``key`` is in the catalog,
    NULL otherwise (NULL keys included). One left join to the de-duplicated
    catalog; no row is added or dropped. NULL is the most common key of a
    click stream's product column (page views), so NULL keys are spread over
    reducers (``spread_key_left``). The distinct runs on the key pair, so its
    shuffle already has the join's partitioning.
    """
    ck = catalog_key or key
    k = F.col(ck).cast(df.schema[key].dataType)
    marked = catalog.where(k.isNotNull()).select(*spread_key_right(k)).distinct().withColumn(flag, F.lit(True))
    keyed = df.select("*", *spread_key_left(df, key, spread))
    return keyed.join(marked, ["_cw_k", "_cw_s"], "left").drop("_cw_k", "_cw_s")


def null_or_member_of(df: DataFrame, catalog: DataFrame, key: str, catalog_key: str | None = None) -> DataFrame:
    """keep rows with NULL ``key`` or a ``key`` in the catalog, in one
    pass (``mark_membership``, then a filter on the mark)."""
    marked = mark_membership(df, catalog, key, "_cw_in", catalog_key)
    return marked.where(F.col(key).isNull() | F.col("_cw_in")).drop("_cw_in")
