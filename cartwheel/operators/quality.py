"""Profiling (P1-P6) and constraint checks.

Every profile is one aggregation pass producing a small DataFrame; nothing
is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pct


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def column_profile(df: DataFrame) -> DataFrame:
    """P2 + P3: (column_name, data_type, null_count), from a single scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    long = counts.unpivot([], df.columns, "column_name", "null_count")
    mapping = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return long.select("column_name", mapping[F.col("column_name")].alias("data_type"), F.col("null_count").cast("bigint"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of 2nd and later copies of identical rows."""
    grouped = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return grouped.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """P5: value counts including NULL, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def removal_summary(n_before: Column, n_after: Column) -> list[Column]:
    """Rows before/after/removed and the removed percentage (NULL on empty input)."""
    return [
        n_before.cast("bigint").alias("rows_before"),
        n_after.cast("bigint").alias("rows_after"),
        (n_before - n_after).cast("bigint").alias("rows_removed"),
        pct(n_before - n_after, n_before).alias("removed_pct"),
    ]


# ------------------------------------------------------------- constraints


@dataclass
class TableRules:
    """Declared constraints of one table (C1-C4); checks are data, not code."""

    name: str
    not_null: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)
    checks: dict[str, Column] = field(default_factory=dict)  # rule name -> condition that must hold
    foreign_keys: list[tuple[str, str, str]] = field(default_factory=list)  # (column, parent table, parent column)


def check_table(df: DataFrame, rules: TableRules, parents: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, violations) rows for one table.

    The NOT NULL and CHECK counts are one pass without groups. Each unique key
    groups its own columns only: about every row is a group of its own, so a
    group that carried the counts would hold the table in hash tables. The map
    side reduces a hot key. A CHECK that evaluates to NULL passes, as in SQL;
    UNIQUE counts rows beyond the first per non-NULL key. A foreign key counts
    non-NULL child keys missing from the parent: the child keys are counted
    first (one row per key and map task), then anti-joined.
    """
    counted = [(f"not_null({c})", F.col(c).isNull()) for c in rules.not_null]
    counted += [(f"check({name})", ~cond) for name, cond in rules.checks.items()]
    names = [name for name, _ in counted]
    sums = [F.count_if(cond).alias(f"r{i}") for i, (_, cond) in enumerate(counted)]
    rule = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").cast("bigint").alias("violations")) for i, name in enumerate(names)
    ]
    parts = [df.agg(*sums).select(F.explode(F.array(*rule)).alias("x")).select("x.rule", "x.violations")] if rule else []
    for i, key in enumerate(rules.unique):
        whole = " AND ".join(f"`{c}` IS NOT NULL" for c in key)
        keyed = df.where(whole) if i == 0 else df.na.drop(subset=key)
        dup = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        many = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("violations")
        parts.append(dup.agg(many).select(F.lit(f"unique({','.join(key)})").alias("rule"), "violations"))
    for col, parent, pcol in rules.foreign_keys:
        pk = parents[parent].select(F.col(pcol).alias(col))
        keyed = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        lost = keyed.join(pk, col, "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations"))
        parts.append(lost.select(F.lit(f"fk({col}->{parent}.{pcol})").alias("rule"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(rules.name).alias("table_name"), "rule", "violations")


def apply_defaults(df: DataFrame, defaults: dict[str, Column | object]) -> DataFrame:
    """Column defaults at write time (NULL or missing column -> default)."""
    out = df
    for c, v in defaults.items():
        val = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), val) if c in df.columns else val)
    return out
