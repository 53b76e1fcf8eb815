"""Upsert by key into a Parquet table kept as versioned snapshots (K6).

Plain Parquet tables cannot ``MERGE``; and a path must never be overwritten
while it is being read. Each upsert therefore writes the merged table as a
new version directory ``v=NNNNNN`` and marks it committed; readers take the
newest committed version, so a failed write leaves the previous one current.
Versions older than the last ``keep`` are removed after the commit, the
staging copy too. With a table format that supports it, ``MERGE INTO``
replaces this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sinks.commit import commit, committed_children, remove


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[2:]) for n in committed_children(spark, root, "v=") if n[2:].isdigit())


def current_version(spark: SparkSession, root: str) -> int | None:
    v = _versions(spark, root)
    return v[-1] if v else None


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    v = current_version(spark, root)
    return None if v is None else spark.read.parquet(f"{root}/v={v:06d}")


def write_version(spark: SparkSession, root: str, df: DataFrame) -> DataFrame:
    """``df`` as the next committed version (an uncommitted attempt of that number is replaced)."""
    path = f"{root}/v={(current_version(spark, root) or 0) + 1:06d}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(commit(spark, path))


def upsert(spark: SparkSession, root: str, src: DataFrame, key: str | list[str], keep: int = 2) -> DataFrame:
    """INSERT OR REPLACE semantics: rows of ``src`` replace target rows with the
    same key; other target rows stay. ``src`` must be unique on ``key``.

    ``src`` is staged as Parquet first (``_staging/``, not a version), so the
    batch is computed once although the merge reads it twice (its keys for
    the anti join, its rows for the union). Both sides are shuffled once on
    the key; no row is collected.
    """
    keys = [key] if isinstance(key, str) else list(key)
    current = read_current(spark, root)
    staged_path = f"{root}/_staging/{(current_version(spark, root) or 0) + 1:06d}"
    src.write.mode("overwrite").parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    merged = staged if current is None else current.join(staged.select(*keys), keys, "left_anti").unionByName(staged)
    out = write_version(spark, root, merged)
    remove(spark, staged_path)
    for old in _versions(spark, root)[:-keep]:
        remove(spark, f"{root}/v={old:06d}")
    return out
