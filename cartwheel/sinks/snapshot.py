"""A keyed Parquet table in hash buckets, versioned by a manifest.

The rows live in ``data/v=NNNNNN/_cw_bucket=K`` directories and are never
changed. A version is a manifest: the list of directories that make it up.
An upsert reads and writes only the buckets its keys fall into and names the
untouched directories again, so the cost of a load follows the load, not the
table. A manifest becomes current with our commit marker after its data is
written; a failed load leaves the earlier version current.

Keys are placed by hash unless ``place`` says otherwise: a range of the key
(``order_id div 1000000``) keeps loads of recent keys in few buckets.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .commit import commit, committed_children, read_text, remove, write_text

BUCKET = "_cw_bucket"
_MANIFEST = "manifest.json"


class BucketedTable:
    """``keys`` decide the bucket; ``buckets`` holds for a new table only (the
    session's shuffle width unless given), a stored table keeps its own number.
    With ``place`` (the key's columns to a bucket number) the number is open."""

    def __init__(
        self, spark: SparkSession, root: str, keys: str | list[str], buckets: int | None = None,
        place: Callable[[], Column] | None = None, keep: int = 2,
    ):
        self.spark, self.root, self.place, self.keep = spark, root.rstrip("/"), place, keep
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self._seen: dict[int, list] = {}
        found = self._current()
        self.buckets = found["buckets"] if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # ---------------------------------------------------------------- versions

    def versions(self) -> list[int]:
        return sorted(int(n[2:]) for n in committed_children(self.spark, f"{self.root}/manifest", "v="))

    def _current(self, version: int | None = None) -> dict | None:
        """The manifest of a version (the newest): buckets, schema, and the rows
        (bucket, path, rows, tag): one for each directory (at most buckets x
        parts) and one, without a directory, for each tag. A version never
        changes, so its file is read once."""
        if version is None:
            found = self.versions()
            if not found:
                return None
            version = found[-1]
        if version not in self._seen:
            self._seen[version] = json.loads(read_text(self.spark, f"{self.root}/manifest/v={version:06d}/{_MANIFEST}"))
        return self._seen[version]

    def manifest(self, version: int | None = None) -> list[dict]:
        found = self._current(version)
        names = ("bucket", "path", "rows", "tag")
        return [dict(zip(names, r)) for r in found["rows"]] if found else []

    def _parts(self) -> list:
        return [r for r in self.manifest() if r["path"] is not None]

    def entries(self) -> DataFrame:
        """The current version's directories as a frame: bucket, path, rows."""
        rows = [(r["bucket"], r["path"], r["rows"]) for r in self._parts()]
        return self.spark.createDataFrame(rows, "bucket bigint, path string, rows bigint")

    def rows(self) -> int:
        """Rows of the current version, from its manifest."""
        return sum(r["rows"] for r in self._parts())

    def tags(self) -> set[str]:
        """Names of the appended batches."""
        return {r["tag"] for r in self.manifest() if r["tag"] is not None}

    def schema(self) -> T.StructType | None:
        found = self._current()
        return T.StructType.fromJson(found["schema"]) if found else None

    def _next(self) -> int:
        return (self.versions() or [0])[-1] + 1

    def _publish(self, version: int, rows: list, schema: T.StructType) -> None:
        """Commits a manifest of (bucket, path, rows, tag) rows, then drops what no kept version names."""
        path = f"{self.root}/manifest/v={version:06d}"
        write_text(self.spark, f"{path}/{_MANIFEST}", json.dumps({"buckets": self.buckets, "schema": schema.jsonValue(), "rows": rows}))
        commit(self.spark, path)
        found = self.versions()
        old, kept = found[: -self.keep], found[-self.keep :]
        paths = lambda vs: {r["path"] for v in vs for r in self.manifest(v) if r["path"] is not None}
        for p in paths(old) - paths(kept) if old else ():
            remove(self.spark, f"{self.root}/{p}")
        for v in old:
            remove(self.spark, f"{self.root}/manifest/v={v:06d}")

    # ---------------------------------------------------------------- reading

    def bucket_of(self) -> Column:
        placed = self.place() if self.place else F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))
        return placed.cast("bigint")

    def with_bucket(self, df: DataFrame) -> DataFrame:
        """``df`` with its bucket; columns take the table's types first, so equal keys meet."""
        kinds = {f.name: f.dataType for f in self.schema() or []}
        change = {f.name: F.col(f"`{f.name}`").cast(kinds[f.name]) for f in df.schema if f.dataType != kinds.get(f.name, f.dataType)}
        return (df.withColumns(change) if change else df).withColumn(BUCKET, self.bucket_of())

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The current rows, or those of the named buckets: other buckets' files
        are not in the scan. None when there is no row to read."""
        wanted = None if buckets is None else set(buckets)
        paths = [f"{self.root}/{r['path']}" for r in self._parts() if wanted is None or r["bucket"] in wanted]
        return self.spark.read.schema(self.schema()).parquet(*paths) if paths else None

    @staticmethod
    def buckets_in(df: DataFrame) -> list[int]:
        """The buckets a frame with a bucket column touches (as many numbers as buckets at most)."""
        return sorted(r[0] for r in df.select(BUCKET).distinct().collect())

    # ---------------------------------------------------------------- writing

    def _write(self, df: DataFrame, version: int) -> list:
        """Writes rows with a bucket column as this version's directories; their manifest rows."""
        base = f"data/v={version:06d}"
        path = f"{self.root}/{base}"
        df.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        # only the partition column is asked for, so this reads footers
        written = self.spark.read.schema(f"{BUCKET} bigint").parquet(path).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))
        return [(r[BUCKET], f"{base}/{BUCKET}={r[BUCKET]}", r["n"], None) for r in written.collect()]

    def _staged(self, src: DataFrame) -> DataFrame:
        """The batch with its buckets, computed once."""
        keyed = self.with_bucket(src)
        path = scratch_path(self.spark, "staged")
        keyed.write.parquet(path)
        return self.spark.read.schema(keyed.schema).parquet(path)

    @staticmethod
    def _plain(df: DataFrame) -> T.StructType:
        return df.drop(BUCKET).schema

    def _held(self) -> list:
        return [(r["bucket"], r["path"], r["rows"], r["tag"]) for r in self.manifest() if r["path"] or r["tag"]]

    def _replace(self, touched: list[int], df: DataFrame, tag: str | None = None) -> None:
        version = self._next()
        kept = [r for r in self._held() if r[1] is None or r[0] not in set(touched)]
        mark = [] if tag is None or tag in self.tags() else [(None, None, 0, tag)]
        new = self._write(df, version) if touched else []
        self._publish(version, kept + new + mark, self._plain(df))

    def upsert(self, src: DataFrame) -> dict:
        """INSERT OR REPLACE: rows of ``src`` (unique on the keys) replace rows with
        the same keys. Only buckets with a key of ``src`` are read and written. A
        NULL key equals no other. An empty ``src`` changes nothing."""
        staged = self._staged(src)
        touched = self.buckets_in(staged)
        if not touched:
            return {"touched": 0}
        self._merge(touched, staged.select(*self.keys), staged, None)
        return {"touched": len(touched)}

    def replace(self, keys: DataFrame, rows: DataFrame, tag: str | None = None) -> dict:
        """``rows`` (all with one of ``keys``, any number for each) instead of the
        stored rows of ``keys``. ``tag`` is entered in the manifest, also when no
        row changes."""
        gone = self._staged(keys.select(*self.keys).distinct())
        touched = self.buckets_in(gone)
        if touched or tag is not None and tag not in self.tags():
            self._merge(touched, gone.select(*self.keys), self.with_bucket(rows), tag)
        return {"touched": len(touched)}

    def rewrite(self, buckets: list[int], rows: DataFrame, tag: str | None = None) -> None:
        """``rows`` instead of everything in ``buckets`` (and all of them belong there)."""
        self._replace([int(b) for b in buckets], self.with_bucket(rows), tag)

    def _merge(self, touched: list[int], gone: DataFrame, staged: DataFrame, tag: str | None) -> None:
        old = self.read(touched)
        merged = staged
        if old is not None:
            rest = self.with_bucket(old).join(gone, self.keys, "left_anti")
            merged = rest.unionByName(staged, allowMissingColumns=True)
        self._replace(touched, merged, tag)

    def append(self, src: DataFrame, tag: str | None = None) -> dict:
        """Adds rows as further parts of their buckets: nothing stored is read or
        written again. ``tag`` names the batch in the manifest (see ``tags``)."""
        version = self._next()
        keyed = self.with_bucket(src)
        mark = [] if tag is None else [(None, None, 0, tag)]
        schema = self.schema() or self._plain(keyed)
        self._publish(version, self._held() + self._write(keyed, version) + mark, schema)
        return {"version": version}

    def delete_where(self, condition: Column, forget_tag: str | None = None) -> None:
        """Rewrites the buckets that hold a row with ``condition`` without those rows."""
        rows = self.read()
        if rows is not None:
            touched = self.buckets_in(self.with_bucket(rows.where(condition)))
            if touched:
                stay = self.read(touched).where(~F.coalesce(condition, F.lit(False)))
                self._replace(touched, self.with_bucket(stay))
        if forget_tag in self.tags():
            self._publish(self._next(), [r for r in self._held() if r[3] != forget_tag], self.schema())

    def compact(self, max_parts: int = 8, combine: Callable[[DataFrame], DataFrame] | None = None) -> list[int]:
        """Writes buckets of more than ``max_parts`` directories as one (their rows
        through ``combine``, if given); returns them."""
        parts: dict[int, int] = {}
        for r in self._parts():
            parts[r["bucket"]] = parts.get(r["bucket"], 0) + 1
        touched = sorted(b for b, n in parts.items() if n > max_parts)
        if touched:
            rows = self.read(touched)
            self._replace(touched, self.with_bucket(combine(rows) if combine else rows))
        return touched

    def rebucket(self, buckets: int) -> None:
        """Writes the whole table with another number of buckets (for a table that outgrew its own)."""
        rows = self.read()
        self.buckets = buckets
        if rows is not None:
            version = self._next()
            tags = [r for r in self._held() if r[1] is None]
            keyed = self.with_bucket(rows)
            self._publish(version, tags + self._write(keyed, version), self._plain(keyed))
