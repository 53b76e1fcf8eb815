"""Written intermediate tables in the shared checkpoint folder.

Used to cut lineage and to reuse an expensive derived table (for example the
numbered order items) across the queries of one application. The table is
written once per (application, key) and read back, so every later plan
starts from a Parquet scan with pruning and pushdown. ``refresh`` rebuilds it.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from .commit import commit, committed_children, read_text, remove, write_text

_FRAMES: dict[tuple[str, str, int], DataFrame] = {}
_SETS: dict[tuple[str, str, int], dict[str, DataFrame]] = {}
#: Seconds each table took to build, by key, for the benchmark.
BUILD_SECONDS: dict[str, float] = {}


def materialized(
    spark: SparkSession, key: str, build, fmt: str = "parquet", schema=None, refresh: bool = False, stored: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The table for ``key``: built and written the first time, or again with ``refresh``.

    Every build goes to a new path and is used only when its write has
    returned, so a failed rebuild leaves the earlier table in use. ``fmt`` is
    the file format (``parquet``, or ``json`` for raw landed records);
    ``schema`` is applied when reading back a schema-less format, ``options``
    when writing. With ``stored`` the build has written its rows itself (as the
    numbering does) and its frame is kept without a second copy.
    """
    frame_key = (spark.sparkContext.applicationId, key, id(spark))  # a frame belongs to one session
    if refresh or frame_key not in _FRAMES:
        digest = hashlib.sha1(key.encode()).hexdigest()[:16]
        path = scratch_path(spark, "tables", digest)
        began = time.time()
        if stored:
            _FRAMES[frame_key] = build()
            BUILD_SECONDS[key] = round(time.time() - began, 3)
            return _FRAMES[frame_key]
        build().write.format(fmt).options(**(options or {})).save(path)
        BUILD_SECONDS[key] = round(time.time() - began, 3)
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        _FRAMES[frame_key] = reader.load(path)
    return _FRAMES[frame_key]


def _set_root(spark: SparkSession, key: str) -> str:
    return scratch_path(spark, "sets", hashlib.sha1(key.encode()).hexdigest()[:16], unique=False)


def materialized_set(
    spark: SparkSession, key: str, builders: dict[str, Callable[[dict[str, DataFrame]], DataFrame]], refresh: bool = False
) -> dict[str, DataFrame]:
    """Several tables that become current together.

    Each builder is given the tables before it, so a fact refers to the
    dimensions of its own build. All tables are written to a new place first;
    one small manifest with all their paths, committed last, makes them current.
    A build that fails at any table leaves the earlier set current as a whole,
    in this application and for :func:`read_set`.
    """
    frame_key = (spark.sparkContext.applicationId, key, id(spark))
    if refresh or frame_key not in _SETS:
        root = _set_root(spark, key)
        place = f"data/{uuid.uuid4().hex[:12]}"
        made: dict[str, DataFrame] = {}
        for name, build in builders.items():
            began = time.time()
            build(made).write.parquet(f"{root}/{place}/{name}")
            BUILD_SECONDS[f"{name}|{key}"] = round(time.time() - began, 3)
            made[name] = spark.read.parquet(f"{root}/{place}/{name}")
        version = max((int(n[2:]) for n in committed_children(spark, root, "v=")), default=0) + 1
        path = f"{root}/v={version:06d}"
        write_text(spark, f"{path}/manifest.json", json.dumps({name: f"{place}/{name}" for name in made}))
        commit(spark, path)
        _SETS[frame_key] = made
    return _SETS[frame_key]


def read_set(spark: SparkSession, key: str) -> dict[str, DataFrame] | None:
    """The current set of ``key`` by its manifest, whichever application built it."""
    root = _set_root(spark, key)
    found = committed_children(spark, root, "v=")
    if not found:
        return None
    paths = json.loads(read_text(spark, f"{root}/{found[-1]}/manifest.json"))
    return {name: spark.read.parquet(f"{root}/{path}") for name, path in paths.items()}


def expire_sets(spark: SparkSession, key: str, keep: int = 2) -> None:
    """Removes all but the newest ``keep`` sets of ``key``, manifests first."""
    root = _set_root(spark, key)
    for name in committed_children(spark, root, "v=")[:-keep]:
        paths = json.loads(read_text(spark, f"{root}/{name}/manifest.json"))
        remove(spark, f"{root}/{name}")
        for path in {p.rsplit("/", 1)[0] for p in paths.values()}:
            remove(spark, f"{root}/{path}")
