"""Idempotent incremental loading.

Batch form (``incremental_run``), per run:

1. read the high-water mark from a one-row state table (default epoch, I1);
2. extract the source rows to look at. A folder of files (``FileSource``) is
   read by a ledger of the files already taken (``ledger.py``): only new files
   are opened, so late and tied rows come in and nothing is read twice. A
   DataFrame has no such log: with ``lookback`` only ``ts > mark - lookback``
   is read, as a literal that reaches the Parquet scan (``PushedFilters``) - a
   bound the caller must know to hold; without it all rows, lest any be lost;
3. land them unmodified under ``batch_id=<id>`` (K5, audit trail); a repeated
   batch id replaces its own landing; stop if nothing was extracted (F24);
4. keep the first row per key inside the batch (F9) and drop keys already in
   the target (anti join, J10), which an index of the loaded keys answers
   (``operators/key_index.py``) without a scan of the target; write the rest
   with a load time as the batch's own directory of the target (K7, F23) and
   commit it, then its keys; a batch whose rows are all present leaves no
   directory;
5. only then move the mark to the batch maximum (I2) and enter the files in the
   ledger, also when nothing was new, so the same rows are not read again (I8).

The target is the union of its committed batch directories; the commit marker
is ours, not Spark's ``_SUCCESS``. The key anti join makes every replay a
no-op, and a replayed batch replaces what it wrote before.

Stream form (``stream_load``): a file source read with Structured Streaming,
``trigger(availableNow=True)``, and ``foreachBatch`` doing the same with the
epoch as batch id. The streaming checkpoint replaces the mark; a new
checkpoint replays every file and the anti join keeps the target unchanged (I3).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import keep_first_by
from ..operators.key_index import KeyIndex
from ..operators.upsert import read_current, write_version
from ..sinks.commit import commit, committed_children, remove
from .ledger import FileLedger, FileSource

DEFAULT_MARK = dt.datetime(1970, 1, 1)


class WatermarkState:
    """One-row state table kept as versions ``v=NNNNNN`` (newest committed wins)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def read(self) -> dt.datetime:
        state = read_current(self.spark, self.root)
        row = state.first() if state is not None else None
        return row["watermark"] if row and row["watermark"] is not None else DEFAULT_MARK

    def write(self, mark: DataFrame) -> None:
        """``mark`` is a one-row frame with a ``watermark`` column (computed by Spark)."""
        write_version(self.spark, self.root, mark.select(F.col("watermark").cast("timestamp")).coalesce(1))

    def reset(self) -> None:
        """The next run starts from the default mark (history is kept)."""
        self.write(self.spark.range(1).select(F.lit(None).cast("timestamp").alias("watermark")))


def extract_new(source: DataFrame, ts_col: str, since: dt.datetime, lookback: dt.timedelta | None = None) -> DataFrame:
    """Rows strictly after the mark minus ``lookback`` (zero for a
    strict mark); every row when there is no ``lookback``."""
    if lookback is None:
        return source
    return source.where(F.col(ts_col) > F.lit(since - lookback).cast("timestamp"))


def land(spark: SparkSession, batch: DataFrame, landing_root: str, batch_id: str) -> tuple[DataFrame, int]:
    """K5: write the batch unmodified under its own partition, replacing an
    earlier landing of the same id; returns it read back and its row count
    (taken from the write itself)."""
    path = f"{landing_root}/batch_id={batch_id}"
    obs = Observation()
    batch.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return spark.read.schema(batch.schema).parquet(path), obs.get["rows"]


def new_rows(batch: DataFrame, target: DataFrame | None, key: str, ts_col: str) -> DataFrame:
    """J10 + F9: first row per key within the batch, minus keys already loaded.

    Rows of one key are ordered by time and then by every other column, so
    ties are settled by content. ``batch LEFT ANTI JOIN target`` could only
    build on the target side and would shuffle the whole, ever-growing target
    every run. Instead the target's key column is semi-joined to the batch's
    distinct keys (the small side, which Spark broadcasts when its measured
    size allows), and the batch is anti-joined to that small hit list.
    """
    rest = [c for c in batch.columns if c not in (ts_col, key)]
    first = keep_first_by(batch, key, [ts_col, *rest])
    if target is None:
        return first
    # the same key set as ``first``'s, taken from the landed batch so the
    # first-row aggregate is not evaluated a second time for its keys
    batch_keys = batch.select(key).distinct()
    already = target.select(key).join(batch_keys, key, "left_semi")
    return first.join(already, key, "left_anti")


def read_loaded(spark: SparkSession, target_root: str, without: str | None = None) -> DataFrame | None:
    """The target: its committed batches, but not the one named ``without``."""
    names = [n for n in committed_children(spark, target_root, "batch=") if n != f"batch={without}"]
    return spark.read.parquet(*[f"{target_root}/{n}" for n in names]) if names else None


def key_index(spark: SparkSession, target_root: str, key: str, without: str | None = None) -> KeyIndex:
    """The index of the target's keys, kept beside its batches. Batches that were
    committed but not indexed (a run that failed in between) are added first."""
    index = KeyIndex(spark, f"{target_root}/_index", key)
    known = index.batches()
    for name in committed_children(spark, target_root, "batch="):
        batch = name.removeprefix("batch=")
        if batch != without and batch not in known:
            index.add(spark.read.parquet(f"{target_root}/{name}"), batch)
    return index


def _load(
    spark: SparkSession, landed: DataFrame, target_root: str, batch_id: str, key: str, ts_col: str, loaded_at: Column
) -> int:
    """The batch's new rows as its committed directory of the target; returns how many."""
    path = f"{target_root}/batch={batch_id}"
    index = key_index(spark, target_root, key, batch_id)
    fresh = new_rows(landed, None, key, ts_col).join(index.present(landed, without=batch_id), key, "left_anti")
    obs = Observation()
    # T5: rows sorted by event time inside each file keep Parquet min/max
    # statistics tight, so later range scans on ts_col skip row groups
    out = fresh.withColumn("loaded_at", loaded_at).observe(obs, F.count(F.lit(1)).alias("rows"))
    out.sortWithinPartitions(ts_col).write.mode("overwrite").parquet(path)
    if obs.get["rows"]:
        commit(spark, path)
        index.add(spark.read.parquet(path), batch_id)
    else:
        remove(spark, path)  # everything was loaded before
        if batch_id in index.batches():
            index.forget(batch_id)
    return obs.get["rows"]


def _as_column(at: dt.datetime | Column | None) -> Column:
    """The load time, the current (UTC) time unless the caller says otherwise."""
    if at is None:
        return F.current_timestamp()
    return at if isinstance(at, Column) else F.lit(at).cast("timestamp")


def incremental_run(
    spark: SparkSession,
    source: DataFrame | FileSource,
    target_root: str,
    state_root: str,
    landing_root: str,
    key: str,
    ts_col: str,
    loaded_at: dt.datetime | Column | None = None,
    lookback: dt.timedelta | None = None,
    batch_id: str | None = None,
) -> dict:
    """One incremental run; returns what it did (counts come from the writes).

    A ``FileSource`` is read by its ledger (kept beside the mark): a run without
    new files lists the source and writes nothing. Of a DataFrame,
    ``lookback=None`` considers every row (nothing is ever lost); a timedelta
    bounds the re-read, zero being a strict mark."""
    state = WatermarkState(spark, state_root)
    since = state.read()
    entries = None
    if isinstance(source, FileSource):
        ledger = FileLedger(spark, f"{state_root}/ledger")
        taken = ledger.take(source)
        if taken is None:
            return {"since": since, "extracted": 0, "loaded": 0}
        rows, entries = taken
        batch_id = batch_id or ledger.next_batch()
    else:
        rows = extract_new(source, ts_col, since, lookback)
        batch_id = batch_id or uuid.uuid4().hex
    landed, n = land(spark, rows, landing_root, batch_id)
    loaded = 0
    if n:
        loaded = _load(spark, landed, target_root, batch_id, key, ts_col, _as_column(loaded_at))
        state.write(landed.agg(F.greatest(F.max(ts_col), F.lit(since).cast("timestamp")).alias("watermark")))
    else:
        remove(spark, f"{landing_root}/batch_id={batch_id}")
    if entries is not None:
        ledger.record(entries, batch_id)
    if not n:
        return {"since": since, "extracted": 0, "loaded": 0}
    return {"since": since, "batch_id": batch_id, "extracted": n, "loaded": loaded}


def landing_audit(spark: SparkSession, state_root: str, landing_root: str, target_root: str) -> DataFrame:
    """Per batch of a ``FileSource`` the files and rows the ledger says it
    took, the rows that were landed and the rows that were loaded."""
    taken = FileLedger(spark, f"{state_root}/ledger").entries()
    per = taken.groupBy("batch_id").agg(
        F.countDistinct("file").alias("files"), F.sum(F.col("next_row") - F.col("first_row")).alias("rows_taken")
    )
    # partition columns only: the counts come from the footers
    landed = spark.read.parquet(landing_root).groupBy(F.col("batch_id").cast("string").alias("batch_id"))
    names = committed_children(spark, target_root, "batch=")
    out = per.join(landed.agg(F.count(F.lit(1)).alias("rows_landed")), "batch_id", "left")
    if names:
        target = spark.read.option("basePath", target_root).parquet(*[f"{target_root}/{n}" for n in names])
        loaded = target.groupBy(F.col("batch").cast("string").alias("batch_id")).agg(F.count(F.lit(1)).alias("rows_loaded"))
        out = out.join(loaded, "batch_id", "left")
    else:
        out = out.withColumn("rows_loaded", F.lit(0).cast("bigint"))
    return out.na.fill(0, ["rows_landed", "rows_loaded"])


def stream_load(
    spark: SparkSession,
    source_dir: str,
    schema,
    target_root: str,
    landing_root: str,
    checkpoint: str,
    key: str,
    ts_col: str,
    loaded_at: Callable[[int], dt.datetime | Column] | None = None,
    max_files_per_trigger: int = 1000,
    repeats_within: str | None = None,
) -> None:
    """I5 stream form: process every file present in ``source_dir`` once
    (``availableNow``), each micro-batch landed, de-duplicated against the
    target and committed. ``loaded_at`` maps the epoch to a load time; without
    it the current time is used. ``availableNow`` honours
    ``maxFilesPerTrigger``, so a large backlog is worked off in bounded
    micro-batches rather than one. The landed batch is read back in the
    caller's session, where adaptive execution is on (streaming turns it off
    in its own).

    With ``repeats_within`` (such as ``"2 days"``) the stream keeps the rows it
    saw as keyed state for that long and drops exact repeats before they are
    landed; a re-exported file then costs no landing space. The state goes by
    time of arrival, so no late row is dropped, and lives in the checkpoint, so
    a restart goes on with it. Repeats that come later, and other rows of a
    known key, are left to the key index as before."""

    def per_batch(df: DataFrame, epoch_id: int) -> None:
        bid = f"epoch-{epoch_id:06d}"
        landed, n = land(spark, df, landing_root, bid)
        if n:
            at = _as_column(loaded_at(epoch_id) if loaded_at else None)
            _load(spark, landed, target_root, bid, key, ts_col, at)
        else:
            remove(spark, f"{landing_root}/batch_id={bid}")

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    if repeats_within:
        columns = [F.col(f"`{c}`") for c in rows.columns]
        # the arrival is the time of the micro-batch, the same when it is run again
        marked = rows.select("*", F.sha2(F.to_json(F.struct(*columns)), 256).alias("_cw_row"), F.current_timestamp().alias("_cw_arrived"))
        rows = marked.withWatermark("_cw_arrived", repeats_within).dropDuplicatesWithinWatermark([key, "_cw_row"]).select(*columns)

    q = (
        rows.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
