"""Incremental-load scenarios over the orders table (I1-I8 end to end).

The source "as of run 1" holds orders before 1998-01-01 except the
marketplace orders of 1997-12-31: that channel's feed for the day arrives
late (with the full table at run 2). By default every row is considered and
the key anti join drops what is loaded, so no late or tied row is lost; a
one-day ``lookback`` is the bounded form, and a reset-and-replay recovers what
a strict mark missed; a folder of files is read by
its ledger, each file once; the stream form has no mark and loads everything once. Load times are fixed literals so the
final table is reproducible. Each query returns the final target table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..oracle import with_fixtures
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.tables import read_table
from ..streaming import incremental as inc
from ..streaming.ledger import FileSource

CUTOFF = "1998-01-01"
LATE_DAY = "1997-12-31"
LATE_CHANNEL = "marketplace"
T1, T2, T3 = (dt.datetime(2026, 2, d) for d in (1, 2, 3))
STREAM_BASE = dt.datetime(2026, 3, 1)


def _source_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.orders(spark, sf_dir)
    late = (F.col("order_date") == F.lit(LATE_DAY).cast("timestamp")) & (F.col("channel") == LATE_CHANNEL)
    return o.where((F.col("order_date") < F.lit(CUTOFF).cast("timestamp")) & ~late)


def _paths(spark: SparkSession, name: str) -> dict[str, str]:
    root = scratch_path(spark, "incremental", name)
    return {"target_root": f"{root}/target", "state_root": f"{root}/state", "landing_root": f"{root}/landing"}


def _run(spark, source, p, at, lookback=None, tag=""):
    return inc.incremental_run(
        spark, source, key="order_id", ts_col="order_date", loaded_at=at, lookback=lookback,
        batch_id=f"b-{tag}", **p,
    )


def incremental_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 1 on the early source, run 2 on the full one
    (the late rows come in), run 3 finds every row loaded and writes nothing."""
    p = _paths(spark, "two_runs")
    _run(spark, _source_v1(spark, sf_dir), p, T1, tag="1")
    full = fx.orders(spark, sf_dir)
    _run(spark, full, p, T2, tag="2")
    _run(spark, full, p, T3, tag="3")
    return inc.read_loaded(spark, p["target_root"])


def incremental_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 2 re-reads one day below the mark; the anti join drops repeats."""
    p = _paths(spark, "lookback")
    _run(spark, _source_v1(spark, sf_dir), p, T1, tag="1")
    _run(spark, fx.orders(spark, sf_dir), p, T2, lookback=dt.timedelta(days=1), tag="2")
    return inc.read_loaded(spark, p["target_root"])


def incremental_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After two runs with a strict mark it is reset; the replay reads
    everything and loads only keys not yet present (the rows below the mark)."""
    p = _paths(spark, "reset")
    full = fx.orders(spark, sf_dir)
    _run(spark, _source_v1(spark, sf_dir), p, T1, tag="1")
    _run(spark, full, p, T2, lookback=dt.timedelta(0), tag="2")
    inc.WatermarkState(spark, p["state_root"]).reset()
    _run(spark, full, p, T3, lookback=dt.timedelta(0), tag="3")
    return inc.read_loaded(spark, p["target_root"])


def _file_runs(spark: SparkSession, sf_dir: str, name: str) -> dict[str, str]:
    """A folder that grows by files, loaded by its ledger. Drop 1 is the early
    source; drop 2 exports everything from the late day on again, so it holds
    late rows, rows that are loaded already and new ones; the third run finds
    no new file. Files come in the raw shape of the orders table."""
    p = _paths(spark, name)
    src = scratch_path(spark, "incremental", f"{name}-source")
    raw = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    day = F.lit(LATE_DAY).cast("timestamp")
    late = (F.col("o_orderdate") == day) & (fx.channel_of(F.col("o_orderkey")) == LATE_CHANNEL)
    early = raw.where((F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp")) & ~late)
    source = FileSource(src, raw.schema, fx.orders_of)
    for drop, at in ((early, T1), (raw.where(F.col("o_orderdate") >= day), T2), (None, T3)):
        if drop is not None:
            drop.write.mode("append").parquet(src)
        inc.incremental_run(spark, source, key="order_id", ts_col="order_date", loaded_at=at, **p)
    return p


def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a growing folder, each reading new files
    only; late and tied rows come in, repeats drop out at the key index."""
    return inc.read_loaded(spark, _file_runs(spark, sf_dir, "files")["target_root"])


def incremental_files_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of those batches took, landed and loaded."""
    return inc.landing_audit(spark, **{k: v for k, v in _file_runs(spark, sf_dir, "files-audit").items()}).drop("files")


def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 stream form: two file drops, each processed by an availableNow run of
    the same streaming query (same checkpoint)."""
    root = scratch_path(spark, "incremental", "stream")
    src, ckpt = f"{root}/source", f"{root}/checkpoint"
    target, landing = f"{root}/target", f"{root}/landing"
    v1 = _source_v1(spark, sf_dir)
    schema = v1.schema
    for drop in (v1, fx.orders(spark, sf_dir)):
        drop.write.mode("append").parquet(src)
        # fixed load times, so the result can be compared
        inc.stream_load(
            spark, src, schema, target, landing, ckpt, "order_id", "order_date", lambda e: STREAM_BASE + dt.timedelta(days=e)
        )
    return inc.read_loaded(spark, target)


def incremental_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 stream form with keyed state: the second drop is a full export, whose
    repeats the state drops before they are landed. Per micro-batch the rows
    landed and loaded; the checkpoint carries the state from run to run."""
    root = scratch_path(spark, "incremental", "stream-state")
    v1 = _source_v1(spark, sf_dir)
    for drop in (v1, fx.orders(spark, sf_dir)):
        drop.write.mode("append").parquet(f"{root}/source")
        inc.stream_load(
            spark, f"{root}/source", v1.schema, f"{root}/target", f"{root}/landing", f"{root}/checkpoint", "order_id", "order_date",
            lambda e: STREAM_BASE + dt.timedelta(days=e), repeats_within="2 days",
        )
    landed = spark.read.parquet(f"{root}/landing").groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows_landed"))
    loaded = spark.read.parquet(f"{root}/target")
    per = loaded.groupBy(F.col("batch").alias("batch_id")).agg(F.count(F.lit(1)).alias("rows_loaded"))
    # micro-batches that only move the watermark take numbers, too: the drops are numbered in their order
    order = Window.orderBy("batch_id")  # one row a drop
    return landed.join(per, "batch_id").select(
        F.row_number().over(order).cast("bigint").alias("drop_number"), "rows_landed", "rows_loaded"
    )


# ---------------------------------------------------------------- oracle SQL

_V1 = f"""v1 AS (SELECT * FROM sales_orders WHERE order_date < TIMESTAMP '{CUTOFF}'
             AND NOT (order_date = TIMESTAMP '{LATE_DAY}' AND channel = '{LATE_CHANNEL}')),
m1 AS (SELECT MAX(order_date) AS m FROM v1)"""


def _ts(x: dt.datetime) -> str:
    return f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"


SQL = {
    "incremental_two_runs": f"""
WITH {_V1}
SELECT *, {_ts(T1)} AS loaded_at FROM v1
UNION ALL
SELECT *, {_ts(T2)} FROM sales_orders WHERE order_id NOT IN (SELECT order_id FROM v1)""",
    "incremental_lookback": f"""
WITH {_V1}
SELECT *, {_ts(T1)} AS loaded_at FROM v1
UNION ALL
SELECT *, {_ts(T2)} FROM sales_orders
WHERE order_date > (SELECT m - INTERVAL 1 DAY FROM m1) AND order_id NOT IN (SELECT order_id FROM v1)""",
    "incremental_files": f"""
WITH {_V1}
SELECT *, {_ts(T1)} AS loaded_at FROM v1
UNION ALL
SELECT *, {_ts(T2)} FROM sales_orders WHERE order_id NOT IN (SELECT order_id FROM v1)""",
    "incremental_files_audit": f"""
WITH {_V1}, drop2 AS (SELECT * FROM sales_orders WHERE order_date >= TIMESTAMP '{LATE_DAY}')
SELECT '0-000001' AS batch_id, COUNT(*) AS rows_taken, COUNT(*) AS rows_landed, COUNT(*) AS rows_loaded FROM v1
UNION ALL
SELECT '0-000002', COUNT(*), COUNT(*), COUNT(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM v1)) FROM drop2""",
    "incremental_stream_state": f"""
WITH {_V1}, l AS (
  SELECT CASE WHEN order_id IN (SELECT order_id FROM v1) THEN 1 ELSE 2 END::BIGINT AS drop_number FROM sales_orders)
SELECT drop_number, COUNT(*) AS rows_landed, COUNT(*) AS rows_loaded FROM l GROUP BY drop_number""",
    "incremental_reset": f"""
WITH {_V1},
r2 AS (SELECT * FROM sales_orders WHERE order_date > (SELECT m FROM m1) AND order_id NOT IN (SELECT order_id FROM v1))
SELECT *, {_ts(T1)} AS loaded_at FROM v1
UNION ALL SELECT *, {_ts(T2)} FROM r2
UNION ALL SELECT *, {_ts(T3)} FROM sales_orders
WHERE order_id NOT IN (SELECT order_id FROM v1) AND order_id NOT IN (SELECT order_id FROM r2)""",
    "incremental_stream": f"""
WITH {_V1}
SELECT *, {_ts(STREAM_BASE)} AS loaded_at FROM v1
UNION ALL
SELECT *, {_ts(STREAM_BASE + dt.timedelta(days=1))} FROM sales_orders WHERE order_id NOT IN (SELECT order_id FROM v1)""",
}

QUERIES = {
    "incremental_two_runs": incremental_two_runs,
    "incremental_lookback": incremental_lookback,
    "incremental_files": incremental_files,
    "incremental_files_audit": incremental_files_audit,
    "incremental_reset": incremental_reset,
    "incremental_stream": incremental_stream,
    "incremental_stream_state": incremental_stream_state,
}
ORACLE = {name: with_fixtures(sql) for name, sql in SQL.items()}
