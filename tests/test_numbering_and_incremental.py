"""Parallel numbering equals the global row_number; incremental loading
properties: idempotent re-runs, ties at the mark, stream = batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.numbering import dense_row_number
from cartwheel.session import scratch_path
from cartwheel.streaming import incremental as inc


def test_dense_row_number_matches_global_row_number(spark):
    df = spark.range(0, 30_000).select(
        (F.col("id") % 7).alias("a"), ((F.col("id") * 7919) % 30_011).alias("b"), F.col("id").alias("id")
    )
    ours = dense_row_number(df.repartition(5), ["a", "b", "id"], "n", num_partitions=6)
    ref = df.withColumn("m", F.row_number().over(Window.orderBy("a", "b", "id")))
    diff = ours.join(ref, ["a", "b", "id"]).where("n != m").count()
    assert diff == 0 and ours.count() == 30_000
    assert ours.agg(F.min("n"), F.max("n")).first() == (1, 30_000)


def test_dense_row_number_start_offset(spark):
    df = spark.range(0, 100).select(F.col("id").alias("k"))
    out = dense_row_number(df, ["k"], "n", start=F.lit(11))
    assert out.agg(F.min("n"), F.max("n")).first() == (11, 110)


SCHEMA = "order_id bigint, customer_id bigint, order_date timestamp, status string, channel string"


def _orders(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _paths(spark, name):
    root = scratch_path(spark, "test-inc", name)
    return {"target_root": f"{root}/t", "state_root": f"{root}/s", "landing_root": f"{root}/l"}


def test_incremental_twice_equals_once_and_tie_at_mark(spark):
    d = dt.datetime
    run1 = _orders(spark, [(1, 1, d(2025, 1, 1), "paid", "web"), (2, 1, d(2025, 1, 2), "paid", "web")])
    # order 3 ties with the mark and arrives late; order 4 is new; order 2 repeats
    run2 = _orders(
        spark,
        [(1, 1, d(2025, 1, 1), "paid", "web"), (2, 1, d(2025, 1, 2), "paid", "web"),
         (3, 1, d(2025, 1, 2), "paid", "web"), (4, 1, d(2025, 1, 3), "paid", "web"),
         (4, 1, d(2025, 1, 3), "paid", "web")],
    )
    p = _paths(spark, "strict")
    r1 = inc.incremental_run(spark, run1, key="order_id", ts_col="order_date", loaded_at=d(2026, 1, 1), **p)
    assert r1["loaded"] == 2
    strict = dt.timedelta(0)
    inc.incremental_run(spark, run2, key="order_id", ts_col="order_date", loaded_at=d(2026, 1, 2), lookback=strict, **p)
    again = inc.incremental_run(spark, run2, key="order_id", ts_col="order_date", loaded_at=d(2026, 1, 3), lookback=strict, **p)
    assert (again["extracted"], again["loaded"]) == (0, 0)  # nothing after the mark: short circuit
    ids = sorted(r["order_id"] for r in inc.read_loaded(spark, p["target_root"]).collect())
    assert ids == [1, 2, 4]  # strict '>' loses the tie at the mark (original behaviour)

    p2 = _paths(spark, "lookback")
    inc.incremental_run(spark, run1, key="order_id", ts_col="order_date", loaded_at=d(2026, 1, 1), **p2)
    inc.incremental_run(
        spark, run2, key="order_id", ts_col="order_date", loaded_at=d(2026, 1, 2), lookback=dt.timedelta(days=1), **p2
    )
    ids2 = sorted(r["order_id"] for r in inc.read_loaded(spark, p2["target_root"]).collect())
    assert ids2 == [1, 2, 3, 4]  # lookback recovers it; the anti join never duplicates

    p3 = _paths(spark, "default")
    inc.incremental_run(spark, run1, key="order_id", ts_col="order_date", **p3)
    second = inc.incremental_run(spark, run2, key="order_id", ts_col="order_date", **p3)
    third = inc.incremental_run(spark, run2, key="order_id", ts_col="order_date", **p3)
    assert (second["loaded"], third["loaded"]) == (2, 0)  # no bound: nothing is lost
    loaded = inc.read_loaded(spark, p3["target_root"])
    assert sorted(r["order_id"] for r in loaded.collect()) == [1, 2, 3, 4]
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert all(abs(now - r["loaded_at"]) < dt.timedelta(hours=1) for r in loaded.collect())  # the current time
    # the run that found everything loaded left no batch in the target
    from cartwheel.session import list_dir

    assert len([n for n in list_dir(spark, p3["target_root"]) if n.startswith("batch=")]) == 2


def test_replayed_batch_id_lands_and_loads_once_without_spark_markers(spark):
    d = dt.datetime
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(key, "false")
    try:
        p = _paths(spark, "replay")
        one = _orders(spark, [(1, 1, d(2025, 1, 1), "paid", "web"), (2, 1, d(2025, 1, 2), "paid", "web")])
        for _ in range(2):
            inc.incremental_run(spark, one, key="order_id", ts_col="order_date", batch_id="same", **p)
        inc.incremental_run(spark, one, key="order_id", ts_col="order_date", batch_id="other", **p)
        assert inc.read_loaded(spark, p["target_root"]).count() == 2
        assert spark.read.parquet(f"{p['landing_root']}/batch_id=same").count() == 2
    finally:
        conf.unset(key)


def test_tied_rows_of_a_key_are_settled_by_content(spark):
    at = dt.datetime(2025, 1, 1)
    rows = [(1, 9, at, "paid", "web"), (1, 3, at, "paid", "web"), (1, 3, at, "late", "web")]
    for order in (rows, rows[::-1]):
        got = inc.new_rows(_orders(spark, order).repartition(3), None, "order_id", "order_date").collect()
        assert [(r["customer_id"], r["status"]) for r in got] == [(3, "late")]


def test_stream_equals_batch(spark):
    d = dt.datetime
    rows = [(i, i % 5, d(2025, 1, 1 + i % 20), "paid", "web") for i in range(200)]
    df = _orders(spark, rows)
    root = scratch_path(spark, "test-stream")
    df.where("order_id < 100").write.parquet(f"{root}/src")
    inc.stream_load(spark, f"{root}/src", df.schema, f"{root}/t", f"{root}/l", f"{root}/ck", "order_id",
                    "order_date", lambda e: d(2026, 1, 1 + e))
    df.write.mode("append").parquet(f"{root}/src")  # full re-export: half are repeats
    inc.stream_load(spark, f"{root}/src", df.schema, f"{root}/t", f"{root}/l", f"{root}/ck", "order_id",
                    "order_date", lambda e: d(2026, 1, 1 + e))
    got = inc.read_loaded(spark, f"{root}/t")
    assert got.count() == 200 and got.select("order_id").distinct().count() == 200


def test_stream_in_bounded_micro_batches(spark):
    """One file per micro-batch (``maxFilesPerTrigger``): several epochs, the
    same final target as one batch, no key loaded twice."""
    d = dt.datetime
    rows = [(i, i % 5, d(2025, 1, 1 + i % 20), "paid", "web") for i in range(120)]
    df = _orders(spark, rows)
    root = scratch_path(spark, "test-stream-bounded")
    df.where("order_id < 60").repartition(3).write.parquet(f"{root}/src")
    df.repartition(4).write.mode("append").parquet(f"{root}/src")  # repeats half the keys
    inc.stream_load(spark, f"{root}/src", df.schema, f"{root}/t", f"{root}/l", f"{root}/ck", "order_id",
                    "order_date", lambda e: d(2026, 1, 1 + e), max_files_per_trigger=1)
    got = inc.read_loaded(spark, f"{root}/t")
    assert got.count() == 120 and got.select("order_id").distinct().count() == 120
    assert got.select("loaded_at").distinct().count() > 1  # more than one micro-batch ran
