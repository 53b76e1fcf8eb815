"""Clickstream tables kept up to date by batches, and the stream's keyed state."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.plans import click_refresh, clickstream
from cartwheel.session import list_dir, scratch_path
from cartwheel.streaming import incremental as inc

EVENTS = (
    "event_id string, session_id string, customer_id long, event_type string, product_id long, "
    "event_timestamp timestamp, device_type string, event_date date"
)


def _events(spark, n, seed):
    """Sessions that cross midnight, some without an id; ids rise but times do not."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = rng.choice([None, *range(9)])
        at = dt.datetime(2025, 1, 1, 22) + dt.timedelta(days=(s or 0) % 3, minutes=rng.randrange(300))
        kind = rng.choice(clickstream.VALID_EVENT_TYPES)
        product = None if kind == "page_view" else rng.randrange(4)
        rows.append((f"{i:04d}", s and f"s{s}", rng.choice([None, 7, 8]), kind, product, at, rng.choice(["a", "b", None]), at.date()))
    return spark.createDataFrame(rows, EVENTS)


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def _same_as_all(tables, events):
    assert _rows(tables.sessions.read()) == _rows(clickstream.sessions_from(events))
    assert _rows(tables.daily.read()) == _rows(clickstream.daily_from(clickstream.session_days(events)))
    assert _rows(tables.product_daily.read()) == _rows(clickstream.product_daily_from(events))


def test_batches_give_what_all_events_give(spark, monkeypatch):
    events = _events(spark, 240, 3).repartition(2)
    part = F.col("event_id").cast("int") % 3
    tables = click_refresh.ClickTables(spark, scratch_path(spark, "test-clicks"))
    tables.load(events.where(part == 0), "a")
    tables.load(events.where(part == 1), "b")
    _same_as_all(tables, events.where(part < 2))
    # interrupted after the first table took the batch: the second run counts nothing twice
    with monkeypatch.context() as m:
        m.setattr(click_refresh.ClickTables, "_fold_sessions", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.load(events.where(part == 2), "c")
    tables.load(events.where(part == 2), "c")
    _same_as_all(tables, events)
    assert tables.load(events.where("false"), "d") == {"days": 0}


def test_late_event_rewrites_its_day_and_its_session_only(spark):
    at = lambda d, h: dt.datetime(2025, 1, d, h)
    row = lambda i, s, t: (i, s, 1, "view_product", 1, t, "a", t.date())
    first = [row(f"{d}", f"s{d}", at(d, 1)) for d in range(2, 9)]
    tables = click_refresh.ClickTables(spark, scratch_path(spark, "test-late"))
    tables.load(spark.createDataFrame(first, EVENTS), "a")
    # session s5 began the evening before
    late = spark.createDataFrame([row("x", "s5", at(4, 23))], EVENTS)
    assert tables.load(late, "b") == {"days": 1}
    began = {r["session_id"]: r["event_date"].day for r in tables.sessions.read().collect()}
    assert began == {f"s{d}": 4 if d == 5 else d for d in range(2, 9)}
    version = lambda t: {dt.date(1970, 1, 1) + dt.timedelta(r["bucket"]): r["path"].split("/")[1] for r in t.entries().collect()}
    wrote = {d.day for d, v in version(tables.session_days).items() if v == "v=000002"}
    assert wrote == {4}
    assert {d.day for d, v in version(tables.sessions).items() if v == "v=000002"} == {4}  # day 5 lost its session
    assert dt.date(2025, 1, 5) not in version(tables.sessions)


def test_stream_state_drops_repeats_before_landing_and_over_restarts(spark):
    d = dt.datetime
    schema = "order_id bigint, customer_id bigint, order_date timestamp, status string, channel string"
    make = lambda ids, status="paid": spark.createDataFrame([(i, 1, d(2025, 1, 1 + i % 9), status, "web") for i in ids], schema)
    root = scratch_path(spark, "test-stream-state")

    def load():
        inc.stream_load(
            spark, f"{root}/src", make([0]).schema, f"{root}/t", f"{root}/l", f"{root}/ck", "order_id", "order_date",
            lambda e: d(2026, 1, 1), repeats_within="2 days",
        )

    make(range(40)).write.parquet(f"{root}/src")
    load()
    # a full export: repeats, a late row, and a changed row of a known key
    make([*range(40), 41]).write.mode("append").parquet(f"{root}/src")
    make([7], "changed").write.mode("append").parquet(f"{root}/src")
    load()
    load()
    landed = spark.read.parquet(f"{root}/l")
    assert landed.count() == 42 and landed.where("status = 'changed'").count() == 1
    got = inc.read_loaded(spark, f"{root}/t")
    assert sorted(r["order_id"] for r in got.collect()) == [*range(40), 41]
    assert got.where("status = 'changed'").count() == 0  # the key is loaded; the index keeps the first
    assert "state" in list_dir(spark, f"{root}/ck")
