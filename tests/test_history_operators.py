"""Hot-key joins, the as-of merge, histories from snapshots in any order, stable surrogate keys."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.asof import asof_merge
from cartwheel.operators.dimensions import asof_version
from cartwheel.operators.intervals import SnapshotHistory
from cartwheel.operators.key_registry import KeyRegistry
from cartwheel.operators.skew import heavy_keys, skew_join
from cartwheel.session import scratch_path


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- hot keys


def _hot(spark, n=20_000):
    """A third of the rows hold key 1, some have none, the rest are spread."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 997 + 5).cast("int").alias("k"),
        F.col("id").alias("v"),
    )


def test_heavy_keys_finds_the_hot_ones(spark):
    hot = heavy_keys(_hot(spark), "k", width=8).collect()
    assert [(r["_cw_hot"], r["_cw_parts"]) for r in hot] == [(1, 3)]
    even = spark.range(1000).selectExpr("id as k")
    assert heavy_keys(even, "k", width=8).count() == 0
    assert heavy_keys(even.where("k < 0"), "k", width=8).count() == 0
    only = spark.range(100).selectExpr("'x' as k")
    assert [tuple(r) for r in heavy_keys(only, "k", width=8).collect()] == [("x", 8)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_the_plain_join(spark, how):
    facts = _hot(spark, 3000)
    dim = spark.range(1, 500).selectExpr("id as k", "concat('n', id) as name").union(
        spark.createDataFrame([(1, "second"), (None, "none")], "k bigint, name string")
    )
    got = skew_join(facts, dim, "k", how)
    want = facts.join(dim.withColumn("k", F.col("k").cast("int")), "k", how)
    assert got.columns == want.columns and _rows(got) == _rows(want)
    with pytest.raises(ValueError):
        skew_join(facts, dim, "k", "full")


def test_skew_join_spreads_the_hot_key(spark):
    """Without broadcast, the rows of the hot key come out of several tasks and none has a third of them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dim = spark.range(2000).selectExpr("cast(id as int) as k", "id as name")
        facts = _hot(spark)
        tasks = lambda df: df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        plain, dealt = tasks(facts.join(dim, "k")), tasks(skew_join(facts, dim, "k"))
        assert plain > 6666 and dealt < 0.75 * plain
        hot = skew_join(facts, dim, "k").where("k = 1").select(F.spark_partition_id().alias("p")).distinct().count()
        assert hot > 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


# ---------------------------------------------------------------- as-of


VERSIONS = "k bigint, key bigint, city string, valid_from date, valid_to date"
FACTS = "id bigint, k bigint, at timestamp"


def _history(spark, rng, keys=6):
    rows, n = [], 0
    for k in range(keys):
        days = sorted(rng.sample(range(400), rng.randint(0, 5)))
        for a, b in zip(days, [*days[1:], None]):
            n += 1
            start = dt.date(2024, 1, 1) + dt.timedelta(a)
            # now and then a gap behind the version, or an end of the last
            end = dt.date(2024, 1, 1) + dt.timedelta(b) if b is not None else None
            if rng.random() < 0.3:
                end = start + dt.timedelta(1)
            rows.append((k, n, f"c{n}", start, end))
    return spark.createDataFrame(rows, VERSIONS)


@pytest.mark.parametrize("span", [86_400, 30 * 86_400, 10_000 * 86_400])
@pytest.mark.parametrize("open_first", [True, False])
def test_asof_merge_equals_the_range_join(spark, span, open_first):
    rng = random.Random(span)
    versions = _history(spark, rng)
    facts = [(i, rng.choice([None, *range(8)]), dt.datetime(2023, 12, 1) + dt.timedelta(hours=12 * rng.randrange(900))) for i in range(300)]
    df = spark.createDataFrame(facts, FACTS)
    got = asof_merge(df, versions, "k", "at", "key", open_first=open_first, span_seconds=span)
    want = asof_version(df, versions, "k", "at", "key", open_first=open_first)
    assert _rows(got.select("id", "k", "at", "key", "city")) == _rows(want.select("id", "k", "at", "key", "city"))
    assert got.count() == 300


def test_asof_merge_edges(spark):
    day = lambda d: dt.datetime(2025, 1, d)
    versions = spark.createDataFrame(
        [(1, 10, "a", dt.date(2025, 1, 5), dt.date(2025, 1, 9)), (1, 11, "b", dt.date(2025, 1, 9), None), (None, 12, "n", dt.date(2025, 1, 1), None)],
        VERSIONS,
    )
    facts = spark.createDataFrame(
        [(1, 1, day(1)), (2, 1, day(5)), (3, 1, day(8)), (4, 1, day(9)), (5, 2, day(9)), (6, None, day(9)), (7, 1, None), (3, 1, day(8))], FACTS
    )
    got = {(r["id"], r["key"]) for r in asof_merge(facts, versions, "k", "at", "key").collect()}
    assert got == {(1, 10), (2, 10), (3, 10), (4, 11), (5, -1), (6, -1), (7, -1)}
    strict = {r["id"]: r["key"] for r in asof_merge(facts, versions, "k", "at", "key", open_first=False).collect()}
    assert strict[1] == -1 and strict[2] == 10
    with pytest.raises(Exception, match="no key for k"):
        asof_merge(facts, versions, "k", "at", "key", policy="fail").collect()
    assert asof_merge(facts, versions.limit(0), "k", "at", "key").where("key = -1").count() == 8


def test_asof_merge_many_versions_of_one_hot_key(spark):
    """A key with 100,000 versions and most of the facts: no row for each pair appears on the way."""
    versions = spark.range(100_000).select(
        F.lit(1).cast("bigint").alias("k"), F.col("id").alias("key"), F.concat(F.lit("c"), "id").alias("city"),
        F.timestamp_seconds(F.col("id") * 60).alias("valid_from"), F.timestamp_seconds((F.col("id") + 1) * 60).alias("valid_to"),
    )
    facts = spark.range(50_000).select(
        F.col("id"), F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(1).alias("k"), F.timestamp_seconds(F.col("id") * 120 + 59).alias("at")
    )
    got = asof_merge(facts, versions, "k", "at", "key", span_seconds=86_400)
    assert got.where("k = 1").where(F.col("key") != F.col("id") * 2).count() == 0
    assert got.where("k = 1 AND key >= 0").count() == facts.where("k = 1").count() and got.count() == 50_000
    assert "SortMergeJoin [_cw_k#" not in got._jdf.queryExecution().executedPlan().toString().replace("_cw_kind", "")


# ---------------------------------------------------------------- snapshots in any order


def plain_history(snapshots):
    """{date: {key: values}} to versions: a version opens where a key's values differ from the last ones seen."""
    out = []
    for k in sorted({k for s in snapshots.values() for k in s}):
        seen = [(d, snapshots[d][k]) for d in sorted(snapshots) if k in snapshots[d]]
        opened = [(d, v) for i, (d, v) in enumerate(seen) if i == 0 or seen[i - 1][1] != v]
        for (d, v), end in zip(opened, [*[d for d, _ in opened[1:]], None]):
            out.append((k, *v, d, end, int(end is None)))
    return out


def _snapshots():
    day = lambda n: dt.date(2025, 1, n)
    return {
        day(1): {1: ("a", 1), 2: ("a", None), 3: ("x", 1)},
        day(5): {1: ("a", 1), 2: ("b", None), 4: (None, 2)},
        day(9): {1: ("a", 1), 2: ("a", None), 3: ("x", 1), 4: (None, 2)},
        day(12): {1: ("c", 1), 2: ("a", None), 3: ("y", 1), 5: ("e", 5)},
    }


def _load(spark, history, date, rows):
    history.apply(spark.createDataFrame([(k, *v) for k, v in rows.items()], "id bigint, city string, grade int"), date)


def test_snapshots_in_any_order_give_one_history(spark):
    snaps = _snapshots()
    want = sorted(plain_history(snaps), key=str)
    runs = set()
    orders = list(itertools.permutations(snaps))
    for order in (orders[0], orders[-1], orders[9], orders[14]):
        h = SnapshotHistory(spark, scratch_path(spark, "test-any-order"), "id", ["city", "grade"], buckets=2)
        for date in order:
            _load(spark, h, date, snaps[date])
        assert _rows(h.versions()) == want and h.dates() == sorted(snaps)
        runs.add(str(_rows(h.runs.read().select("id", "city", "grade", "first_seen", "last_seen"))))
    assert len(runs) == 1  # the stored runs are the same, too


def test_snapshot_sent_again_replaces_its_date(spark):
    snaps = _snapshots()
    h = SnapshotHistory(spark, scratch_path(spark, "test-again"), "id", ["city", "grade"], buckets=2)
    for date in snaps:
        _load(spark, h, date, snaps[date])
    version = h.runs.versions()[-1]
    for date in snaps:  # the same again: nothing is written
        _load(spark, h, date, snaps[date])
    assert h.runs.versions()[-1] == version
    snaps[dt.date(2025, 1, 5)] = {2: ("a", None), 6: ("f", 6)}
    snaps[dt.date(2025, 1, 12)] = {1: ("a", 1)}
    for date in (dt.date(2025, 1, 5), dt.date(2025, 1, 12)):
        _load(spark, h, date, snaps[date])
    assert _rows(h.versions()) == sorted(plain_history(snaps), key=str)


def test_history_random_against_plain(spark):
    rng = random.Random(8)
    days = [dt.date(2025, 3, n) for n in rng.sample(range(1, 28), 5)]
    snaps = {d: {k: (rng.choice("ab"), rng.choice([None, 1])) for k in range(12) if rng.random() < 0.75} for d in days}
    h = SnapshotHistory(spark, scratch_path(spark, "test-random"), "id", ["city", "grade"], buckets=2)
    for d in days:
        _load(spark, h, d, snaps[d])
    assert _rows(h.versions()) == sorted(plain_history(snaps), key=str)
    with pytest.raises(Exception, match="more than one row"):
        h.apply(spark.createDataFrame([(1, "a", 1), (1, "b", 1)], "id bigint, city string, grade int"), dt.date(2025, 4, 1))


# ---------------------------------------------------------------- stable keys


def test_registry_keeps_keys_over_refreshes(spark):
    reg = KeyRegistry(spark, scratch_path(spark, "test-registry"), "id", "sk", buckets=4)
    first = spark.range(0, 100, 2).selectExpr("id")
    assert reg.register(first, "load-1") == 50
    before = {r["id"]: r["sk"] for r in reg.attach(first).collect()}
    assert before == {i: n + 1 for n, i in enumerate(range(0, 100, 2))}
    # rows in the middle, one without an id, one twice
    more = spark.range(100).selectExpr("cast(id as int) as id").union(spark.createDataFrame([(None,), (3,)], "id int"))
    assert reg.register(more, "load-2") == 50 and reg.register(more, "load-2") == 0 and reg.register(more, "load-3") == 0
    after = {r["id"]: r["sk"] for r in reg.attach(more).collect()}
    assert all(after[i] == n for i, n in before.items()) and after[None] == -1
    assert sorted(after[i] for i in range(1, 100, 2)) == list(range(51, 101)) and after[1] == 51
    assert reg.attach(spark.createDataFrame([(500,)], "id bigint")).first()["sk"] == -1
    again = KeyRegistry(spark, reg.table.root, "id", "sk")
    assert again.register(spark.createDataFrame([(500,)], "id bigint"), "load-4") == 1
    assert again.attach(spark.createDataFrame([(500,)], "id bigint")).first()["sk"] == 101


# ---------------------------------------------------------------- layout


def test_clustered_files_skip_on_either_column(spark):
    """Random pairs: a narrow range of either column meets a small part of the files, and their scan says so."""
    from cartwheel.sinks.cluster import file_boxes, write_clustered

    df = spark.range(20_000).select(
        F.pmod(F.col("id") * 7919, F.lit(20_000)).alias("k"),
        F.when(F.col("id") % 500 != 0, F.timestamp_seconds(F.pmod(F.col("id") * 104_729, F.lit(20_000)) * 3600)).alias("at"),
        F.col("id").cast("string").alias("v"),
    )
    path = write_clustered(df, scratch_path(spark, "test-curve"), ["at", "k"], files=64)
    back = spark.read.parquet(path)
    assert back.columns == df.columns and back.exceptAll(df).count() == 0 and back.count() == 20_000
    boxes = file_boxes(spark, path, ["at", "k"]).collect()
    assert 48 <= len(boxes) <= 80 and sum(r["rows"] for r in boxes) == 20_000
    low, high = dt.datetime(1971, 1, 1), dt.datetime(1971, 1, 10)
    by_time = [r for r in boxes if r["min_at"] is not None and r["min_at"] < high and r["max_at"] >= low]
    by_key = [r for r in boxes if r["min_k"] < 5200 and r["max_k"] >= 5000]
    assert len(by_time) < len(boxes) / 3 and len(by_key) < len(boxes) / 3
    plain = scratch_path(spark, "test-by-time")
    df.repartitionByRange(64, "at").write.parquet(plain)
    assert sum(r["min_k"] < 5200 and r["max_k"] >= 5000 for r in file_boxes(spark, plain, ["k"]).collect()) > 50  # sorted by time alone: none is skipped
    assert "PushedFilters: [IsNotNull(k), LessThan(k" in back.where("k < 5200")._jdf.queryExecution().executedPlan().toString()


def test_clustering_of_an_empty_table(spark):
    from cartwheel.sinks.cluster import write_clustered

    empty = spark.range(0).selectExpr("id as a", "current_date() as b")
    assert spark.read.parquet(write_clustered(empty, scratch_path(spark, "test-curve-empty"), ["a", "b"], files=4)).count() == 0
