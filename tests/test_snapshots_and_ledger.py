"""Bucketed snapshots, the key index in front of them, and the file ledger."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.key_index import KeyIndex
from cartwheel.session import hadoop_fs, list_dir, scratch_path
from cartwheel.sinks.snapshot import BUCKET, BucketedTable
from cartwheel.streaming import incremental as inc
from cartwheel.streaming.ledger import FileLedger, FileSource

SCHEMA = "order_id bigint, customer_id bigint, order_date timestamp, status string, channel string"


def _bytes(spark, path):
    fs, jpath = hadoop_fs(spark, path)
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0


def _scanned(df, name):
    """What the files that ``df`` reads have behind ``name`` in their paths."""
    return {m.group(1) for f in df.inputFiles() if (m := re.search(name + r"(\d+)", f))}


def _in_range(width):
    return lambda: F.expr(f"k div {width}")


def test_upsert_writes_only_the_buckets_it_touches(spark):
    root = scratch_path(spark, "test-buckets")
    table = BucketedTable(spark, root, "k", place=_in_range(1000))
    table.upsert(spark.range(20_000).selectExpr("id as k", "uuid() as v"))
    whole = _bytes(spark, f"{root}/data/v=000001")
    # 1 % of the keys, in one bucket of twenty
    change = spark.range(3000, 3200).selectExpr("id as k", "'new' as v")
    assert table.upsert(change) == {"touched": 1}
    assert _bytes(spark, f"{root}/data/v=000002") < whole / 10
    assert [n for n in list_dir(spark, f"{root}/data/v=000002") if "=" in n] == [f"{BUCKET}=3"]
    got = table.read()
    assert got.count() == 20_000 and got.where("v = 'new'").agg(F.min("k"), F.max("k"), F.count("*")).first() == (3000, 3199, 200)
    assert _scanned(table.read([3]), "v=") == {"000002"}  # other buckets are not in the scan
    assert _scanned(table.read([3, 4]), f"{BUCKET}=") == {"3", "4"}
    assert table.rows() == 20_000


def test_upsert_equals_a_dictionary_over_many_loads(spark):
    """Random loads with repeated and new keys, types that differ, an empty load."""
    import random

    rng = random.Random(5)
    table = BucketedTable(spark, scratch_path(spark, "test-dict"), ["a", "b"], buckets=5)
    want = {}
    for load in range(5):
        rows = {(rng.randrange(6), rng.choice("xyz")): load * 100 + i for i in range(8)} if load != 2 else {}
        want |= rows
        kind = "a int, b string, v bigint" if load % 2 else "a bigint, b string, v bigint"
        table.upsert(spark.createDataFrame([(a, b, v) for (a, b), v in rows.items()], kind))
    got = {(r["a"], r["b"]): r["v"] for r in table.read().collect()}
    assert got == want and table.read().count() == len(want)


def test_failed_load_leaves_the_version_before(spark):
    table = BucketedTable(spark, scratch_path(spark, "test-failed"), "k", buckets=3)
    table.upsert(spark.range(10).selectExpr("id as k", "1 as v"))
    bad = spark.range(10).selectExpr("id as k", "if(id = 7, raise_error('no'), 2) as v")
    with pytest.raises(Exception, match="no"):
        table.upsert(bad)
    # data of a version that never committed
    spark.range(3).selectExpr("id as k", "9 as v").write.parquet(f"{table.root}/data/v=000002/{BUCKET}=0")
    assert {r["v"] for r in table.read().collect()} == {1} and table.versions() == [1]
    table.upsert(spark.range(5).selectExpr("id as k", "3 as v"))
    assert sorted(r["v"] for r in table.read().collect()) == [1] * 5 + [3] * 5


def test_old_versions_go_and_shared_directories_stay(spark):
    table = BucketedTable(spark, scratch_path(spark, "test-expire"), "k", place=_in_range(10), keep=2)
    for load in range(5):
        table.upsert(spark.range(10 * load, 10 * load + 10).selectExpr("id as k", f"{load} as v"))
    assert table.versions() == [4, 5]
    assert table.read().count() == 50  # bucket 0 is still the first version's directory
    assert sorted({r["path"].split("/")[1] for r in table.manifest() if r["path"]}) == [f"v=00000{n}" for n in range(1, 6)]
    table.upsert(spark.range(50).selectExpr("id as k", "9 as v"))
    table.upsert(spark.range(1).selectExpr("id as k", "8 as v"))
    assert f"{BUCKET}=0" not in list_dir(spark, f"{table.root}/data/v=000001")


def test_append_compact_rebucket(spark):
    table = BucketedTable(spark, scratch_path(spark, "test-append"), "k", buckets=2)
    for part in range(4):
        table.append(spark.range(part * 10, part * 10 + 10).selectExpr("id as k"), tag=f"p{part}")
    assert table.tags() == {"p0", "p1", "p2", "p3"} and len(table.entries().collect()) == 8
    assert table.compact(3) == [0, 1] and len(table.entries().collect()) == 2
    table.rebucket(7)
    again = BucketedTable(spark, table.root, "k")
    assert again.buckets == 7 and again.read().count() == 40 and again.tags() == table.tags()
    again.delete_where(F.col("k") < 5, forget_tag="p0")
    assert again.read().agg(F.min("k")).first()[0] == 5 and "p0" not in again.tags()


def test_key_index_is_exact_and_reads_few_buckets(spark):
    index = KeyIndex(spark, scratch_path(spark, "test-index"), "k", buckets=16, expected=4000)
    index.add(spark.range(4000).selectExpr("id * 2 as k"), "one")
    asked = spark.range(9000).selectExpr("id as k")
    maybe, hit = index.maybe(asked), index.present(asked)
    assert hit.count() == 4000
    assert hit.join(spark.range(4000).selectExpr("id * 2 as k"), "k", "left_anti").count() == 0
    false = maybe.join(hit, "k", "left_anti").count()
    assert false < 0.05 * 5000  # the rest is ruled out by the filter alone
    # keys the filter rules out open no key bucket
    new = spark.createDataFrame([(k,) for k in (100_001, 100_003, 100_005)], "k bigint")
    few = index.keys.buckets_in(index.maybe(new))
    assert len(few) < 3 and _scanned(index.present(new), f"keys/data/.*{BUCKET}=") == {str(b) for b in few}
    # one known key among new ones: one bucket of sixteen is read
    known = new.union(spark.createDataFrame([(8,)], "k bigint"))
    assert [r["k"] for r in index.present(known).collect()] == [8]


def test_key_index_false_positives_are_resolved(spark, monkeypatch):
    """A filter so full that everything may be loaded: answers stay exact."""
    from cartwheel.operators import key_index

    monkeypatch.setattr(key_index, "BITS_PER_KEY", 0)
    index = KeyIndex(spark, scratch_path(spark, "test-full"), "k", buckets=1, expected=1)
    index.add(spark.range(30_000).selectExpr("id as k"), "one")
    asked = spark.range(29_000, 31_000).selectExpr("id as k")
    assert index.maybe(asked).count() > 1500 and index.present(asked).count() == 1000


def test_key_index_batches_and_growth(spark):
    index = KeyIndex(spark, scratch_path(spark, "test-grow"), "k", buckets=2, expected=100)
    index.add(spark.range(100).selectExpr("id as k"), "a")
    index.add(spark.range(100, 200).selectExpr("id as k"), "b")
    asked = spark.range(300).selectExpr("id as k").union(spark.createDataFrame([(None,)], "k bigint"))
    assert index.present(asked).count() == 200 and index.present(asked, without="b").count() == 100
    index.add(spark.range(150, 160).selectExpr("id as k"), "b")  # a repeated batch replaces its own keys
    assert index.present(asked).count() == 110 and index.batches() == {"a", "b"}
    blocks = index.blocks
    index.add(spark.range(1000, 50_000).selectExpr("id as k"), "c")
    assert index.blocks > blocks
    opened = KeyIndex(spark, index.root, "k")
    assert opened.blocks == index.blocks and opened.present(asked).count() == 110
    assert opened.present(spark.range(900, 1100).selectExpr("id as k")).count() == 100


# ---------------------------------------------------------------- ledger


def _orders(spark, ids, day):
    at = dt.datetime(2025, 1, day)
    return spark.createDataFrame([(i, i % 5, at, "paid", "web") for i in ids], SCHEMA)


def _paths(spark, name):
    root = scratch_path(spark, "test-ledger", name)
    return {"target_root": f"{root}/t", "state_root": f"{root}/s", "landing_root": f"{root}/l"}, f"{root}/src"


def _run(spark, source, p, **more):
    return inc.incremental_run(spark, source, key="order_id", ts_col="order_date", **p, **more)


def _ids(spark, p):
    return sorted(r["order_id"] for r in inc.read_loaded(spark, p["target_root"]).collect())


def test_only_new_files_are_read_and_late_rows_load(spark):
    p, src = _paths(spark, "new")
    source = FileSource(src, SCHEMA)
    _orders(spark, range(10), 20).write.parquet(src)
    assert _run(spark, source, p)["loaded"] == 10
    # older, tied and repeated rows in new files
    _orders(spark, range(10, 13), 3).write.mode("append").parquet(src)
    _orders(spark, [13, 4, 5], 20).write.mode("append").parquet(src)
    second = _run(spark, source, p)
    assert (second["extracted"], second["loaded"]) == (6, 4)
    assert _ids(spark, p) == list(range(14))
    before = {k: _bytes(spark, v) for k, v in p.items()}
    assert _run(spark, source, p) == {"since": dt.datetime(2025, 1, 20), "extracted": 0, "loaded": 0}
    assert {k: _bytes(spark, v) for k, v in p.items()} == before  # nothing was written
    landed = spark.read.parquet(p["landing_root"])
    assert landed.count() == 16  # every source row once, not once a run
    audit = {r["batch_id"]: tuple(r)[1:] for r in inc.landing_audit(spark, p["state_root"], p["landing_root"], p["target_root"]).collect()}
    assert {k: v[1:] for k, v in audit.items()} == {"0-000001": (10, 10, 10), "0-000002": (6, 6, 4)}


def test_pending_reads_no_content(spark):
    p, src = _paths(spark, "listing")
    _orders(spark, range(5), 1).write.parquet(src)
    source = FileSource(src, SCHEMA)
    plan = source.listing(spark)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    # a file that only looks like Parquet is listed without being opened
    spark.range(1).selectExpr("'not parquet' as value").coalesce(1).write.text(f"{src}/x")
    assert FileLedger(spark, f"{p['state_root']}/ledger").pending(source).count() == source.listing(spark).count()


def test_a_file_in_slices_of_rows(spark):
    p, src = _paths(spark, "slices")
    _orders(spark, range(10), 1).coalesce(1).write.parquet(src)
    _orders(spark, range(10, 13), 2).coalesce(1).write.mode("append").parquet(src)
    source = FileSource(src, SCHEMA, rows_per_run=4)
    took = [_run(spark, source, p)["extracted"] for _ in range(5)]
    assert took == [7, 4, 2, 0, 0]
    assert _ids(spark, p) == list(range(13))
    entries = FileLedger(spark, f"{p['state_root']}/ledger").entries()
    spans = sorted((r["first_row"], r["next_row"]) for r in entries.collect())
    assert spans == [(0, 3), (0, 4), (4, 8), (8, 10)]


def test_rewritten_file_and_reset(spark):
    p, src = _paths(spark, "rewritten")
    source = FileSource(src, SCHEMA)
    _orders(spark, range(4), 1).coalesce(1).write.parquet(src)
    _run(spark, source, p)
    _orders(spark, range(6), 1).coalesce(1).write.mode("overwrite").parquet(src)
    assert _run(spark, source, p)["loaded"] == 2
    FileLedger(spark, f"{p['state_root']}/ledger").reset()
    again = _run(spark, source, p)
    assert (again["extracted"], again["loaded"]) == (6, 0) and _ids(spark, p) == list(range(6))


def test_run_that_failed_before_its_ledger_entry_is_repeated(spark, monkeypatch):
    """The data was committed, the keys or the ledger entry were not: nothing is lost or doubled."""
    for broken, where in (("record", FileLedger), ("add", KeyIndex)):
        p, src = _paths(spark, f"crash-{broken}")
        source = FileSource(src, SCHEMA)
        _orders(spark, range(5), 1).write.parquet(src)

        def fail(*a, **k):
            raise RuntimeError("lost")

        with monkeypatch.context() as m:
            m.setattr(where, broken, fail)
            with pytest.raises(RuntimeError):
                _run(spark, source, p)
        _orders(spark, range(3, 8), 2).write.mode("append").parquet(src)
        assert _run(spark, source, p)["extracted"] == 10
        assert _ids(spark, p) == list(range(8))
        assert _run(spark, source, p)["extracted"] == 0


def test_empty_files_are_entered_and_not_read_again(spark):
    p, src = _paths(spark, "empty")
    source = FileSource(src, SCHEMA)
    _orders(spark, [], 1).write.parquet(src)
    assert _run(spark, source, p)["extracted"] == 0
    ledger = FileLedger(spark, f"{p['state_root']}/ledger")
    assert ledger.pending(source).count() == 0


def test_loaded_files_are_sorted_by_time(spark):
    """T5: every file of a batch is in time order, so row groups have tight bounds."""
    p, src = _paths(spark, "sorted")
    rows = [(i, 1, dt.datetime(2025, 1, 1) + dt.timedelta(hours=(i * 37) % 500), "paid", "web") for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(src)
    _run(spark, FileSource(src, SCHEMA), p)
    target = inc.read_loaded(spark, p["target_root"]).select(
        "order_date", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")
    )
    files = {}
    for r in sorted(target.collect(), key=lambda r: (r["f"], r["i"])):
        files.setdefault(r["f"], []).append(r["order_date"])
    assert sum(map(len, files.values())) == 400 and all(v == sorted(v) for v in files.values())
