"""Invariants of the end-to-end queries on the driver tables (checked with
Spark aggregates, nothing large is collected)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.plans import incremental, marketplace, warehouse
from cartwheel.sources import fixtures as fx


def _one(df):
    return df.first()[0]


def test_scd2_one_current_version_and_no_overlap(spark, sf_dir):
    v = warehouse.scd2_merge_query(spark, sf_dir)
    per_key = v.groupBy("customer_id").agg(F.count_if(F.col("is_current") == 1).alias("cur"))
    assert _one(per_key.agg(F.max("cur"))) == 1
    assert _one(per_key.agg(F.min("cur"))) == 1
    assert v.select("customer_key").distinct().count() == v.count()
    w = Window.partitionBy("customer_id").orderBy("valid_from")
    nxt = v.select("valid_to", F.lead("valid_from").over(w).alias("next_from"), "is_current")
    # a closed version ends where the next one starts; the current one is open
    assert nxt.where(F.col("next_from").isNotNull() & (F.col("valid_to") != F.col("next_from"))).count() == 0
    assert nxt.where((F.col("is_current") == 1) & F.col("valid_to").isNotNull()).count() == 0
    # every customer of the source has a version
    assert fx.customers(spark, sf_dir).join(v, "customer_id", "left_anti").count() == 0


def test_marketplace_clean_plus_quarantine_is_input(spark, sf_dir):
    flat = marketplace.page_flatten(spark, sf_dir)
    clean = marketplace.clean_marketplace(spark, sf_dir)
    rejects = marketplace.marketplace_quarantine(spark, sf_dir)
    assert clean.count() + rejects.count() == flat.count()
    assert clean.select("source_order_id").distinct().count() == clean.count()


def test_incremental_target_keys_unique_and_complete(spark, sf_dir):
    for q in (incremental.incremental_reset, incremental.incremental_stream):
        t = q(spark, sf_dir)
        assert t.select("order_id").distinct().count() == t.count()
        assert fx.orders(spark, sf_dir).join(t, "order_id", "left_anti").count() == 0


def test_dimension_member_counts_cover_all_orders(spark, sf_dir):
    n = fx.orders(spark, sf_dir).count()
    for q in (warehouse.dim_store_query, warehouse.dim_promotion_query):
        d = q(spark, sf_dir)
        assert _one(d.agg(F.sum("orders"))) == n
    assert warehouse.dim_promotion_query(spark, sf_dir).count() == len(warehouse.PROMOTIONS)


def test_returns_ids_unique_and_only_flagged_items(spark, sf_dir):
    r = fx.returns(spark, sf_dir)
    assert r.select("return_id").distinct().count() == r.count()
    flagged = fx.order_items_with_flag(spark, sf_dir).where(F.col("l_returnflag") == "R").select("order_item_id")
    assert r.select("order_item_id").join(flagged, "order_item_id", "left_anti").count() == 0


def test_tables_of_a_set_become_current_together(spark, sf_dir, monkeypatch):
    """A refresh that fails at its last table leaves all seven old ones."""
    from cartwheel.sinks.materialize import read_set

    before = warehouse.build(spark, sf_dir)
    files = {n: sorted(t.inputFiles()) for n, t in before.items()}
    assert set(files) == set(warehouse.TABLES)

    def fail(*a):
        raise RuntimeError("no space")

    with monkeypatch.context() as m:
        m.setattr(warehouse, "fact_returns_frame", fail)
        try:
            warehouse.build(spark, sf_dir, refresh=True)
            raise AssertionError("the build did not fail")
        except RuntimeError as e:
            assert str(e) == "no space"
    for tables in (warehouse.build(spark, sf_dir), read_set(spark, f"warehouse|{sf_dir}")):
        assert {n: sorted(t.inputFiles()) for n, t in tables.items()} == files
    after = warehouse.build(spark, sf_dir, refresh=True)
    assert all(sorted(after[n].inputFiles()) != files[n] for n in files)
    assert all(sorted(after[n].inputFiles()) == sorted(t.inputFiles()) for n, t in read_set(spark, f"warehouse|{sf_dir}").items())
    assert all(after[n].count() == before[n].count() for n in files)  # the old files are still there to read
