"""What the plans must not do however large the tables are: shuffle stored rows
again for a number, hold a table in hash tables, or land pages uncompressed.
Broadcasts by size are off, so small rows are planned as large ones are."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.dimensions import lookup_key
from cartwheel.operators.numbering import dense_row_number
from cartwheel.operators.quality import TableRules, check_table
from cartwheel.plans import analytics, marketplace, warehouse
from cartwheel.sources import fixtures as fx


@pytest.fixture
def large(spark):
    """Plans as for tables that are too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_are_attached_without_a_shuffle(large):
    rows = large.createDataFrame([(i * 7 % 50, f"t{i}") for i in range(50)], "k bigint, t string")
    out = dense_row_number(rows, ["k"], "n", rows=50)
    assert "Exchange hash" not in _plan(out) and "SortMergeJoin" not in _plan(out)
    assert [r["n"] for r in out.orderBy("k").collect()] == list(range(1, 51))


def test_more_rows_make_more_ranges(spark, monkeypatch):
    monkeypatch.setattr("cartwheel.operators.numbering.ROWS_PER_RANGE", 10)
    out = dense_row_number(spark.range(0, 200), [F.col("id").desc()], "n", rows=200)
    assert sum("/numbered/" in f for f in out.inputFiles()) > 8
    assert [r["n"] for r in out.orderBy(F.desc("id")).collect()] == list(range(1, 201))


def test_lookup_in_a_fixed_list_leaves_the_facts_where_they_are(large):
    facts = large.createDataFrame([(1, "web"), (2, "mobile_app"), (3, None), (4, "fax")], "order_id bigint, channel string")
    out = lookup_key(facts, warehouse.dim_store_frame(large), "channel", "channel_code", "store_key", "unknown_member", small=True)
    assert "SortMergeJoin" not in _plan(out)
    assert {r["order_id"]: r["store_key"] for r in out.collect()} == {1: 1, 2: 2, 3: -1, 4: -1}


def test_fact_sales_numbers_narrow_rows(spark):
    items = spark.createDataFrame(
        [(5, 1, 1, 2, "3.00"), (9, 1, 2, 1, "4.00"), (7, 2, 9, 1, "1.00")],
        "order_item_id bigint, order_id bigint, product_id bigint, quantity bigint, unit_price string",
    ).withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)"))
    orders = spark.createDataFrame(
        [(1, 4, "web"), (2, 4, "web")], "order_id bigint, customer_id bigint, channel string"
    ).select("order_id", "customer_id", F.lit("2026-01-05").cast("timestamp").alias("order_date"), F.lit("shipped").alias("status"), "channel")
    products = spark.createDataFrame([(1, "1.00"), (2, "2.50")], "product_id bigint, unit_cost string").withColumn(
        "unit_cost", F.col("unit_cost").cast("decimal(10,2)")
    )
    customers = spark.createDataFrame([(11, 4, 1)], "customer_key bigint, customer_id bigint, is_current int")
    out = warehouse.fact_sales_frame(items, orders, products, customers, warehouse.dim_store_frame(spark))
    assert not {"extended_price", "gross_margin", "promotion_key"} & set(re.findall(r"(\w+)#\d+", _plan(out).split("FileScan", 1)[1]))
    got = [(r["sales_key"], r["order_item_id"], float(r["extended_price"]), float(r["gross_margin"]), r["date_key"]) for r in out.orderBy("sales_key").collect()]
    assert got == [(1, 5, 6.0, 4.0, 20260105), (2, 9, 4.0, 1.5, 20260105)]


def test_groups_of_a_primary_key_carry_only_a_count(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, None)], "id bigint, c string")
    out = check_table(df, TableRules("t", ["id", "c"], [["id"]], {"is_a": F.col("c") == "a"}), {})
    keyed = [x for x in _plan(out).splitlines() if "HashAggregate(keys=[id" in x]
    assert keyed and all(x.split("functions=")[1].count("count(") == 1 for x in keyed)
    assert {r["rule"]: r["violations"] for r in out.collect()} == {"not_null(id)": 2, "not_null(c)": 2, "check(is_a)": 1, "unique(id)": 1}


def test_category_months_take_no_number_and_no_product_groups(large, sf_dir):
    plan = _plan(analytics.category_month_change(large, sf_dir))
    assert "_cw_mid" not in plan and not re.search(r"HashAggregate\(keys=\[product_id", plan)
    plain = fx.order_items(large, sf_dir).drop("order_item_id")
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, fx.order_items_unnumbered(large, sf_dir).collect()))


def test_declining_by_channel_groups_few_rows(large, sf_dir):
    assert not re.search(r"keys=\[[^\]]*product_key", _plan(warehouse.star_declining_by_channel(large, sf_dir)))


def test_pages_are_grouped_after_the_shuffle(spark):
    records = spark.createDataFrame([(1, 3, "a"), (1, 1, "b"), (2, 2, "c")], "page bigint, seq bigint, marketplace_order_id string")
    out = marketplace.build_pages(records)
    # the records travel as they are: REPARTITION_BY_COL lies below the grouping
    assert "REPARTITION_BY_COL" in _plan(out).split("partial_collect_list")[-1]
    assert {r["page"]: [x[0] for x in r["results"]] for r in out.collect()} == {1: ["b", "a"], 2: ["c"]}


def test_landed_pages_are_gzip(spark, sf_dir):
    files = marketplace.landed_pages(spark, sf_dir).inputFiles()
    assert files and all(f.endswith(".json.gz") for f in files)
