"""Questions over hot keys, versions and histories.

Each runs one of the operators for large or late data on the domain's tables:
``skew_join`` where one customer has a third of the orders, ``asof_merge``
against long version lists, ``SnapshotHistory`` for snapshots that arrive out
of order, and ``KeyRegistry`` for surrogate keys that survive a refresh.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import money
from ..operators.asof import asof_merge
from ..operators.intervals import SnapshotHistory
from ..operators.key_registry import KeyRegistry
from ..operators.skew import skew_join
from ..oracle import with_fixtures
from ..session import scratch_path
from ..sinks.cluster import write_clustered
from ..sources import fixtures as fx
from . import warehouse

#: Every third order goes to this customer, so one key holds a third of the rows.
RESELLER = 1


def reseller_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, J2, J13 with a hot key: paid revenue by country and channel when one
    customer places a third of the orders; the payments meet the customers row
    by row, the hot customer's over as many tasks as its share is worth."""
    o = fx.orders(spark, sf_dir).select(
        "order_id", F.when(F.col("order_id") % 3 == 0, RESELLER).otherwise(F.col("customer_id")).cast("bigint").alias("customer_id"), "channel"
    )
    paid = fx.payments(spark, sf_dir).where(F.col("status") == "paid").select("order_id", "amount").join(o, "order_id")
    named = skew_join(paid, fx.customers(spark, sf_dir).select("customer_id", "country"), "customer_id")
    return (
        named.groupBy("country", "channel")
        .agg(F.count(F.lit(1)).alias("payments"), money(F.sum("amount")).alias("revenue"))
        .orderBy("country", "channel")
    )


def asof_customer_version_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J16 by merging: each order with the customer version valid at its date."""
    versions = warehouse.scd2_merge_query(spark, sf_dir).select("customer_id", "customer_key", "city", "valid_from", "valid_to")
    o = fx.orders(spark, sf_dir).select("order_id", "customer_id", "order_date")
    return asof_merge(o, versions, "customer_id", "order_date", "customer_key").select(
        "order_id", "customer_id", "order_date", "customer_key", "city"
    )


def price_at_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J16 against long version lists: the product's list price when it was
    returned. A product's price of a day (the highest it was sold at) holds
    until its next day with sales."""
    items = fx.order_items(spark, sf_dir).join(fx.orders(spark, sf_dir).select("order_id", "order_date"), "order_id")
    daily = items.groupBy("product_id", F.to_date("order_date").alias("valid_from")).agg(F.max("unit_price").alias("price"))
    until = F.lead("valid_from").over(Window.partitionBy("product_id").orderBy("valid_from"))
    prices = daily.withColumn("valid_to", until).withColumn("price_day", F.date_format("valid_from", "yyyyMMdd").cast("bigint"))
    returned = fx.returns(spark, sf_dir).join(fx.order_items(spark, sf_dir).select("order_item_id", "product_id"), "order_item_id")
    found = asof_merge(returned.select("return_id", "product_id", "return_date"), prices, "product_id", "return_date", "price_day")
    return found.select("return_id", "product_id", "return_date", "price_day", F.col("price").cast("double").alias("price"))


#: Snapshot dates in the order in which they arrive.
SNAPSHOTS = [dt.date(1996, 1, 1), dt.date(1998, 1, 1), dt.date(1997, 1, 1)]


def _snapshot(customers: DataFrame, date: dt.date) -> DataFrame:
    """The customers signed up by ``date``; a third moves each year, every tenth
    is missing from the 1997 export, every eleventh has no city then."""
    c, year = F.col("customer_id"), date.year
    city: Column = F.when((c + year) % 3 == 0, F.lit(f"moved {year}")).otherwise(F.col("city"))
    if year == 1997:
        city = F.when(c % 11 != 0, city)
        customers = customers.where(c % 10 != 3)
    return customers.where(F.col("signup_date") < F.lit(date)).select("customer_id", city.alias("city"), "country")


def customer_history_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' history from three snapshots, the middle one last."""
    history = SnapshotHistory(spark, scratch_path(spark, "customer_history"), "customer_id", ["city", "country"])
    customers = fx.customers(spark, sf_dir)
    for date in SNAPSHOTS:
        history.apply(_snapshot(customers, date), date)
    return history.versions()


#: The first load has the customers, and the items of orders, before these days.
FIRST_SIGNUPS, FIRST_ORDERS = "1994-07-01", "1996-01-01"


def dim_customer_stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers numbered over two loads; the refresh brings customers
    with ids between the first ones and moves no key."""
    registry = KeyRegistry(spark, scratch_path(spark, "customer_keys"), "customer_id", "customer_key")
    customers = fx.customers(spark, sf_dir)
    registry.register(customers.where(F.col("signup_date") < F.lit(FIRST_SIGNUPS).cast("date")), "first")
    registry.register(customers, "refresh")
    return registry.attach(customers.select("customer_id", "email", "country"))


def fact_sales_stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales keys over two loads, the second with items between the first ones."""
    registry = KeyRegistry(spark, scratch_path(spark, "sales_keys"), ["order_id", "order_item_id"], "sales_key")
    items = fx.order_items(spark, sf_dir).join(fx.orders(spark, sf_dir).select("order_id", "order_date"), "order_id")
    registry.register(items.where(F.col("order_date") < F.lit(FIRST_ORDERS).cast("timestamp")), "first")
    registry.register(items, "refresh")
    return registry.attach(items.select("order_id", "order_item_id", "quantity"))


#: A month and a stretch of order ids that the next query asks for.
ASKED_MONTH, ASKED_IDS = ("1996-03-01", "1996-04-01"), (1000, 9000)


def clustered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, laid out along a curve over (order_date, order_id), asked
    by either column: per question the orders and their customers."""
    path = write_clustered(fx.orders(spark, sf_dir), scratch_path(spark, "orders_by_curve"), ["order_date", "order_id"], files=32)
    o = spark.read.parquet(path)
    day = lambda d: F.lit(d).cast("timestamp")
    month = o.where((F.col("order_date") >= day(ASKED_MONTH[0])) & (F.col("order_date") < day(ASKED_MONTH[1])))
    ids = o.where(F.col("order_id").between(*ASKED_IDS))
    ask = lambda name, rows: rows.agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("customer_id").alias("customers"), F.sum("order_id").alias("id_sum")
    ).select(F.lit(name).alias("question"), "*")
    return ask("month", month).unionByName(ask("ids", ids))


# ---------------------------------------------------------------- oracle SQL


def _snapshot_sql(date: dt.date) -> str:
    year = date.year
    city = f"CASE WHEN (customer_id + {year}) % 3 = 0 THEN 'moved {year}' ELSE city END"
    where = f"signup_date < DATE '{date}'"
    if year == 1997:
        city, where = f"CASE WHEN customer_id % 11 <> 0 THEN {city} END", where + " AND customer_id % 10 <> 3"
    return f"SELECT customer_id, {city} AS city, country, DATE '{date}' AS day FROM customers WHERE {where}"


SQL = {
    "reseller_revenue": f"""
SELECT c.country, o.channel, COUNT(*) AS payments, CAST(ROUND(SUM(p.amount), 2) AS DOUBLE) AS revenue
FROM payments p JOIN sales_orders o USING (order_id)
JOIN customers c ON c.customer_id = CASE WHEN o.order_id % 3 = 0 THEN {RESELLER} ELSE o.customer_id END
WHERE p.status = 'paid' GROUP BY ALL ORDER BY 1, 2""",
    "asof_customer_version_merged": warehouse.SQL["asof_customer_version"],
    "price_at_return": """
WITH daily AS (
  SELECT i.product_id, CAST(o.order_date AS DATE) AS d, MAX(i.unit_price) AS price
  FROM order_items i JOIN sales_orders o USING (order_id) GROUP BY ALL
), returned AS (SELECT r.return_id, i.product_id, r.return_date FROM returns r JOIN order_items i USING (order_item_id))
SELECT r.return_id, r.product_id, r.return_date, CAST(strftime(d.d, '%Y%m%d') AS BIGINT) AS price_day,
       CAST(d.price AS DOUBLE) AS price
FROM returned r ASOF JOIN daily d ON r.product_id = d.product_id AND r.return_date >= d.d""",
    "customer_history_any_order": f"""
WITH seen AS ({' UNION ALL '.join(_snapshot_sql(d) for d in sorted(SNAPSHOTS))}),
opened AS (
  SELECT *, ROW_NUMBER() OVER w AS n, LAG(city) OVER w AS city_before, LAG(country) OVER w AS country_before
  FROM seen WINDOW w AS (PARTITION BY customer_id ORDER BY day)
  QUALIFY n = 1 OR city IS DISTINCT FROM city_before OR country IS DISTINCT FROM country_before
)
SELECT customer_id, city, country, day AS valid_from, LEAD(day) OVER (PARTITION BY customer_id ORDER BY day) AS valid_to,
       CASE WHEN LEAD(day) OVER (PARTITION BY customer_id ORDER BY day) IS NULL THEN 1 ELSE 0 END AS is_current
FROM opened""",
    "clustered_orders": f"""
SELECT 'month' AS question, COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS customers, SUM(order_id)::BIGINT AS id_sum
FROM sales_orders WHERE order_date >= TIMESTAMP '{ASKED_MONTH[0]}' AND order_date < TIMESTAMP '{ASKED_MONTH[1]}'
UNION ALL
SELECT 'ids', COUNT(*), COUNT(DISTINCT customer_id), SUM(order_id)::BIGINT
FROM sales_orders WHERE order_id BETWEEN {ASKED_IDS[0]} AND {ASKED_IDS[1]}""",
    "dim_customer_stable_keys": f"""
SELECT customer_id, email, country,
       ROW_NUMBER() OVER (ORDER BY signup_date >= DATE '{FIRST_SIGNUPS}', customer_id) AS customer_key
FROM customers""",
    "fact_sales_stable_keys": f"""
SELECT i.order_id, i.order_item_id, i.quantity,
       ROW_NUMBER() OVER (ORDER BY o.order_date >= TIMESTAMP '{FIRST_ORDERS}', i.order_id, i.order_item_id) AS sales_key
FROM order_items i JOIN sales_orders o USING (order_id)""",
}

QUERIES = {
    "clustered_orders": clustered_orders,
    "reseller_revenue": reseller_revenue,
    "asof_customer_version_merged": asof_customer_version_merged,
    "price_at_return": price_at_return,
    "customer_history_any_order": customer_history_any_order,
    "dim_customer_stable_keys": dim_customer_stable_keys,
    "fact_sales_stable_keys": fact_sales_stable_keys,
}
ORACLE = {name: with_fixtures(sql) for name, sql in SQL.items()}
