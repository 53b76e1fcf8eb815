"""Star-schema warehouse (D1-D10, J11-J16, K10, K12) and its questions.

``build`` derives the five dimensions and two facts from the OLTP tables and
writes each once per application as a Parquet table in the checkpoint
folder (``refresh=True`` rebuilds them all, K10); every star question then
starts from Parquet scans. Only the fixed list of stores carries a broadcast
hint: adaptive execution measures the others and broadcasts the small ones. The
star questions aggregate the fact on its foreign keys *before* attaching the
dimension attributes, so the joins see one row per key, not per sale, except
where about every sale is a key of its own (declining categories).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_key, month_bucket
from ..functions.numeric import money, pct
from ..operators.dimensions import asof_version, attach_calendar, lookup_key, promotion_bucket, scd2_merge
from ..operators.numbering import dense_row_number
from ..oracle import register, with_fixtures
from ..sinks.materialize import materialized, materialized_set
from ..sinks.writers import table_counts
from ..sources import fixtures as fx

# Channel -> store (key, code, name, type) and promotions
# (key, code, name, discount %). Key 0 is the "no promotion" member.
STORES = [
    (1, "web", "Web Storefront", "direct"),
    (2, "mobile_app", "Mobile App", "direct"),
    (3, "marketplace", "Third-Party Marketplace", "third_party"),
]
PROMOTIONS = [
    (0, "NONE", "No Promotion", 0.0),
    (1, "SPRING10", "Spring Sale 10%", 10.0),
    (2, "FLASH20", "Flash Sale 20%", 20.0),
    (3, "WELCOME15", "New Customer 15%", 15.0),
]

STORE_SCHEMA = "store_key bigint, channel_code string, channel_name string, channel_type string"
PROMO_SCHEMA = "promotion_key bigint, promotion_code string, promotion_name string, discount_pct decimal(5,2)"


def dim_store_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STORES, STORE_SCHEMA)


def dim_promotion_frame(spark: SparkSession) -> DataFrame:
    import decimal

    rows = [(k, c, n, decimal.Decimal(str(d))) for k, c, n, d in PROMOTIONS]
    return spark.createDataFrame(rows, PROMO_SCHEMA)


def dim_date_frame(dates: DataFrame) -> DataFrame:
    """One row per day between the first and last date in ``dates`` (column ``d``)."""
    bounds = dates.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).where(F.col("lo").isNotNull())
    # years first, spread over the tasks, then their days: a bad date far off
    # makes a long calendar but no task makes all of it
    years = bounds.select("lo", "hi", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("_y")).repartition("_y")
    first = F.greatest("lo", F.make_date("_y", F.lit(1), F.lit(1)))
    last = F.least("hi", F.make_date("_y", F.lit(12), F.lit(31)))
    days = years.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").cast("bigint").alias("year"),
        F.quarter("full_date").cast("bigint").alias("quarter"),
        F.month("full_date").cast("bigint").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofmonth("full_date").cast("bigint").alias("day_of_month"),
        F.date_format("full_date", "EEEE").alias("day_of_week"),
        F.when(F.weekday("full_date") >= 5, 1).otherwise(0).alias("is_weekend"),
    )


def dim_customer_frame(customers: DataFrame) -> DataFrame:
    """One current type 2 version per customer, valid from signup."""
    numbered = dense_row_number(customers, ["customer_id"], "customer_key", rows=customers.count())
    return numbered.select(
        "customer_key",
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "country",
        "city",
        "signup_date",
        F.col("signup_date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(1).alias("is_current"),
    )


def dim_product_frame(products: DataFrame) -> DataFrame:
    """D3: type 1, surrogate key = natural id."""
    return products.select(
        F.col("product_id").alias("product_key"),
        "product_name",
        "category",
        "unit_price",
        "unit_cost",
        "active",
    )


def fact_sales_frame(
    items: DataFrame, orders: DataFrame, products: DataFrame, dim_customer: DataFrame, dim_store: DataFrame,
    policy: str = "fail",
) -> DataFrame:
    """grain = order item; keys resolved by joins."""
    current = dim_customer.where(F.col("is_current") == 1)
    o = orders.select("order_id", "customer_id", "order_date", "status", "channel")
    o = lookup_key(o, current, "customer_id", "customer_id", "customer_key", policy)
    o = lookup_key(o, dim_store, "channel", "channel_code", "store_key", policy, small=True)
    o = o.select("order_id", date_key("order_date").alias("date_key"), "customer_key", "store_key", "status")
    p = products.select("product_id", "unit_cost")
    # the narrow items meet the products first, so neither join moves more than it needs;
    # what follows from other columns is computed after the numbering
    lines = items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price").join(p, "product_id")
    numbered = dense_row_number(lines.join(o, "order_id"), ["order_item_id"], "sales_key", rows=items.count())
    ext = F.col("quantity") * F.col("unit_price")
    return numbered.select(
        "sales_key",
        "order_id",
        "order_item_id",
        "date_key",
        "customer_key",
        F.col("product_id").alias("product_key"),
        "store_key",
        promotion_bucket(F.col("order_id")).alias("promotion_key"),
        F.col("status").alias("order_status"),
        "quantity",
        "unit_price",
        ext.cast("decimal(18,2)").alias("extended_price"),
        "unit_cost",
        (ext - F.col("quantity") * F.col("unit_cost")).cast("decimal(18,2)").alias("gross_margin"),
    )


def fact_returns_frame(
    returns: DataFrame, items: DataFrame, orders: DataFrame, dim_customer: DataFrame, policy: str = "fail"
) -> DataFrame:
    """grain = return event; refund = full item quantity x price."""
    current = dim_customer.where(F.col("is_current") == 1)
    o = lookup_key(orders.select("order_id", "customer_id"), current, "customer_id", "customer_id", "customer_key", policy)
    f = returns.join(items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price"), "order_item_id")
    base = f.join(o, "order_id").select(
        "return_id",
        "order_item_id",
        date_key("return_date").alias("date_key"),
        "customer_key",
        F.col("product_id").alias("product_key"),
        "reason",
        F.col("quantity").alias("returned_quantity"),
        (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)").alias("refund_amount"),
    )
    return dense_row_number(base, ["return_id"], "return_key", rows=returns.count()).select("return_key", *base.columns)


TABLES = ["dim_date", "dim_customer", "dim_product", "dim_store", "dim_promotion", "fact_sales", "fact_returns"]


def build(spark: SparkSession, sf_dir: str, refresh: bool = False) -> dict[str, DataFrame]:
    """All warehouse tables, written once per application and read back;
    ``refresh`` rebuilds them from the sources as they are now. The seven
    become current together: a build that fails leaves the earlier seven."""
    if refresh:
        fx.order_items_with_flag(spark, sf_dir, refresh=True)
        fx.returns(spark, sf_dir, refresh=True)
    return materialized_set(spark, f"warehouse|{sf_dir}", _builders(spark, sf_dir), refresh)


def _builders(spark: SparkSession, sf_dir: str) -> dict:
    """Per table what makes it from the tables before it; source frames are made
    inside, so once the tables exist a call only looks them up."""
    orders = lambda: fx.orders(spark, sf_dir)
    items = lambda: fx.order_items(spark, sf_dir)
    returns = lambda: fx.returns(spark, sf_dir)
    products = lambda: fx.products(spark, sf_dir)
    days = lambda: orders().select(F.to_date("order_date").alias("d")).unionByName(
        returns().select(F.to_date("return_date").alias("d"))
    )
    return {
        "dim_store": lambda t: dim_store_frame(spark),
        "dim_promotion": lambda t: dim_promotion_frame(spark),
        "dim_product": lambda t: dim_product_frame(products()),
        "dim_customer": lambda t: dim_customer_frame(fx.customers(spark, sf_dir)),
        "dim_date": lambda t: dim_date_frame(days()),
        "fact_sales": lambda t: fact_sales_frame(items(), orders(), products(), t["dim_customer"], t["dim_store"]),
        "fact_returns": lambda t: fact_returns_frame(returns(), items(), orders(), t["dim_customer"]),
    }


def _money_out(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE for output (values are exact 2-decimal amounts)."""
    return df.select(
        *[F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema]
    )


def _table_query(name: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _money_out(build(spark, sf_dir)[name])

    q.__name__ = name
    q.__doc__ = f"The warehouse table {name}."
    return q


def dim_store_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 as a question: every store member with the number of orders placed
    through its channel (0 when none). The per-channel count is a partial
    aggregate over all orders (one row per channel leaves each map task), so
    a channel holding most orders is reduced before the shuffle."""
    t = build(spark, sf_dir)
    per_channel = (
        fx.orders(spark, sf_dir)
        .groupBy(F.col("channel").alias("channel_code"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return t["dim_store"].join(per_channel, "channel_code", "left").select(
        *t["dim_store"].columns, F.coalesce(F.col("orders"), F.lit(0)).cast("bigint").alias("orders")
    )


def dim_promotion_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 as a question: every promotion member (0 = none) with the number of
    orders the deterministic pick assigns to it, counted over all orders."""
    t = build(spark, sf_dir)
    per_promo = (
        fx.orders(spark, sf_dir)
        .groupBy(promotion_bucket(F.col("order_id")).alias("promotion_key"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    dim = t["dim_promotion"]
    return _money_out(
        dim.join(per_promo, "promotion_key", "left").select(
            *dim.columns, F.coalesce(F.col("orders"), F.lit(0)).cast("bigint").alias("orders")
        )
    )


def warehouse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per warehouse table."""
    t = build(spark, sf_dir)
    return table_counts({n: t[n] for n in TABLES})


def _sales(t: dict[str, DataFrame]) -> DataFrame:
    return t["fact_sales"].where(F.col("order_status") != "cancelled")


def star_category_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by category and channel, highest first."""
    t = build(spark, sf_dir)
    per_key = _sales(t).groupBy("product_key", "store_key").agg(F.sum("extended_price").alias("rev"))
    joined = per_key.join(t["dim_product"].select("product_key", "category"), "product_key").join(
        t["dim_store"].select("store_key", "channel_name"), "store_key"
    )
    return (
        joined.groupBy("category", "channel_name")
        .agg(money(F.sum("rev")).alias("revenue"))
        .orderBy(F.desc("revenue"), "category", "channel_name")
    )


def star_margin_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and margin by month and store, via the calendar dimension."""
    t = build(spark, sf_dir)
    per_key = _sales(t).groupBy("date_key", "store_key").agg(
        F.sum("extended_price").alias("rev"), F.sum("gross_margin").alias("mar")
    )
    d = t["dim_date"].select("date_key", "year", "month")
    s = t["dim_store"].select("store_key", "channel_name")
    return (
        attach_calendar(per_key, d)
        .join(s, "store_key")
        .groupBy("year", "month", "channel_name")
        .agg(money(F.sum("rev")).alias("revenue"), money(F.sum("mar")).alias("gross_margin"))
        .orderBy("year", "month", "channel_name")
    )


def star_margin_by_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Did promotions move margin, not only volume."""
    t = build(spark, sf_dir)
    per_order = _sales(t).groupBy("promotion_key", "order_id").agg(
        F.sum("quantity").alias("units"), F.sum("extended_price").alias("rev"), F.sum("gross_margin").alias("mar")
    )
    per_promo = per_order.groupBy("promotion_key").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("units").cast("bigint").alias("units"),
        F.sum("rev").alias("rev"),
        F.sum("mar").alias("mar"),
    )
    p = t["dim_promotion"].select("promotion_key", "promotion_code", "promotion_name")
    return per_promo.join(p, "promotion_key").select(
        "promotion_code",
        "promotion_name",
        "orders",
        "units",
        money(F.col("rev")).alias("revenue"),
        money(F.col("mar")).alias("gross_margin"),
        pct(F.col("mar"), F.col("rev")).alias("margin_pct"),
    ).orderBy("promotion_code")


def star_clv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifetime value per customer, then the repeat-purchase rate (one row)."""
    t = build(spark, sf_dir)
    per_order = _sales(t).groupBy("customer_key", "order_id").agg(F.sum("extended_price").alias("rev"))
    per_customer = per_order.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("rev").alias("clv")
    )
    return per_customer.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("n_orders") >= 2).alias("repeat_customers"),
        pct(F.count_if(F.col("n_orders") >= 2), F.count(F.lit(1))).alias("repeat_rate_pct"),
        F.round(F.avg(F.col("clv").cast("double")), 2).alias("avg_lifetime_value"),
        money(F.max("clv")).alias("max_lifetime_value"),
    )


def star_return_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned units per category and reason against units sold per
    category (two pre-aggregated facts joined on category)."""
    t = build(spark, sf_dir)
    cat = t["dim_product"].select("product_key", "category")
    sold = (
        t["fact_sales"].groupBy("product_key").agg(F.sum("quantity").alias("q"))
        .join(cat, "product_key")
        .groupBy("category")
        .agg(F.sum("q").cast("bigint").alias("units_sold"))
    )
    ret = (
        t["fact_returns"].groupBy("product_key", "reason").agg(
            F.count(F.lit(1)).alias("n"), F.sum("returned_quantity").alias("q"), F.sum("refund_amount").alias("r")
        )
        .join(cat, "product_key")
        .groupBy("category", "reason")
        .agg(
            F.sum("n").cast("bigint").alias("returns"),
            F.sum("q").cast("bigint").alias("returned_units"),
            money(F.sum("r")).alias("refund_amount"),
        )
    )
    return (
        ret.join(sold, "category")
        .withColumn("return_rate_pct", pct(F.col("returned_units"), F.col("units_sold")))
        .orderBy("category", "reason")
    )


def star_questions_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly revenue question split by channel and promotion."""
    t = build(spark, sf_dir)
    per_key = _sales(t).groupBy("date_key", "store_key", "promotion_key").agg(F.sum("extended_price").alias("rev"))
    d = t["dim_date"].select("date_key", month_bucket("full_date").alias("month"))
    s = t["dim_store"].select("store_key", "channel_name")
    p = t["dim_promotion"].select("promotion_key", "promotion_code")
    return (
        attach_calendar(per_key, d)
        .join(s, "store_key")
        .join(p, "promotion_key")
        .groupBy("month", "channel_name", "promotion_code")
        .agg(money(F.sum("rev")).alias("revenue"))
        .orderBy("month", "channel_name", "promotion_code")
    )


def star_margin_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, margin and margin share by category."""
    t = build(spark, sf_dir)
    per_product = _sales(t).groupBy("product_key").agg(
        F.sum("extended_price").alias("rev"), F.sum("gross_margin").alias("mar")
    )
    return (
        per_product.join(t["dim_product"].select("product_key", "category"), "product_key")
        .groupBy("category")
        .agg(F.sum("rev").alias("rev"), F.sum("mar").alias("mar"))
        .select(
            "category",
            money(F.col("rev")).alias("revenue"),
            money(F.col("mar")).alias("gross_margin"),
            pct(F.col("mar"), F.col("rev")).alias("margin_pct"),
        )
        .orderBy("category")
    )


def _sold_and_returned(t: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """Units sold (all items) and units and events returned per ``by`` (columns
    of the sale); returns take the attributes of the item they return."""
    item = t["fact_sales"].select("order_item_id", "quantity", *by)
    returned = t["fact_returns"].groupBy("order_item_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("returned_quantity").alias("units")
    )
    zero = F.lit(0)
    return (
        item.join(returned, "order_item_id", "left")
        .groupBy(*by)
        .agg(
            F.sum("quantity").cast("bigint").alias("units_sold"),
            F.sum(F.coalesce("events", zero)).cast("bigint").alias("returns"),
            F.sum(F.coalesce("units", zero)).cast("bigint").alias("returned_units"),
        )
    )


def star_return_rate_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return rate of every product that was sold."""
    t = build(spark, sf_dir)
    rates = _sold_and_returned(t, ["product_key"]).withColumn(
        "return_rate_pct", pct(F.col("returned_units"), F.col("units_sold"))
    )
    return rates.join(t["dim_product"].select("product_key", "product_name"), "product_key").orderBy("product_key")


def _named(df: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """Channel name and promotion code in place of the keys."""
    s = t["dim_store"].select("store_key", "channel_name")
    p = t["dim_promotion"].select("promotion_key", "promotion_code")
    return df.join(s, "store_key").join(p, "promotion_key").drop("store_key", "promotion_key")


def star_return_rate_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The return question by channel and promotion."""
    t = build(spark, sf_dir)
    rates = _named(_sold_and_returned(t, ["store_key", "promotion_key"]), t)
    return rates.withColumn("return_rate_pct", pct(F.col("returned_units"), F.col("units_sold"))).orderBy(
        "channel_name", "promotion_code"
    )


def star_top_customers_by_channel(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """The k customers of highest revenue in every channel (ties by key).

    The rank is taken on one row per customer and channel; names join k rows
    per channel only. Spark keeps just the first k of each channel in the map
    tasks (a group limit below the window), so a channel holding most
    customers does not travel to one task."""
    t = build(spark, sf_dir)
    per = _sales(t).groupBy("store_key", "customer_key").agg(F.sum("extended_price").alias("rev"))
    w = Window.partitionBy("store_key").orderBy(F.desc("rev"), "customer_key")
    top = per.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
    c = t["dim_customer"].select("customer_key", "customer_id")
    s = t["dim_store"].select("store_key", "channel_name")
    return (
        top.join(c, "customer_key")
        .join(s, "store_key")
        .select("channel_name", F.col("place").cast("bigint").alias("place"), "customer_id", money(F.col("rev")).alias("revenue"))
        .orderBy("channel_name", "place")
    )


def star_declining_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per channel and category, every month's revenue against the month
    with sales before it, where it fell."""
    t = build(spark, sf_dir)
    # sales hardly repeat a (store, product, day): the category comes first, so the groups are few
    per = (
        _sales(t)
        .select("store_key", "product_key", "date_key", "extended_price")
        .join(t["dim_product"].select("product_key", "category"), "product_key")
        .groupBy("store_key", "category", "date_key")
        .agg(F.sum("extended_price").alias("rev"))
    )
    month = t["dim_date"].select("date_key", month_bucket("full_date").alias("month"))
    monthly = attach_calendar(per, month).groupBy("store_key", "category", "month").agg(F.sum("rev").alias("rev"))
    w = Window.partitionBy("store_key", "category").orderBy("month")
    prior = monthly.withColumn("prior_month", F.lag("month").over(w)).withColumn("prior_rev", F.lag("rev").over(w))
    fell = prior.where(F.col("rev") < F.col("prior_rev"))
    return (
        fell.join(t["dim_store"].select("store_key", "channel_name"), "store_key")
        .select(
            "channel_name",
            "category",
            "prior_month",
            "month",
            money(F.col("prior_rev")).alias("prior_revenue"),
            money(F.col("rev")).alias("revenue"),
            pct(F.col("rev") - F.col("prior_rev"), F.col("prior_rev"), 1).alias("pct_change"),
        )
        .orderBy("channel_name", "category", "month")
    )


def star_repeat_share_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of a channel and promotion's revenue that comes from
    customers with two or more orders (over all channels)."""
    t = build(spark, sf_dir)
    per_order = _sales(t).groupBy("customer_key", "order_id", "store_key", "promotion_key").agg(
        F.sum("extended_price").alias("rev")
    )
    many = per_order.groupBy("customer_key").agg((F.countDistinct("order_id") >= 2).alias("repeat"))
    per = per_order.groupBy("customer_key", "store_key", "promotion_key").agg(F.sum("rev").alias("rev"))
    share = per.join(many, "customer_key").groupBy("store_key", "promotion_key").agg(
        F.sum("rev").alias("rev"), F.sum(F.when(F.col("repeat"), F.col("rev")).otherwise(0)).alias("rep")
    )
    return (
        _named(share, t)
        .select(
            "channel_name",
            "promotion_code",
            money(F.col("rev")).alias("revenue"),
            pct(F.col("rep"), F.col("rev")).alias("repeat_share_pct"),
        )
        .orderBy("channel_name", "promotion_code")
    )


def star_inactive_by_channel(spark: SparkSession, sf_dir: str, days: int = 90) -> DataFrame:
    """Per channel, its customers and those whose last sale there is more
    than ``days`` days before the last sale of all."""
    t = build(spark, sf_dir)
    per = _sales(t).groupBy("store_key", "customer_key").agg(F.max("date_key").alias("date_key"))
    last = attach_calendar(per, t["dim_date"].select("date_key", "full_date"))
    horizon = attach_calendar(
        _sales(t).agg(F.max("date_key").alias("date_key")), t["dim_date"].select("date_key", "full_date")
    ).select("full_date").scalar()
    idle = F.date_diff(horizon, F.col("full_date"))
    counts = last.groupBy("store_key").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(idle > days).alias("inactive"),
        F.max(idle).cast("bigint").alias("longest_days"),
    )
    return (
        counts.join(t["dim_store"].select("store_key", "channel_name"), "store_key")
        .select("channel_name", "customers", "inactive", "longest_days")
        .orderBy("channel_name")
    )


# ----------------------------------------------------- type 2 and as-of join

SCD_AS_OF = "1998-01-01"
# The first load sees the customers who had signed up before this day; the
# ones who signed up later arrive as new keys in the second snapshot.
SCD_FIRST_LOAD = "1994-12-01"


def _customer_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = fx.customers(spark, sf_dir)
    snap1 = c.where(F.col("signup_date") < F.lit(SCD_FIRST_LOAD).cast("date"))
    k = F.col("customer_id")
    snap2 = c.select(
        "customer_id",
        "first_name",
        "last_name",
        F.when(k % 25 == 0, F.concat(F.lit("new."), F.col("email"))).otherwise(F.col("email")).alias("email"),
        "country",
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 0, F.concat(F.col("city"), F.lit("-moved")))
        .otherwise(F.col("city"))
        .alias("city"),
        "signup_date",
    )
    return snap1, snap2


def scd2_merge_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load from snapshot 1, then merge snapshot 2 at 1998-01-01
    (changed city/email, NULL city, customers new in snapshot 2)."""

    def merged() -> DataFrame:
        snap1, snap2 = _customer_snapshots(spark, sf_dir)
        return scd2_merge(
            dim_customer_frame(snap1), snap2, "customer_id", ["email", "country", "city"], F.lit(SCD_AS_OF).cast("date"), "customer_key"
        )

    return materialized(spark, f"scd2|{sf_dir}", merged)


def asof_customer_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the customer version valid at its order date; an
    order without a known customer keeps its row and gets version -1."""
    versions = scd2_merge_query(spark, sf_dir)
    o = fx.orders(spark, sf_dir).select("order_id", "customer_id", "order_date")
    return asof_version(o, versions, "customer_id", "order_date", "customer_key").select(
        "order_id", "customer_id", "order_date", "customer_key", "city"
    )


# ---------------------------------------------------------------- oracle SQL

_PROMO_SQL = """CASE WHEN {h} < 644245094 THEN 1 + {h} % 3 ELSE 0 END"""
_HASH_SQL = (
    "((((o.order_id + 1) % 4294967296) * 31153 + ((((o.order_id + 1) % 4294967296) * 40503) % 65536) * 65536)"
    " % 4294967296)"
)

register(
    "wh_dim_customer",
    """SELECT ROW_NUMBER() OVER (ORDER BY customer_id) AS customer_key, customer_id, first_name, last_name, email,
       country, city, signup_date, signup_date AS valid_from, CAST(NULL AS DATE) AS valid_to, 1 AS is_current
  FROM customers""",
    ["customers"],
)
register(
    "wh_dim_product",
    """SELECT product_id AS product_key, product_name, category, unit_price, unit_cost, active FROM products""",
    ["products"],
)
register(
    "wh_dim_store",
    "SELECT * FROM (VALUES "
    + ", ".join(f"(CAST({k} AS BIGINT), '{c}', '{n}', '{t}')" for k, c, n, t in STORES)
    + ") v(store_key, channel_code, channel_name, channel_type)",
    [],
)
register(
    "wh_dim_promotion",
    "SELECT * FROM (VALUES "
    + ", ".join(f"(CAST({k} AS BIGINT), '{c}', '{n}', CAST({d} AS DECIMAL(5,2)))" for k, c, n, d in PROMOTIONS)
    + ") v(promotion_key, promotion_code, promotion_name, discount_pct)",
    [],
)
register(
    "wh_dim_date",
    """SELECT CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key, full_date,
       year(full_date) AS year, quarter(full_date) AS quarter, month(full_date) AS month,
       strftime(full_date, '%B') AS month_name, day(full_date) AS day_of_month,
       strftime(full_date, '%A') AS day_of_week, CASE WHEN isodow(full_date) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date
        FROM (SELECT MIN(d) AS lo, MAX(d) AS hi FROM (
              SELECT CAST(order_date AS DATE) AS d FROM sales_orders
              UNION ALL SELECT CAST(return_date AS DATE) FROM returns)))""",
    ["sales_orders", "returns"],
)
register(
    "wh_fact_sales",
    f"""SELECT ROW_NUMBER() OVER (ORDER BY oi.order_item_id) AS sales_key, o.order_id, oi.order_item_id,
       CAST(strftime(o.order_date, '%Y%m%d') AS BIGINT) AS date_key, c.customer_key,
       oi.product_id AS product_key, s.store_key, {_PROMO_SQL.format(h=_HASH_SQL)} AS promotion_key,
       o.status AS order_status, oi.quantity, oi.unit_price,
       CAST(oi.quantity * oi.unit_price AS DECIMAL(18,2)) AS extended_price, p.unit_cost,
       CAST(oi.quantity * oi.unit_price - oi.quantity * p.unit_cost AS DECIMAL(18,2)) AS gross_margin
  FROM order_items oi JOIN sales_orders o ON o.order_id = oi.order_id
  JOIN products p ON p.product_id = oi.product_id
  JOIN wh_dim_customer c ON c.customer_id = o.customer_id AND c.is_current = 1
  JOIN wh_dim_store s ON s.channel_code = o.channel""",
    ["order_items", "sales_orders", "products", "wh_dim_customer", "wh_dim_store"],
)
register(
    "wh_fact_returns",
    """SELECT ROW_NUMBER() OVER (ORDER BY r.return_id) AS return_key, r.return_id, r.order_item_id,
       CAST(strftime(r.return_date, '%Y%m%d') AS BIGINT) AS date_key, c.customer_key,
       oi.product_id AS product_key, r.reason, oi.quantity AS returned_quantity,
       CAST(oi.quantity * oi.unit_price AS DECIMAL(18,2)) AS refund_amount
  FROM returns r JOIN order_items oi ON oi.order_item_id = r.order_item_id
  JOIN sales_orders o ON o.order_id = oi.order_id
  JOIN wh_dim_customer c ON c.customer_id = o.customer_id AND c.is_current = 1""",
    ["returns", "order_items", "sales_orders", "wh_dim_customer"],
)


SQL = {
    "dim_date": "SELECT * FROM wh_dim_date",
    "dim_customer": "SELECT * FROM wh_dim_customer",
    "dim_product": """SELECT product_id AS product_key, product_name, category, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(unit_cost AS DOUBLE) AS unit_cost, active FROM products""",
    "dim_store": """SELECT s.*, CAST(COALESCE(n.orders, 0) AS BIGINT) AS orders
FROM wh_dim_store s LEFT JOIN (SELECT channel, COUNT(*) AS orders FROM sales_orders GROUP BY channel) n
  ON n.channel = s.channel_code""",
    "dim_promotion": f"""SELECT p.promotion_key, p.promotion_code, p.promotion_name,
       CAST(p.discount_pct AS DOUBLE) AS discount_pct, CAST(COALESCE(n.orders, 0) AS BIGINT) AS orders
FROM wh_dim_promotion p LEFT JOIN (
    SELECT {_PROMO_SQL.format(h=_HASH_SQL)} AS promotion_key, COUNT(*) AS orders FROM sales_orders o GROUP BY 1) n
  ON n.promotion_key = p.promotion_key""",
    "fact_sales": """SELECT sales_key, order_id, order_item_id, date_key, customer_key, product_key, store_key,
       promotion_key, order_status, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(extended_price AS DOUBLE) AS extended_price, CAST(unit_cost AS DOUBLE) AS unit_cost,
       CAST(gross_margin AS DOUBLE) AS gross_margin FROM wh_fact_sales""",
    "fact_returns": """SELECT return_key, return_id, order_item_id, date_key, customer_key, product_key, reason,
       returned_quantity, CAST(refund_amount AS DOUBLE) AS refund_amount FROM wh_fact_returns""",
    "warehouse_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM wh_{n}" for n in TABLES
    ),
    "star_category_channel": """
SELECT p.category, s.channel_name, CAST(ROUND(SUM(f.extended_price), 2) AS DOUBLE) AS revenue
FROM wh_fact_sales f JOIN products p ON p.product_id = f.product_key
JOIN wh_dim_store s ON s.store_key = f.store_key
WHERE f.order_status <> 'cancelled'
GROUP BY p.category, s.channel_name ORDER BY revenue DESC, p.category, s.channel_name""",
    "star_margin_by_month": """
SELECT d.year, d.month, s.channel_name, CAST(ROUND(SUM(f.extended_price), 2) AS DOUBLE) AS revenue,
       CAST(ROUND(SUM(f.gross_margin), 2) AS DOUBLE) AS gross_margin
FROM wh_fact_sales f JOIN wh_dim_date d ON d.date_key = f.date_key JOIN wh_dim_store s ON s.store_key = f.store_key
WHERE f.order_status <> 'cancelled'
GROUP BY d.year, d.month, s.channel_name ORDER BY d.year, d.month, s.channel_name""",
    "star_margin_by_promotion": """
SELECT p.promotion_code, p.promotion_name, CAST(COUNT(DISTINCT f.order_id) AS BIGINT) AS orders,
       CAST(SUM(f.quantity) AS BIGINT) AS units, CAST(ROUND(SUM(f.extended_price), 2) AS DOUBLE) AS revenue,
       CAST(ROUND(SUM(f.gross_margin), 2) AS DOUBLE) AS gross_margin,
       ROUND(100.0 * CAST(SUM(f.gross_margin) AS DOUBLE) / CAST(SUM(f.extended_price) AS DOUBLE), 2) AS margin_pct
FROM wh_fact_sales f JOIN wh_dim_promotion p ON p.promotion_key = f.promotion_key
WHERE f.order_status <> 'cancelled'
GROUP BY p.promotion_code, p.promotion_name ORDER BY p.promotion_code""",
    "star_clv": """
WITH pc AS (SELECT customer_key, COUNT(DISTINCT order_id) AS n_orders, SUM(extended_price) AS clv
            FROM wh_fact_sales WHERE order_status <> 'cancelled' GROUP BY customer_key)
SELECT CAST(COUNT(*) AS BIGINT) AS customers, CAST(COUNT(*) FILTER (WHERE n_orders >= 2) AS BIGINT) AS repeat_customers,
       ROUND(100.0 * CAST(COUNT(*) FILTER (WHERE n_orders >= 2) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 2)
           AS repeat_rate_pct,
       ROUND(AVG(CAST(clv AS DOUBLE)), 2) AS avg_lifetime_value,
       CAST(ROUND(MAX(clv), 2) AS DOUBLE) AS max_lifetime_value
FROM pc""",
    "star_return_by_reason": """
WITH sold AS (SELECT p.category, SUM(f.quantity) AS units_sold FROM wh_fact_sales f
              JOIN products p ON p.product_id = f.product_key GROUP BY p.category),
ret AS (SELECT p.category, r.reason, COUNT(*) AS returns, SUM(r.returned_quantity) AS returned_units,
               SUM(r.refund_amount) AS refund_amount
        FROM wh_fact_returns r JOIN products p ON p.product_id = r.product_key GROUP BY p.category, r.reason)
SELECT ret.category, ret.reason, CAST(ret.returns AS BIGINT) AS returns,
       CAST(ret.returned_units AS BIGINT) AS returned_units,
       CAST(ROUND(ret.refund_amount, 2) AS DOUBLE) AS refund_amount, CAST(sold.units_sold AS BIGINT) AS units_sold,
       ROUND(100.0 * CAST(ret.returned_units AS DOUBLE) / CAST(sold.units_sold AS DOUBLE), 2) AS return_rate_pct
FROM ret JOIN sold ON sold.category = ret.category ORDER BY ret.category, ret.reason""",
    "star_questions_by_channel": """
SELECT strftime(d.full_date, '%Y-%m') AS month, s.channel_name, p.promotion_code,
       CAST(ROUND(SUM(f.extended_price), 2) AS DOUBLE) AS revenue
FROM wh_fact_sales f JOIN wh_dim_date d ON d.date_key = f.date_key
JOIN wh_dim_store s ON s.store_key = f.store_key JOIN wh_dim_promotion p ON p.promotion_key = f.promotion_key
WHERE f.order_status <> 'cancelled'
GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
}

register(
    "wh_scd2",
    f"""WITH snap1 AS (SELECT * FROM customers WHERE signup_date < DATE '{SCD_FIRST_LOAD}'),
dim1 AS (SELECT ROW_NUMBER() OVER (ORDER BY customer_id) AS customer_key, *, signup_date AS valid_from FROM snap1),
snap2 AS (SELECT customer_id, first_name, last_name,
                 CASE WHEN customer_id % 25 = 0 THEN 'new.' || email ELSE email END AS email, country,
                 CASE WHEN customer_id % 17 = 0 THEN NULL WHEN customer_id % 10 = 0 THEN city || '-moved'
                      ELSE city END AS city, signup_date
          FROM customers),
moved AS (SELECT d.customer_id FROM dim1 d JOIN snap2 s USING (customer_id)
          WHERE (d.email, d.country, d.city) IS DISTINCT FROM (s.email, s.country, s.city)),
opened AS (SELECT * FROM snap2 WHERE customer_id IN (SELECT customer_id FROM moved)
                                  OR customer_id NOT IN (SELECT customer_id FROM dim1))
SELECT customer_key, customer_id, first_name, last_name, email, country, city, signup_date, valid_from,
       CASE WHEN m.id IS NOT NULL THEN DATE '{SCD_AS_OF}' END AS valid_to,
       CASE WHEN m.id IS NOT NULL THEN 0 ELSE 1 END AS is_current
FROM dim1 LEFT JOIN (SELECT customer_id AS id FROM moved) m ON m.id = customer_id
UNION ALL
SELECT (SELECT MAX(customer_key) FROM dim1) + ROW_NUMBER() OVER (ORDER BY customer_id), customer_id, first_name,
       last_name, email, country, city, signup_date, DATE '{SCD_AS_OF}', CAST(NULL AS DATE), 1 FROM opened""",
    ["customers"],
)
SQL["scd2_merge"] = "SELECT * FROM wh_scd2"
SQL["asof_customer_version"] = """
WITH v AS (SELECT *, MIN(valid_from) OVER (PARTITION BY customer_id) AS first_from FROM wh_scd2)
SELECT o.order_id, o.customer_id, o.order_date, COALESCE(v.customer_key, -1) AS customer_key, v.city
FROM sales_orders o LEFT JOIN v ON v.customer_id = o.customer_id
 AND (v.valid_from = v.first_from OR o.order_date >= v.valid_from)
 AND (v.valid_to IS NULL OR o.order_date < v.valid_to)"""

_SOLD = """sold AS (SELECT f.*, COALESCE(r.events, 0) AS events, COALESCE(r.units, 0) AS units
  FROM wh_fact_sales f LEFT JOIN (SELECT order_item_id, COUNT(*) AS events, SUM(returned_quantity) AS units
                                  FROM wh_fact_returns GROUP BY order_item_id) r USING (order_item_id))"""
_RATES = """CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(events) AS BIGINT) AS returns,
       CAST(SUM(units) AS BIGINT) AS returned_units,
       ROUND(100.0 * CAST(SUM(units) AS DOUBLE) / CAST(SUM(quantity) AS DOUBLE), 2) AS return_rate_pct"""
_LIVE = "wh_fact_sales f JOIN wh_dim_store s USING (store_key) JOIN wh_dim_promotion pm USING (promotion_key)"

SQL["star_margin_by_category"] = """
SELECT category, CAST(ROUND(SUM(extended_price), 2) AS DOUBLE) AS revenue,
       CAST(ROUND(SUM(gross_margin), 2) AS DOUBLE) AS gross_margin,
       ROUND(100.0 * CAST(SUM(gross_margin) AS DOUBLE) / CAST(SUM(extended_price) AS DOUBLE), 2) AS margin_pct
FROM wh_fact_sales JOIN wh_dim_product USING (product_key) WHERE order_status <> 'cancelled'
GROUP BY category ORDER BY category"""
SQL["star_return_rate_by_product"] = f"""
WITH {_SOLD}
SELECT product_key, product_name, {_RATES} FROM sold JOIN wh_dim_product USING (product_key)
GROUP BY product_key, product_name ORDER BY product_key"""
SQL["star_return_rate_by_channel"] = f"""
WITH {_SOLD}
SELECT channel_name, promotion_code, {_RATES}
FROM sold JOIN wh_dim_store USING (store_key) JOIN wh_dim_promotion USING (promotion_key)
GROUP BY ALL ORDER BY channel_name, promotion_code"""
SQL["star_top_customers_by_channel"] = """
SELECT channel_name, place, customer_id, CAST(ROUND(rev, 2) AS DOUBLE) AS revenue
FROM (SELECT store_key, customer_key, SUM(extended_price) AS rev,
             ROW_NUMBER() OVER (PARTITION BY store_key ORDER BY SUM(extended_price) DESC, customer_key) AS place
      FROM wh_fact_sales WHERE order_status <> 'cancelled' GROUP BY store_key, customer_key)
JOIN wh_dim_store USING (store_key) JOIN wh_dim_customer USING (customer_key)
WHERE place <= 10 ORDER BY channel_name, place"""
SQL["star_declining_by_channel"] = """
WITH mon AS (SELECT channel_name, category, strftime(full_date, '%Y-%m') AS month, SUM(extended_price) AS rev
  FROM wh_fact_sales JOIN wh_dim_store USING (store_key) JOIN wh_dim_product USING (product_key)
  JOIN wh_dim_date USING (date_key) WHERE order_status <> 'cancelled' GROUP BY ALL)
SELECT channel_name, category, prior_month, month, CAST(ROUND(prior, 2) AS DOUBLE) AS prior_revenue,
       CAST(ROUND(rev, 2) AS DOUBLE) AS revenue,
       ROUND(100.0 * CAST(rev - prior AS DOUBLE) / CAST(prior AS DOUBLE), 1) AS pct_change
FROM (SELECT *, lag(rev) OVER w AS prior, lag(month) OVER w AS prior_month FROM mon
      WINDOW w AS (PARTITION BY channel_name, category ORDER BY month))
WHERE rev < prior ORDER BY channel_name, category, month"""
SQL["star_repeat_share_by_channel"] = f"""
WITH often AS (SELECT customer_key, COUNT(DISTINCT order_id) >= 2 AS again FROM wh_fact_sales
               WHERE order_status <> 'cancelled' GROUP BY customer_key)
SELECT channel_name, promotion_code, CAST(ROUND(SUM(extended_price), 2) AS DOUBLE) AS revenue,
       ROUND(100.0 * CAST(COALESCE(SUM(extended_price) FILTER (WHERE again), 0) AS DOUBLE)
             / CAST(SUM(extended_price) AS DOUBLE), 2) AS repeat_share_pct
FROM {_LIVE} JOIN often USING (customer_key) WHERE order_status <> 'cancelled'
GROUP BY channel_name, promotion_code ORDER BY channel_name, promotion_code"""
SQL["star_inactive_by_channel"] = """
WITH x AS (SELECT channel_name, customer_key, MAX(full_date) AS d FROM wh_fact_sales JOIN wh_dim_store USING (store_key)
           JOIN wh_dim_date USING (date_key) WHERE order_status <> 'cancelled' GROUP BY ALL)
SELECT channel_name, COUNT(*) AS customers, COUNT(*) FILTER (WHERE h - d > 90) AS inactive,
       CAST(MAX(h - d) AS BIGINT) AS longest_days
FROM x, (SELECT MAX(d) AS h FROM x) GROUP BY channel_name ORDER BY channel_name"""

QUERIES = {name: _table_query(name) for name in TABLES}
QUERIES.update(
    {
        "dim_store": dim_store_query,
        "dim_promotion": dim_promotion_query,
        "warehouse_counts": warehouse_counts,
        "star_category_channel": star_category_channel,
        "star_margin_by_month": star_margin_by_month,
        "star_margin_by_promotion": star_margin_by_promotion,
        "star_clv": star_clv,
        "star_return_by_reason": star_return_by_reason,
        "star_questions_by_channel": star_questions_by_channel,
        "star_margin_by_category": star_margin_by_category,
        "star_return_rate_by_product": star_return_rate_by_product,
        "star_return_rate_by_channel": star_return_rate_by_channel,
        "star_top_customers_by_channel": star_top_customers_by_channel,
        "star_declining_by_channel": star_declining_by_channel,
        "star_repeat_share_by_channel": star_repeat_share_by_channel,
        "star_inactive_by_channel": star_inactive_by_channel,
        "scd2_merge": scd2_merge_query,
        "asof_customer_version": asof_customer_version,
    }
)
ORACLE = {name: with_fixtures(sql) for name, sql in SQL.items()}
