"""Domain tables derived from the driver's input tables.

The commerce operators expect OLTP tables (customers, products, orders,
order_items, payments, returns), a raw text export, marketplace API pages and
a raw clickstream. They are built here from ``customer nation part orders
lineitem events`` with plain column arithmetic, so the DuckDB oracle in
``cartwheel.oracle`` repeats each mapping exactly. See FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import dense_row_number
from ..session import scratch_path
from ..sinks.materialize import materialized
from ..sinks.writers import write_csv
from .files import read_csv_text
from .tables import read_table

# Fixed values of the domain (must match the oracle and the original pipeline):
# order channels by order_id % 3, payment methods by order_id % 4,
# return reasons by id % 5, click devices by (user_id + event_id) % 4.
CHANNELS = ["web", "mobile_app", "marketplace"]
PAYMENT_METHODS = ["credit_card", "paypal", "bank_transfer", "gift_card"]
RETURN_REASONS = ["defective", "wrong_item", "no_longer_needed", "better_price_found", "damaged_in_shipping"]
DEVICES = ["desktop", "mobile", "tablet", None]
CLICK_TYPE_MAP = {"signup": "page_view", "view": "view_product", "click": "add_to_cart", "purchase": "purchase"}
BAD_CLICK_TS = "2026-13-45T99:99:99"


def _pick(index: Column, values: list) -> Column:
    """values[index] for a small fixed list, as a CASE expression."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        F.expr("substr(c_name, 10)").alias("last_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("city"),
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"])
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        price.alias("unit_price"),
        F.round(price * F.lit(0.6).cast("decimal(2,1)"), 2).cast("decimal(10,2)").alias("unit_cost"),
        F.when(F.col("p_size") == 1, 0).otherwise(1).cast("int").alias("active"),
    )


def click_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products the click stream may reference: parts with p_size > 5."""
    return read_table(spark, sf_dir, "part", ["p_partkey", "p_size"]).where(F.col("p_size") > 5).select(
        F.col("p_partkey").alias("product_id")
    )


def order_status(orderstatus: Column, key: Column) -> Column:
    return (
        F.when(orderstatus == "F", "completed")
        .when(orderstatus == "O", "shipped")
        .when((orderstatus == "P") & (key % 2 == 0), "pending")
        .when(orderstatus == "P", "cancelled")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_of(read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]))


def orders_of(o: DataFrame) -> DataFrame:
    """The domain's orders from rows of the source table."""
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        order_status(F.col("o_orderstatus"), F.col("o_orderkey")).alias("status"),
        channel_of(F.col("o_orderkey")).alias("channel"),
    )


def channel_of(order_key: Column) -> Column:
    """The sales channel of an order (one of CHANNELS, by order key)."""
    return _pick(order_key % 3, CHANNELS)


ITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]


def _numbered_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ITEM_ORDER + ["l_returnflag"])
    return dense_row_number(li, ITEM_ORDER, "order_item_id", rows=li.count())


def order_items_with_flag(spark: SparkSession, sf_dir: str, refresh: bool = False) -> DataFrame:
    """order_items plus ``l_returnflag`` (needed to derive returns).

    The dense numbering is a range shuffle of lineitem, so the numbered table
    is written once per application to the checkpoint folder and re-read.
    """
    numbered = materialized(
        spark, f"order_items|{sf_dir}", lambda: _numbered_lineitem(spark, sf_dir), refresh=refresh, stored=True
    )
    return numbered.select("order_item_id", *_item_columns(), "l_returnflag")


def _item_columns() -> list[Column]:
    """An item's columns but its number, from a line item."""
    # integer cents divided by quantity, then back to a 2-decimal price
    per_unit = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)")
    return [
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (per_unit.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(10,2)").alias("unit_price"),
    ]


def order_items_unnumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``order_items`` without their number, for questions that do
    not ask for it: a scan, where the numbers take a sort of all rows."""
    return read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]).select(*_item_columns())


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_items_with_flag(spark, sf_dir).drop("l_returnflag")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    status = order_status(F.col("o_orderstatus"), F.col("o_orderkey"))
    key = F.col("o_orderkey")
    return o.where(status != "pending").select(
        (key + 1).alias("payment_id"),
        key.alias("order_id"),
        (F.col("o_orderdate") + F.make_dt_interval(mins=(key % 1440).cast("int"))).alias("payment_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        _pick(key % 4, PAYMENT_METHODS).alias("method"),
        F.when(status == "cancelled", "refunded").when(key % 33 == 0, "failed").otherwise("paid").alias("status"),
    )


def returns(spark: SparkSession, sf_dir: str, refresh: bool = False) -> DataFrame:
    """The returns table, written once per application and read back."""
    return materialized(spark, f"returns|{sf_dir}", lambda: _returns_rows(spark, sf_dir), refresh=refresh)


def _returns_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item the source flags as returned (``l_returnflag = 'R'``) of an
    order that was not cancelled.

    Items with id % 40 = 0 get a second return event, which makes the LEFT
    JOIN fan-out of the returns question visible; return_id = 2 * item id +
    event number, unique.
    """
    oi = order_items_with_flag(spark, sf_dir).where(F.col("l_returnflag") == "R")
    o = orders(spark, sf_dir).where(F.col("status") != "cancelled").select("order_id", "order_date")
    base = oi.join(o, "order_id").select("order_item_id", "order_id", "order_date")
    # one pass: event 0 for every returned item, event 1 also for id % 40 = 0
    events = F.when(F.col("order_item_id") % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ev = base.select("*", F.explode(events).alias("_ev"))
    return ev.select(
        (F.col("order_item_id") * 2 + F.col("_ev")).alias("return_id"),
        "order_item_id",
        (
            F.col("order_date")
            + F.make_dt_interval(days=(2 + 7 * F.col("_ev") + F.col("order_id") % 20).cast("int"))
        ).alias("return_date"),
        _pick((F.col("order_item_id") + F.col("_ev")) % 5, RETURN_REASONS).alias("reason"),
    )


def raw_orders_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed raw export: written once per application as an all-text
    table and read back, as the cleaning job would read the exported file.
    (Left inline, Catalyst pushes the cleaning's NULL filters into the
    generating expressions below and evaluates them several times a row.)"""
    return materialized(spark, f"raw_orders_export|{sf_dir}", lambda: _raw_orders_rows(spark, sf_dir))


def _raw_orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A messy all-text export of orders (A1): four date formats, blanks,
    text quantities, mixed-case statuses, null channels, 2% exact duplicates."""
    o = orders(spark, sf_dir)
    k = F.col("order_id")
    d = F.col("order_date")
    date_txt = (
        F.when(k % 33 == 0, F.lit(""))
        .when(k % 89 == 1, F.lit("31/2/2025"))
        .when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k % 4 == 1, F.date_format(d, "d/M/yyyy"))
        .when(k % 4 == 2, F.date_format(d, "MM-dd-yyyy"))
        .otherwise(F.date_format(d, "yyyy/MM/dd"))
    )
    qty_txt = (
        F.when(k % 10 == 0, F.lit("x"))
        .when(k % 10 == 1, F.lit(None).cast("string"))
        .when(k % 10 == 2, F.lit("2.5"))
        .when(k % 10 == 3, F.lit("inf"))
        .otherwise((1 + k % 5).cast("string"))
    )
    status_txt = (
        F.when(k % 5 == 0, F.upper("status"))
        .when(k % 5 == 1, F.lit(""))
        .when(k % 5 == 3, F.lit(None).cast("string"))
        .when(k % 5 == 4, F.concat(F.lit(" "), F.col("status")))
        .otherwise(F.col("status"))
    )
    rows = o.select(
        k.cast("string").alias("order_row_id"),
        F.when(k % 101 == 7, F.lit("")).otherwise(F.col("customer_id").cast("string")).alias("customer_id"),
        (k % 1000).cast("string").alias("product_id"),
        date_txt.alias("order_date"),
        qty_txt.alias("quantity"),
        status_txt.alias("status"),
        F.when(k % 7 == 3, F.lit(None).cast("string")).otherwise(F.col("channel")).alias("channel"),
    )
    return rows.unionByName(rows.where(F.col("order_row_id").cast("bigint") % 50 == 0))


MARKETPLACE_PAGE_SPAN = 50  # order ids per page


def marketplace_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat marketplace API records with their arrival position (page, seq).

    Every order is a record; every 40th SKU unknown, some SKU text without
    the prefix or not a number, some bad timestamps, zero quantities and zero
    amounts. Orders with id % 29 = 2 are sent again on the next page with a
    different amount (the first arrival must win).
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    k = F.col("o_orderkey")
    sku = (
        F.when(k % 40 == 2, F.lit("SKU-99999999"))
        .when(k % 61 == 2, F.lit("SKU-x"))
        .when(k % 73 == 2, (k % 1000).cast("string"))
        .otherwise(F.concat(F.lit("SKU-"), (k % 1000).cast("string")))
    )
    qty = (
        F.when(k % 37 == 2, F.lit(0))
        .when(k % 53 == 2, F.lit(None))
        .when(k % 4 == 3, F.lit(3))
        .when(k % 4 == 2, F.lit(2))
        .otherwise(F.lit(1))
        .cast("bigint")
    )
    amount = F.when(k % 59 == 2, F.lit(0.0)).otherwise(F.col("o_totalprice") / 100).cast("double")
    ts = F.when(k % 43 == 2, F.lit("not-a-date")).otherwise(
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    first = o.select(
        (F.expr(f"o_orderkey div {MARKETPLACE_PAGE_SPAN}") + 1).cast("bigint").alias("page"),
        k.alias("seq"),
        F.concat(F.lit("MKT-"), k.cast("string")).alias("marketplace_order_id"),
        F.concat(F.lit("buyer"), F.col("o_custkey").cast("string"), F.lit("@marketplace-example.com")).alias(
            "customer_email"
        ),
        sku.alias("product_sku"),
        qty.alias("quantity"),
        ts.alias("order_ts"),
        amount.alias("amount_usd"),
    )
    resent = first.where(F.col("seq") % 29 == 2).select(
        (F.col("page") + 1).alias("page"),
        (F.col("seq") + 1_000_000_000_000).alias("seq"),
        "marketplace_order_id",
        "customer_email",
        "product_sku",
        "quantity",
        "order_ts",
        (F.col("amount_usd") + 1.0).alias("amount_usd"),
    )
    return first.unionByName(resent)


CLICK_COLUMNS = ["event_id", "session_id", "customer_id", "event_type", "product_id", "event_timestamp", "device_type"]


def click_csv(spark: SparkSession, sf_dir: str, refresh: bool = False) -> str:
    """The raw click file: a header CSV, written once per application; its folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if refresh or key not in _CLICK_FILES:
        _CLICK_FILES[key] = write_csv(_raw_clicks(spark, sf_dir), scratch_path(spark, "raw_clicks_csv"))
    return _CLICK_FILES[key]


_CLICK_FILES: dict[tuple[str, str], str] = {}


def raw_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click file, every column text."""
    return read_csv_text(spark, click_csv(spark, sf_dir), CLICK_COLUMNS)


def _raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw all-text click events (A7) from ``events``.

    signup/view/click/purchase map to page_view/view_product/add_to_cart/
    purchase; ``error`` stays as an unknown type. session = user and day;
    customer blank for user_id % 3 = 0 and for event_id % 5 = 0; product from
    props.k (none for page views, 'abc' for event_id % 211 = 0); every 97th
    timestamp is unparseable.
    """
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    etype = F.coalesce(
        F.when(F.col("event_type") == "signup", "page_view")
        .when(F.col("event_type") == "view", "view_product")
        .when(F.col("event_type") == "click", "add_to_cart")
        .when(F.col("event_type") == "purchase", "purchase"),
        F.col("event_type"),
    )
    eid, uid = F.col("event_id"), F.col("user_id")
    product = (
        F.when(etype == "page_view", F.lit(None).cast("string"))
        .when(eid % 211 == 0, F.lit("abc"))
        .otherwise(F.get_json_object("props", "$.k"))
    )
    return e.select(
        eid.cast("string").alias("event_id"),
        F.concat(uid.cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        F.when((uid % 3 == 0) | (eid % 5 == 0), F.lit(None).cast("string"))
        .otherwise(uid.cast("string"))
        .alias("customer_id"),
        etype.alias("event_type"),
        product.alias("product_id"),
        F.when(eid % 97 == 0, F.lit(BAD_CLICK_TS))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("event_timestamp"),
        _pick((uid + eid) % 4, DEVICES).alias("device_type"),
    )
