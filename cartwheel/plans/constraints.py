"""Declared OLTP constraints checked on the data.

Spark has no constraint enforcement, and the original schema's foreign keys
were never enforced either, so the rules become a report of
(table_name, rule, violations). The rule list is data; the Spark checks and
the oracle SQL are both generated from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import TableRules, check_table
from ..oracle import with_fixtures
from ..sources import fixtures as fx
from . import warehouse

# (table, not-null columns, unique keys, checks as SQL, foreign keys). Fixed
# values of the domain: statuses, methods and 0/1 flags.
RULES = [
    (
        "customers",
        ["customer_id", "first_name", "last_name", "email", "country", "signup_date"],
        [["customer_id"], ["email"]],
        {},
        [],
    ),
    (
        "products",
        ["product_id", "product_name", "category", "unit_price", "unit_cost", "active"],
        [["product_id"]],
        {"active_flag": "active IN (0, 1)"},
        [],
    ),
    (
        "orders",
        ["order_id", "customer_id", "order_date", "status", "channel"],
        [["order_id"]],
        {"status_domain": "status IN ('pending', 'completed', 'shipped', 'cancelled')"},
        [("customer_id", "customers", "customer_id")],
    ),
    (
        "order_items",
        ["order_item_id", "order_id", "product_id", "quantity", "unit_price"],
        [["order_item_id"]],
        {"positive_quantity": "quantity > 0"},
        [("order_id", "orders", "order_id"), ("product_id", "products", "product_id")],
    ),
    (
        "payments",
        ["payment_id", "order_id", "payment_date", "amount", "method", "status"],
        [["payment_id"]],
        {
            "method_domain": "method IN ('credit_card', 'paypal', 'bank_transfer', 'gift_card')",
            "status_domain": "status IN ('paid', 'failed', 'refunded')",
        },
        [("order_id", "orders", "order_id")],
    ),
    (
        "returns",
        ["return_id", "order_item_id", "return_date", "reason"],
        [["return_id"]],
        {},
        [("order_item_id", "order_items", "order_item_id")],
    ),
]

WAREHOUSE_RULES = [
    (
        "dim_date",
        ["date_key", "full_date", "year", "quarter", "month", "month_name", "day_of_month", "day_of_week", "is_weekend"],
        [["date_key"], ["full_date"]],
        {"weekend_flag": "is_weekend IN (0, 1)"},
        [],
    ),
    (
        "dim_customer",
        ["customer_key", "customer_id", "first_name", "last_name", "email", "country", "signup_date", "valid_from", "is_current"],
        [["customer_key"]],
        {"current_flag": "is_current IN (0, 1)", "open_version": "is_current = 0 OR valid_to IS NULL"},
        [],
    ),
    (
        "dim_product",
        ["product_key", "product_name", "category", "unit_price", "unit_cost", "active"],
        [["product_key"]],
        {"active_flag": "active IN (0, 1)"},
        [],
    ),
    ("dim_store", ["store_key", "channel_code", "channel_name", "channel_type"], [["store_key"], ["channel_code"]], {}, []),
    (
        "dim_promotion",
        ["promotion_key", "promotion_code", "promotion_name", "discount_pct"],
        [["promotion_key"], ["promotion_code"]],
        {},
        [],
    ),
    (
        "fact_sales",
        [
            "sales_key", "order_id", "order_item_id", "date_key", "customer_key", "product_key", "store_key", "promotion_key",
            "order_status", "quantity", "unit_price", "extended_price", "unit_cost", "gross_margin",
        ],
        [["sales_key"]],
        {},
        [
            ("date_key", "dim_date", "date_key"),
            ("customer_key", "dim_customer", "customer_key"),
            ("product_key", "dim_product", "product_key"),
            ("store_key", "dim_store", "store_key"),
            ("promotion_key", "dim_promotion", "promotion_key"),
        ],
    ),
    (
        "fact_returns",
        [
            "return_key", "return_id", "order_item_id", "date_key", "customer_key", "product_key", "reason", "returned_quantity",
            "refund_amount",
        ],
        [["return_key"]],
        {},
        [
            ("date_key", "dim_date", "date_key"),
            ("customer_key", "dim_customer", "customer_key"),
            ("product_key", "dim_product", "product_key"),
        ],
    ),
]

_SQL_TABLE = {"orders": "sales_orders"} | {rule[0]: f"wh_{rule[0]}" for rule in WAREHOUSE_RULES}


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": fx.customers(spark, sf_dir),
        "products": fx.products(spark, sf_dir),
        "orders": fx.orders(spark, sf_dir),
        "order_items": fx.order_items(spark, sf_dir),
        "payments": fx.payments(spark, sf_dir),
        "returns": fx.returns(spark, sf_dir),
    }


def report(rules: list[tuple], tables: dict[str, DataFrame]) -> DataFrame:
    """The report of every rule of ``rules`` over ``tables``."""
    out = None
    for name, not_null, unique, checks, fks in rules:
        part = check_table(
            tables[name],
            TableRules(
                name=name,
                not_null=not_null,
                unique=unique,
                checks={k: F.expr(v) for k, v in checks.items()},
                foreign_keys=fks,
            ),
            tables,
        )
        out = part if out is None else out.unionByName(part)
    return out


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(RULES, _tables(spark, sf_dir))


def warehouse_constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1-C4 on the star schema: not null, keys and unique codes, flags, and
    the foreign keys of both facts (the calendar's coverage among them, J14)."""
    return report(WAREHOUSE_RULES, warehouse.build(spark, sf_dir))


def _oracle(rules: list[tuple]) -> str:
    parts = []
    for name, not_null, unique, checks, fks in rules:
        t = _SQL_TABLE.get(name, name)
        for c in not_null:
            parts.append(
                f"SELECT '{name}' AS table_name, 'not_null({c})' AS rule, "
                f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {t}"
            )
        for rule, cond in checks.items():
            parts.append(
                f"SELECT '{name}', 'check({rule})', CAST(COUNT(*) FILTER (WHERE NOT ({cond})) AS BIGINT) FROM {t}"
            )
        for key in unique:
            k = ", ".join(key)
            nn = " AND ".join(f"{c} IS NOT NULL" for c in key)
            parts.append(
                f"SELECT '{name}', 'unique({','.join(key)})', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) "
                f"FROM (SELECT COUNT(*) AS n FROM {t} WHERE {nn} GROUP BY {k})"
            )
        for col, parent, pcol in fks:
            p = _SQL_TABLE.get(parent, parent)
            parts.append(
                f"SELECT '{name}', 'fk({col}->{parent}.{pcol})', CAST(COUNT(*) AS BIGINT) FROM {t} c "
                f"WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{pcol} = c.{col})"
            )
    return "\nUNION ALL\n".join(parts)


QUERIES = {"constraint_report": constraint_report, "warehouse_constraint_report": warehouse_constraint_report}
ORACLE = {
    "constraint_report": with_fixtures(_oracle(RULES)),
    "warehouse_constraint_report": with_fixtures(_oracle(WAREHOUSE_RULES)),
}
