"""DuckDB twins of the fixtures and queries (the correctness oracle).

``FIXTURE_SQL`` holds one CTE per derived domain table, written against the
pre-registered driver views (``customer nation part orders lineitem
events``). ``with_fixtures(body)`` prepends exactly the CTEs a query body
names (and their dependencies), so every oracle string is self-contained.
The fixture ``sales_orders`` is the OLTP ``orders`` table (renamed so it
does not shadow the driver's ``orders`` view).
"""

from __future__ import annotations

import re

_STATUS = (
    "CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'shipped' "
    "WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'pending' "
    "WHEN o_orderstatus = 'P' THEN 'cancelled' END"
)
_REASON = (
    "CASE {x} % 5 WHEN 0 THEN 'defective' WHEN 1 THEN 'wrong_item' WHEN 2 THEN 'no_longer_needed' "
    "WHEN 3 THEN 'better_price_found' ELSE 'damaged_in_shipping' END"
)

_CHANNEL = "CASE o_orderkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile_app' ELSE 'marketplace' END"

# name -> (sql, dependencies); order matters only for readability
FIXTURE_SQL: dict[str, tuple[str, list[str]]] = {
    "customers": (
        """SELECT c.c_custkey AS customer_id, 'Customer' AS first_name, substr(c.c_name, 10) AS last_name,
       lower(c.c_name) || '@example.com' AS email, n.n_name AS country, c.c_mktsegment AS city,
       CAST(DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE) AS signup_date
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
        [],
    ),
    "products": (
        """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
       CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(2,1)), 2) AS DECIMAL(10,2)) AS unit_cost,
       CAST(CASE WHEN p_size = 1 THEN 0 ELSE 1 END AS INTEGER) AS active
  FROM part""",
        [],
    ),
    "click_catalog": ("SELECT p_partkey AS product_id FROM part WHERE p_size > 5", []),
    "sales_orders": (
        f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
       {_STATUS} AS status,
       {_CHANNEL} AS channel
  FROM orders""",
        [],
    ),
    "order_items_flag": (
        """SELECT ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
                                 l_quantity, l_extendedprice) AS order_item_id,
       l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
       CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS DECIMAL(18,0))
            * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(10,2)) AS unit_price,
       l_returnflag
  FROM lineitem""",
        [],
    ),
    "order_items": (
        "SELECT order_item_id, order_id, product_id, quantity, unit_price FROM order_items_flag",
        ["order_items_flag"],
    ),
    "payments": (
        f"""SELECT o_orderkey + 1 AS payment_id, o_orderkey AS order_id,
       o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS payment_date,
       CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
       CASE o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'paypal' WHEN 2 THEN 'bank_transfer'
            ELSE 'gift_card' END AS method,
       CASE WHEN {_STATUS} = 'cancelled' THEN 'refunded' WHEN o_orderkey % 33 = 0 THEN 'failed'
            ELSE 'paid' END AS status
  FROM orders WHERE {_STATUS} <> 'pending'""",
        [],
    ),
    "return_base": (
        """SELECT i.order_item_id, i.order_id, o.order_date
  FROM order_items_flag i JOIN sales_orders o ON o.order_id = i.order_id
  WHERE i.l_returnflag = 'R' AND o.status <> 'cancelled'""",
        ["order_items_flag", "sales_orders"],
    ),
    "returns": (
        f"""SELECT order_item_id * 2 AS return_id, order_item_id,
       order_date + to_days(CAST(2 + order_id % 20 AS INTEGER)) AS return_date,
       {_REASON.format(x='order_item_id')} AS reason
  FROM return_base
UNION ALL
SELECT order_item_id * 2 + 1 AS return_id, order_item_id,
       order_date + to_days(CAST(9 + order_id % 20 AS INTEGER)) AS return_date,
       {_REASON.format(x='(order_item_id + 1)')} AS reason
  FROM return_base WHERE order_item_id % 40 = 0""",
        ["return_base"],
    ),
    "raw_orders_base": (
        """SELECT CAST(order_id AS VARCHAR) AS order_row_id,
       CASE WHEN order_id % 101 = 7 THEN '' ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
       CAST(order_id % 1000 AS VARCHAR) AS product_id,
       CASE WHEN order_id % 33 = 0 THEN '' WHEN order_id % 89 = 1 THEN '31/2/2025'
            WHEN order_id % 4 = 0 THEN strftime(order_date, '%Y-%m-%d')
            WHEN order_id % 4 = 1 THEN strftime(order_date, '%-d/%-m/%Y')
            WHEN order_id % 4 = 2 THEN strftime(order_date, '%m-%d-%Y')
            ELSE strftime(order_date, '%Y/%m/%d') END AS order_date,
       CASE WHEN order_id % 10 = 0 THEN 'x' WHEN order_id % 10 = 1 THEN NULL WHEN order_id % 10 = 2 THEN '2.5'
            WHEN order_id % 10 = 3 THEN 'inf' ELSE CAST(1 + order_id % 5 AS VARCHAR) END AS quantity,
       CASE WHEN order_id % 5 = 0 THEN upper(status) WHEN order_id % 5 = 1 THEN ''
            WHEN order_id % 5 = 3 THEN NULL WHEN order_id % 5 = 4 THEN ' ' || status ELSE status END AS status,
       CASE WHEN order_id % 7 = 3 THEN NULL ELSE channel END AS channel
  FROM sales_orders""",
        ["sales_orders"],
    ),
    "raw_orders_export": (
        """SELECT * FROM raw_orders_base
UNION ALL SELECT * FROM raw_orders_base WHERE CAST(order_row_id AS BIGINT) % 50 = 0""",
        ["raw_orders_base"],
    ),
    "mkt_first": (
        f"""SELECT o_orderkey // 50 + 1 AS page, o_orderkey AS seq,
       'MKT-' || CAST(o_orderkey AS VARCHAR) AS marketplace_order_id,
       'buyer' || CAST(o_custkey AS VARCHAR) || '@marketplace-example.com' AS customer_email,
       CASE WHEN o_orderkey % 40 = 2 THEN 'SKU-99999999' WHEN o_orderkey % 61 = 2 THEN 'SKU-x'
            WHEN o_orderkey % 73 = 2 THEN CAST(o_orderkey % 1000 AS VARCHAR)
            ELSE 'SKU-' || CAST(o_orderkey % 1000 AS VARCHAR) END AS product_sku,
       CAST(CASE WHEN o_orderkey % 37 = 2 THEN 0 WHEN o_orderkey % 53 = 2 THEN NULL
                 WHEN o_orderkey % 4 = 3 THEN 3 WHEN o_orderkey % 4 = 2 THEN 2 ELSE 1 END AS BIGINT) AS quantity,
       CASE WHEN o_orderkey % 43 = 2 THEN 'not-a-date'
            ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS order_ts,
       CAST(CASE WHEN o_orderkey % 59 = 2 THEN 0.0 ELSE o_totalprice / 100 END AS DOUBLE) AS amount_usd
  FROM orders""",
        [],
    ),
    "mkt_records": (
        """SELECT * FROM mkt_first
UNION ALL
SELECT page + 1, seq + 1000000000000, marketplace_order_id, customer_email, product_sku, quantity,
       order_ts, amount_usd + 1.0 FROM mkt_first WHERE seq % 29 = 2""",
        ["mkt_first"],
    ),
    "raw_clicks": (
        """SELECT CAST(event_id AS VARCHAR) AS event_id,
       CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
       CASE WHEN user_id % 3 = 0 OR event_id % 5 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS customer_id,
       CASE event_type WHEN 'signup' THEN 'page_view' WHEN 'view' THEN 'view_product'
            WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'purchase' ELSE event_type END AS event_type,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_id % 211 = 0 THEN 'abc'
            ELSE json_extract_string(props, '$.k') END AS product_id,
       CASE WHEN event_id % 97 = 0 THEN '2026-13-45T99:99:99'
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS event_timestamp,
       CASE (user_id + event_id) % 4 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet' END
            AS device_type
  FROM events""",
        [],
    ),
}


def register(name: str, sql: str, deps: list[str]) -> None:
    """Add a derived CTE (used by plan modules for their intermediate views)."""
    FIXTURE_SQL[name] = (sql, deps)


def _closure(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in FIXTURE_SQL[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_fixtures(body: str, needs: list[str] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it references (by word match)."""
    if needs is None:
        words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
        needs = [n for n in FIXTURE_SQL if n in words]
        # referenced CTEs may reference others
        changed = True
        while changed:
            changed = False
            for n in list(needs):
                w = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", FIXTURE_SQL[n][0]))
                for m in FIXTURE_SQL:
                    if m in w and m not in needs:
                        needs.append(m)
                        changed = True
    order = _closure(needs)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS (\n{FIXTURE_SQL[n][0]}\n)" for n in order)
    body = body.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
