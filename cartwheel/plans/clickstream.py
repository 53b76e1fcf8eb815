"""Clickstream job: clean events, sessions, daily funnel, product-day.

Plan shape, chosen for scale:

* cleaning is one pass of expressions plus one join to the de-duplicated
  catalog (F20; the original split the data by NULL product and re-united it,
  scanning the input twice);
* one event-sized aggregate keyed by (session_id, event_date) feeds both
  the sessions and the daily funnel: sessions fold a session's day rows
  (min / max / sum combine exactly), the funnel sums them per day, so a
  session that crosses midnight counts in each day and distinct sessions
  need no distinct-Expand. In the job this session-day table is written
  once (one row per session and day, far smaller than the events), which
  saves a second scan and shuffle of the events; when only the funnel is
  asked for, Catalyst prunes the session figures and the aggregate stays a
  hash aggregate of fixed-width counters;
* "first" customer/device of a session is the value of the earliest event by
  (timestamp, event_id) among events where it is not NULL - a total order,
  unlike row-order ``first``; it is a ``min`` over a struct, so it combines
  map-side like every other aggregate here (a hot session or day is reduced
  inside each input partition before the shuffle);
* the job writes the cleaned events once as a Parquet table in its output
  folder and computes the aggregates from it: parsing and the catalog
  join run once, lineage is cut at a durable table (an executor loss does
  not recompute the cleaning), and each aggregate reads only the columns it
  needs - cheaper than caching an event-sized frame in executor memory;
* writes are partitioned by date with a ``rebalance`` hint: AQE splits a hot
  date across several writer tasks and merges small ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_fixed
from ..functions.numeric import pct
from ..operators import cleaning as cl
from ..oracle import register, with_fixtures
from ..session import scratch_path
from ..sinks import writers
from ..sources import files
from ..sources import fixtures as fx

# Fixed list of event types the job accepts (values as in the original job).
VALID_EVENT_TYPES = ["page_view", "view_product", "add_to_cart", "purchase"]


def parse_clicks(raw: DataFrame, keep_raw_product: bool = False) -> DataFrame:
    """Typed columns; bad timestamps and non-numeric product ids become NULL."""
    ts = parse_fixed(F.col("event_timestamp"))
    extra = [F.col("product_id").alias("_raw_product")] if keep_raw_product else []
    return raw.select(
        *extra,
        "event_id",
        "session_id",
        "customer_id",
        "event_type",
        F.col("product_id").try_cast("bigint").alias("product_id"),
        ts.alias("event_timestamp"),
        "device_type",
        F.to_date(ts).alias("event_date"),
    )


def clean_clicks(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Valid timestamp, known event type, product NULL or in the catalog."""
    typed = parse_clicks(raw).where(
        F.col("event_timestamp").isNotNull() & F.col("event_type").isin(VALID_EVENT_TYPES)
    )
    return cl.null_or_member_of(typed, catalog, "product_id")


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = files.key_set(fx.click_catalog(spark, sf_dir), "product_id")
    return clean_clicks(fx.raw_clickstream(spark, sf_dir), catalog)


def _first_non_null(value: str) -> F.Column:
    """Earliest (timestamp, event_id) among rows where ``value`` is not NULL."""
    return F.min(F.when(F.col(value).isNotNull(), F.struct("event_timestamp", "event_id", value)))


def session_days(clean: DataFrame) -> DataFrame:
    """One row per (session_id, event_date): the event counts by type and the
    partial session figures (first customer/device, first and last time,
    events). Sessions and the daily funnel are both folded from these rows,
    so the event-sized shuffle happens once for both. Rows without a session
    id are kept: their events still count per day."""
    t = F.col("event_type")
    return clean.groupBy("session_id", "event_date").agg(
        F.count_if(t == "page_view").alias("page_views"),
        F.count_if(t == "view_product").alias("product_views"),
        F.count_if(t == "add_to_cart").alias("add_to_carts"),
        F.count_if(t == "purchase").alias("purchases"),
        _first_non_null("customer_id").alias("fc"),
        _first_non_null("device_type").alias("fd"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"),
    )


def sessions_from_days(sd: DataFrame) -> DataFrame:
    """One row per session from its (session, day) rows; every
    figure combines (min, max, sum), so the result equals one aggregate over
    the events. NULL session ids are not a session."""
    return (
        sd.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.min("fc").alias("fc"),
            F.min("fd").alias("fd"),
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("event_count").cast("bigint").alias("event_count"),
            F.max(F.when(F.col("purchases") > 0, 1).otherwise(0)).alias("converted"),
            F.min("event_date").alias("event_date"),
        )
        .select(
            "session_id",
            F.col("fc.customer_id").alias("customer_id"),
            F.col("fd.device_type").alias("device_type"),
            "session_start",
            "session_end",
            "event_count",
            "converted",
            "event_date",
            (F.unix_timestamp("session_end") - F.unix_timestamp("session_start")).alias("duration_seconds"),
        )
    )


def sessions_from(clean: DataFrame) -> DataFrame:
    """One row per session."""
    return sessions_from_days(session_days(clean))


def daily_from(sd: DataFrame, ordered: bool = True) -> DataFrame:
    """Per day the four event counts, distinct sessions and conversion %
    (sorted by day unless ``ordered`` is False)."""
    daily = sd.groupBy("event_date").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("page_views", "product_views", "add_to_carts", "purchases")],
        F.count("session_id").alias("sessions"),
    )
    daily = daily.withColumn("conversion_rate_pct", pct(F.col("purchases"), F.col("sessions")))
    return daily.orderBy("event_date") if ordered else daily


def product_daily_from(clean: DataFrame) -> DataFrame:
    """Per (day, product) views, add-to-carts and purchases."""
    t = F.col("event_type")
    return (
        clean.where(F.col("product_id").isNotNull())
        .groupBy("event_date", "product_id")
        .agg(
            F.count_if(t == "view_product").alias("views"),
            F.count_if(t == "add_to_cart").alias("add_to_carts"),
            F.count_if(t == "purchase").alias("purchases"),
        )
    )


def click_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(spark, sf_dir)


def click_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions_from(clean_events(spark, sf_dir))


def click_daily_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_from(session_days(clean_events(spark, sf_dir)))


def click_product_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_daily_from(clean_events(spark, sf_dir))


def click_clean_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6/P7 for clicks in one pass: removed rows by first failing reason, and
    rows kept with a non-numeric product id (they pass as "no product")."""
    raw = fx.raw_clickstream(spark, sf_dir)
    typed = parse_clicks(raw, keep_raw_product=True)
    flagged = cl.mark_membership(typed, fx.click_catalog(spark, sf_dir), "product_id", "_in_cat")
    reason = cl.first_failing_reason(
        [
            ("bad_timestamp", F.col("event_timestamp").isNull()),
            ("unknown_event_type", ~F.coalesce(F.col("event_type").isin(VALID_EVENT_TYPES), F.lit(False))),
            ("unknown_product", F.col("product_id").isNotNull() & F.col("_in_cat").isNull()),
        ]
    )
    flagged = flagged.withColumn("_r", reason)
    return flagged.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col("_r").isNull()).alias("rows_after"),
        F.count_if(F.col("_r").isNotNull()).alias("rows_removed"),
        pct(F.count_if(F.col("_r").isNotNull()), F.count(F.lit(1))).alias("removed_pct"),
        F.count_if(F.col("_r") == "bad_timestamp").alias("bad_timestamp"),
        F.count_if(F.col("_r") == "unknown_event_type").alias("unknown_event_type"),
        F.count_if(F.col("_r") == "unknown_product").alias("unknown_product"),
        F.count_if(
            F.col("_r").isNull() & F.col("product_id").isNull() & F.col("_raw_product").isNotNull()
        ).alias("kept_non_numeric_product"),
    )


def run_job(spark: SparkSession, sf_dir: str, out_root: str | None = None) -> dict[str, str]:
    """The whole job (B14): clean once into a Parquet table, aggregate, write
    sessions and product-day partitioned by date (K8) and the daily summary
    unpartitioned (K9). Returns the output paths."""
    out_root = out_root or scratch_path(spark, "clickstream")
    clean_path = writers.write_parquet(clean_events(spark, sf_dir), f"{out_root}/clean_events")
    clean = spark.read.parquet(clean_path)
    # one event-sized aggregate feeds both sessions and the daily funnel
    sd_path = writers.write_parquet(session_days(clean), f"{out_root}/session_days")
    sd = spark.read.parquet(sd_path)
    return {
        "clean_events": clean_path,
        "session_days": sd_path,
        "sessions": writers.write_partitioned(sessions_from_days(sd), f"{out_root}/sessions", "event_date"),
        # one row per day: gathered into one sorted file by a shuffle of the
        # day rows only (no range-bound sampling; the aggregate stays parallel)
        "daily_summary": writers.write_parquet(
            daily_from(sd, ordered=False).repartition(1).sortWithinPartitions("event_date"),
            f"{out_root}/daily_summary",
        ),
        "product_daily": writers.write_partitioned(product_daily_from(clean), f"{out_root}/product_daily", "event_date"),
    }


def click_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the job, read the partitioned sessions back."""
    paths = run_job(spark, sf_dir)
    return spark.read.parquet(paths["sessions"])


def click_daily_summary_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: run the job, read the unpartitioned daily summary back."""
    paths = run_job(spark, sf_dir)
    return spark.read.parquet(paths["daily_summary"])


# ---------------------------------------------------------------- oracle SQL

register(
    "clicks_clean",
    """SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM (
    SELECT event_id, session_id, customer_id, event_type, TRY_CAST(product_id AS BIGINT) AS product_id,
           try_strptime(event_timestamp, '%Y-%m-%dT%H:%M:%S') AS event_timestamp, device_type
    FROM raw_clicks)
  WHERE event_timestamp IS NOT NULL
    AND event_type IN ('page_view', 'view_product', 'add_to_cart', 'purchase')
    AND (product_id IS NULL OR product_id IN (SELECT product_id FROM click_catalog))""",
    ["raw_clicks", "click_catalog"],
)

_SESSIONS_SQL = """
SELECT session_id,
       arg_min(customer_id, {'t': event_timestamp, 'e': event_id}) FILTER (WHERE customer_id IS NOT NULL)
           AS customer_id,
       arg_min(device_type, {'t': event_timestamp, 'e': event_id}) FILTER (WHERE device_type IS NOT NULL)
           AS device_type,
       MIN(event_timestamp) AS session_start, MAX(event_timestamp) AS session_end,
       CAST(COUNT(*) AS BIGINT) AS event_count,
       MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS converted,
       MIN(event_date) AS event_date,
       CAST(epoch(MAX(event_timestamp)) - epoch(MIN(event_timestamp)) AS BIGINT) AS duration_seconds
FROM clicks_clean WHERE session_id IS NOT NULL GROUP BY session_id"""

SQL = {
    "click_clean": "SELECT * FROM clicks_clean",
    "click_sessions": _SESSIONS_SQL,
    "click_daily_funnel": """
SELECT event_date,
       CAST(COUNT(*) FILTER (WHERE event_type = 'page_view') AS BIGINT) AS page_views,
       CAST(COUNT(*) FILTER (WHERE event_type = 'view_product') AS BIGINT) AS product_views,
       CAST(COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS BIGINT) AS add_to_carts,
       CAST(COUNT(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases,
       CAST(COUNT(DISTINCT session_id) AS BIGINT) AS sessions,
       ROUND(100.0 * CAST(COUNT(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE)
             / CAST(COUNT(DISTINCT session_id) AS DOUBLE), 2) AS conversion_rate_pct
FROM clicks_clean GROUP BY event_date ORDER BY event_date""",
    "click_product_daily": """
SELECT event_date, product_id,
       CAST(COUNT(*) FILTER (WHERE event_type = 'view_product') AS BIGINT) AS views,
       CAST(COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS BIGINT) AS add_to_carts,
       CAST(COUNT(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases
FROM clicks_clean WHERE product_id IS NOT NULL GROUP BY event_date, product_id""",
    "click_clean_summary": """
WITH t AS (
    SELECT product_id AS raw_product, TRY_CAST(product_id AS BIGINT) AS pid, event_type,
           try_strptime(event_timestamp, '%Y-%m-%dT%H:%M:%S') AS ts
    FROM raw_clicks
),
f AS (
    SELECT *, CASE WHEN ts IS NULL THEN 'bad_timestamp'
                   WHEN NOT COALESCE(event_type IN ('page_view', 'view_product', 'add_to_cart', 'purchase'), FALSE)
                        THEN 'unknown_event_type'
                   WHEN pid IS NOT NULL AND pid NOT IN (SELECT product_id FROM click_catalog) THEN 'unknown_product'
              END AS r
    FROM t
)
SELECT CAST(COUNT(*) AS BIGINT) AS rows_before, CAST(COUNT(*) FILTER (WHERE r IS NULL) AS BIGINT) AS rows_after,
       CAST(COUNT(*) FILTER (WHERE r IS NOT NULL) AS BIGINT) AS rows_removed,
       ROUND(100.0 * CAST(COUNT(*) FILTER (WHERE r IS NOT NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 2)
           AS removed_pct,
       CAST(COUNT(*) FILTER (WHERE r = 'bad_timestamp') AS BIGINT) AS bad_timestamp,
       CAST(COUNT(*) FILTER (WHERE r = 'unknown_event_type') AS BIGINT) AS unknown_event_type,
       CAST(COUNT(*) FILTER (WHERE r = 'unknown_product') AS BIGINT) AS unknown_product,
       CAST(COUNT(*) FILTER (WHERE r IS NULL AND pid IS NULL AND raw_product IS NOT NULL) AS BIGINT)
           AS kept_non_numeric_product
FROM f""",
    "click_partitioned_roundtrip": _SESSIONS_SQL,
}
SQL["click_daily_summary_roundtrip"] = SQL["click_daily_funnel"]

QUERIES = {
    "click_clean": click_clean,
    "click_sessions": click_sessions,
    "click_daily_funnel": click_daily_funnel,
    "click_product_daily": click_product_daily,
    "click_clean_summary": click_clean_summary,
    "click_partitioned_roundtrip": click_partitioned_roundtrip,
    "click_daily_summary_roundtrip": click_daily_summary_roundtrip,
}
ORACLE = {name: with_fixtures(sql) for name, sql in SQL.items()}
