"""Raw orders export: profile, clean, summarise, compare formats.

Cleaning rules, in order (B12): drop exact duplicate rows; blank customer or
date to NULL and drop such rows; parse the date with the first of four
layouts that fits, drop unparseable; quantity to a whole number with 1 for
missing or unreadable; status lower-cased into its domain else 'unknown';
NULL channel to 'unknown'; ids cast strictly (a bad id fails the job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import parse_first_format
from ..functions.numeric import coerce_long
from ..operators import cleaning as cl
from ..operators import quality as q
from ..oracle import with_fixtures
from ..session import scratch_path
from ..sinks import writers
from ..sources import files
from ..sources import fixtures as fx

# Fixed domain of order statuses (values must match the original cleaning rule).
VALID_STATUSES = ["completed", "shipped", "cancelled", "pending"]
EXPORT_COLUMNS = ["order_row_id", "customer_id", "product_id", "order_date", "quantity", "status", "channel"]


def _typed(df: DataFrame) -> DataFrame:
    """Rules 3-7 on rows that survived de-duplication and the NULL drop."""
    return df.select(
        "order_row_id",
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        parse_first_format(F.col("order_date")).alias("order_date"),
        coerce_long(F.col("quantity"), default=1).alias("quantity"),
        cl.normalize_domain(F.col("status"), VALID_STATUSES).alias("status"),
        F.coalesce(F.col("channel"), F.lit("unknown")).alias("channel"),
    )


def clean_orders_frame(raw: DataFrame) -> DataFrame:
    df = cl.drop_exact_duplicates(raw)
    df = cl.blank_to_null(df, ["customer_id", "order_date"])
    df = cl.drop_nulls(df, ["customer_id", "order_date"])
    return cl.drop_nulls(_typed(df), ["order_date"])


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders_frame(fx.raw_orders_export(spark, sf_dir))


def clean_orders_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B12 from a CSV file: the raw export written as CSV (K1), read back with
    every column as text (S1/S2), then cleaned."""
    path = writers.write_csv(fx.raw_orders_export(spark, sf_dir), scratch_path(spark, "raw_orders_csv"))
    return clean_orders_frame(files.read_csv_text(spark, path, EXPORT_COLUMNS))


def clean_orders_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 in one pass: distinct rows carry their multiplicity, the validity
    test runs once per distinct row, both counts come from one aggregate."""
    raw = fx.raw_orders_export(spark, sf_dir)
    grouped = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_n"))
    valid = (
        (F.nullif(F.col("customer_id"), F.lit("")).isNotNull())
        & F.nullif(F.col("order_date"), F.lit("")).isNotNull()
        & parse_first_format(F.col("order_date")).isNotNull()
    )
    return grouped.agg(
        *q.removal_summary(F.sum("_n"), F.count_if(valid)),
        F.sum(F.col("_n") - 1).cast("bigint").alias("duplicates_removed"),
    )


def profile_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.shape(fx.raw_orders_export(spark, sf_dir))


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.column_profile(fx.raw_orders_export(spark, sf_dir))


def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.duplicate_rows(fx.raw_orders_export(spark, sf_dir))


def profile_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.value_counts(fx.raw_orders_export(spark, sf_dir), "status")


def write_formats(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    """K1-K3: the clean orders as CSV, JSON lines and Parquet; the root folder
    and each format read back (S3, S6, S7). The cleaning (a de-duplicating
    shuffle) runs once: Parquet is written first and the text formats are
    written from that stored table."""
    clean = clean_orders(spark, sf_dir)
    root = scratch_path(spark, "formats")
    paths = writers.write_three_formats(clean, root)
    return root, {
        "csv": files.read_csv_typed(spark, paths["csv"], clean.schema),
        "json": files.read_json_typed(spark, paths["json"], clean.schema),
        "parquet": spark.read.parquet(paths["parquet"]),
    }


def format_size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and values of the clean orders as each format gives them back,
    and whether every row equals one of the Parquet table (compared by a hash
    of all columns, summed in decimals). Bytes depend on the machine and are
    in :func:`format_bytes`."""
    _, back = write_formats(spark, sf_dir)
    out = None
    for fmt, df in back.items():
        one = df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("channel").alias("channels"),
            F.sum("quantity").cast("bigint").alias("quantity"),
            F.count_distinct("order_date").alias("days"),
            F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("_hash"),
        ).withColumn("format", F.lit(fmt))
        out = one if out is None else out.unionByName(one)
    whole = Window.partitionBy(F.lit(1))  # three rows
    same = F.col("_hash") == F.max(F.when(F.col("format") == "parquet", F.col("_hash"))).over(whole)
    return out.withColumn("same_as_parquet", same).drop("_hash").orderBy("format")


def format_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes per format, from a ``binaryFile`` listing that reads no content."""
    root, _ = write_formats(spark, sf_dir)
    return writers.file_sizes(spark, root).orderBy("format")


# ---------------------------------------------------------------- oracle SQL

_CLEAN_SQL = """
WITH d AS (SELECT DISTINCT * FROM raw_orders_export),
b AS (
    SELECT order_row_id, NULLIF(customer_id, '') AS customer_id, product_id,
           NULLIF(order_date, '') AS order_date, quantity, status, channel
    FROM d
),
p AS (
    SELECT *, COALESCE(try_strptime(order_date, '%Y-%m-%d'), try_strptime(order_date, '%d/%m/%Y'),
                       try_strptime(order_date, '%m-%d-%Y'), try_strptime(order_date, '%Y/%m/%d')) AS ts,
           TRY_CAST(quantity AS DOUBLE) AS qd
    FROM b WHERE customer_id IS NOT NULL AND order_date IS NOT NULL
)
SELECT order_row_id, CAST(customer_id AS BIGINT) AS customer_id, CAST(product_id AS BIGINT) AS product_id,
       ts AS order_date,
       COALESCE(TRY_CAST(TRUNC(CASE WHEN isfinite(qd) THEN qd END) AS BIGINT), 1) AS quantity,
       CASE WHEN lower(status) IN ('completed', 'shipped', 'cancelled', 'pending') THEN lower(status)
            ELSE 'unknown' END AS status,
       COALESCE(channel, 'unknown') AS channel
FROM p WHERE ts IS NOT NULL"""

_SUMMARY_SQL = """
WITH g AS (SELECT order_row_id, customer_id, product_id, order_date, quantity, status, channel, COUNT(*) AS n
           FROM raw_orders_export GROUP BY ALL),
v AS (
    SELECT n, NULLIF(customer_id, '') IS NOT NULL AND NULLIF(order_date, '') IS NOT NULL
              AND COALESCE(try_strptime(order_date, '%Y-%m-%d'), try_strptime(order_date, '%d/%m/%Y'),
                           try_strptime(order_date, '%m-%d-%Y'), try_strptime(order_date, '%Y/%m/%d')) IS NOT NULL
              AS ok
    FROM g
)
SELECT CAST(SUM(n) AS BIGINT) AS rows_before, CAST(COUNT(*) FILTER (WHERE ok) AS BIGINT) AS rows_after,
       CAST(SUM(n) - COUNT(*) FILTER (WHERE ok) AS BIGINT) AS rows_removed,
       ROUND(100.0 * CAST(SUM(n) - COUNT(*) FILTER (WHERE ok) AS DOUBLE) / CAST(SUM(n) AS DOUBLE), 2) AS removed_pct,
       CAST(SUM(n - 1) AS BIGINT) AS duplicates_removed
FROM v"""

_PROFILE_COLUMNS_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, 'string' AS data_type, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count "
    f"FROM raw_orders_export"
    for c in EXPORT_COLUMNS
)

SQL = {
    "clean_orders": _CLEAN_SQL,
    "clean_orders_csv": _CLEAN_SQL,
    "clean_orders_summary": _SUMMARY_SQL,
    "format_size_report": f"""
SELECT f.format, COUNT(*) AS rows, COUNT(channel) AS channels, CAST(SUM(quantity) AS BIGINT) AS quantity,
       COUNT(DISTINCT order_date) AS days, TRUE AS same_as_parquet
FROM ({_CLEAN_SQL}), (VALUES ('csv'), ('json'), ('parquet')) f(format) GROUP BY f.format ORDER BY f.format""",
    "profile_shape": "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(7 AS BIGINT) AS n_columns FROM raw_orders_export",
    "profile_columns": _PROFILE_COLUMNS_SQL,
    "profile_duplicates": """
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM raw_orders_export
      GROUP BY order_row_id, customer_id, product_id, order_date, quantity, status, channel)""",
    "profile_value_counts": """
SELECT status, CAST(COUNT(*) AS BIGINT) AS n FROM raw_orders_export GROUP BY status ORDER BY n DESC, status""",
}

QUERIES = {
    "clean_orders": clean_orders,
    "clean_orders_csv": clean_orders_csv,
    "clean_orders_summary": clean_orders_summary,
    "profile_shape": profile_shape,
    "profile_columns": profile_columns,
    "profile_duplicates": profile_duplicates,
    "profile_value_counts": profile_value_counts,
    "format_size_report": format_size_report,
}
ORACLE = {name: with_fixtures(sql) for name, sql in SQL.items()}
