"""Marketplace API records: land, flatten, validate, load.

The HTTP client of the original is replaced by landed page files: each API
page envelope is one JSON line ``{page, page_size, total_records, has_next,
results: [...]}``. Everything after landing is a Spark job.

Validation (B13), reasons in this order, the first failing one is reported:
``duplicate`` (not the first arrival of its marketplace_order_id by
(page, pos)), ``unknown_product`` (SKU without 'SKU-' is not a whole number
in the catalog), ``bad_timestamp``, ``bad_quantity`` (missing or <= 0),
``bad_amount`` (missing or <= 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_iso_utc
from ..functions.numeric import integral_long
from ..operators import cleaning as cl
from ..operators.quality import apply_defaults
from ..oracle import with_fixtures
from ..session import scratch_path
from ..sinks import writers
from ..sinks.materialize import materialized
from ..sinks.snapshot import BucketedTable
from ..sources import files
from ..sources import fixtures as fx

PAGE_SIZE = 50
CLEAN_COLUMNS = ["source_order_id", "customer_email", "product_id", "quantity", "order_ts", "amount_usd"]


def build_pages(records: DataFrame) -> DataFrame:
    """Group flat records into API envelopes. A page is a span of order keys, so
    it holds as many records as the span has, and those sent again."""
    fields = [c for c in records.columns if c not in ("page", "seq")]
    total = records.agg(F.count(F.lit(1))).scalar()
    last_page = records.agg(F.max("page")).scalar()
    # records of a page are few and hardly meet in one task: they are shuffled as they
    # are, so no task holds arrays of half-made pages before the shuffle
    grouped = records.repartition("page").groupBy("page").agg(
        F.sort_array(F.collect_list(F.struct("seq", *fields))).alias("_recs")
    )
    return grouped.select(
        F.col("page").cast("bigint"),
        F.lit(PAGE_SIZE).cast("bigint").alias("page_size"),
        total.cast("bigint").alias("total_records"),
        (F.col("page") < last_page).alias("has_next"),
        F.transform("_recs", lambda r: F.struct(*[r[c].alias(c) for c in fields])).alias("results"),
    )


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the raw page envelopes, written once unmodified (replayable) as gzip
    files of JSON lines, one per task, read back (S6)."""
    return materialized(
        spark,
        f"marketplace_pages_json|{sf_dir}",
        lambda: build_pages(fx.marketplace_records(spark, sf_dir)),
        fmt="json",
        schema=files.PAGE_SCHEMA,
        options={"compression": "gzip"},
    )


def page_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat records in arrival order. The landed JSON is parsed once and kept
    as a Parquet table, so later steps read only the columns they use."""
    return materialized(
        spark, f"marketplace_flat|{sf_dir}", lambda: files.flatten_pages(landed_pages(spark, sf_dir))
    )


def interrupted_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelopes of a fetch that broke off and was resumed too far on: it
    got the first half of the pages, and then those from the 60 % mark."""
    pages = landed_pages(spark, sf_dir)
    last = pages.agg(F.max("page")).scalar()
    return pages.where((F.col("page") * 2 <= last) | (F.col("page") * 5 >= last * 3))


def page_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both fetches against what the API announced: the whole one agrees,
    the interrupted one lacks pages and records."""
    whole = files.reconcile_pages(landed_pages(spark, sf_dir)).withColumn("fetch", F.lit("whole"))
    broken = files.reconcile_pages(interrupted_fetch(spark, sf_dir)).withColumn("fetch", F.lit("interrupted"))
    return whole.unionByName(broken)


def page_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages that the interrupted fetch lacks, one row each."""
    return files.missing_pages(interrupted_fetch(spark, sf_dir)).orderBy("page")


def flag_records(flat: DataFrame, catalog: DataFrame) -> DataFrame:
    """Attach ``reject_reason`` (NULL = clean) and the parsed columns, in one pass.

    First arrival per id comes from a combining aggregate joined back, so a
    hot id is reduced map-side and its join partition can be split by AQE.
    """
    # arrival as one order-preserving BIGINT (pos < 2^31), so the aggregate
    # buffer is fixed-width and Spark can use hash aggregation
    arrival = F.col("page") * F.lit(2147483648) + F.col("pos")
    flat = flat.withColumn("_arrival", arrival)
    first = flat.groupBy("marketplace_order_id").agg(F.min("_arrival").alias("_first"))
    parsed = flat.join(first, "marketplace_order_id").select(
        "*",
        integral_long(cl.strip_literal(F.col("product_sku"), "SKU-")).alias("_pid"),
        parse_iso_utc(F.col("order_ts")).alias("_ts"),
    )
    # SKUs that are not numbers give a NULL id: spread those over reducers
    parsed = cl.mark_membership(parsed, catalog, "_pid", "_in_cat", catalog_key="product_id")
    reason = cl.first_failing_reason(
        [
            ("duplicate", F.col("_arrival") != F.col("_first")),
            ("unknown_product", F.col("_in_cat").isNull()),
            ("bad_timestamp", F.col("_ts").isNull()),
            ("bad_quantity", F.coalesce(F.col("quantity"), F.lit(0)) <= 0),
            ("bad_amount", F.col("amount_usd").isNull() | (F.col("amount_usd") <= 0)),
        ]
    )
    return parsed.withColumn("reject_reason", reason)


def clean_frame(flagged: DataFrame) -> DataFrame:
    return cl.split_by_reason(flagged)[0].select(
        F.col("marketplace_order_id").alias("source_order_id"),
        "customer_email",
        F.col("_pid").alias("product_id"),
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("_ts").alias("order_ts"),
        F.col("amount_usd").cast("double").alias("amount_usd"),
    )


def _flagged(spark: SparkSession, sf_dir: str, pages_where=None) -> DataFrame:
    flat = page_flatten(spark, sf_dir)
    if pages_where is not None:
        flat = flat.where(pages_where)
    return flag_records(flat, files.key_set(fx.products(spark, sf_dir), "product_id"))


def clean_marketplace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_frame(_flagged(spark, sf_dir))


def marketplace_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = cl.split_by_reason(_flagged(spark, sf_dir))
    return (
        rejected.groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "reject_reason")
    )


def marketplace_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.split_by_reason(_flagged(spark, sf_dir))[1].select(
        "page", "pos", "marketplace_order_id", "product_sku", "quantity", "order_ts", "amount_usd", "reject_reason"
    )


def marketplace_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, S6 array form: the clean records written as indented JSON arrays and
    read back in splits."""
    clean = clean_marketplace(spark, sf_dir)
    path = writers.write_json_array(clean, scratch_path(spark, "marketplace_arrays"))
    return files.read_json_array(spark, path, clean.schema, options={"timestampFormat": writers.ISO_TS})


# Two loads replayed with fixed load times, so the result is reproducible.
RUN1_AT = "2026-01-01 00:00:00"
RUN2_AT = "2026-01-02 00:00:00"


def upsert_marketplace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + F23 + C5: run 1 fetched the first two thirds of the pages, run 2
    fetched again from the one-third mark to the last page; rows of the
    second load replace those of the first by source_order_id and carry the
    second load time. The last page is a scalar subquery, not a driver value."""
    root = scratch_path(spark, "marketplace_orders")
    last = page_flatten(spark, sf_dir).agg(F.max("page")).scalar()
    page = F.col("page")
    for where, at in ((page * 3 <= last * 2, RUN1_AT), (page * 3 > last, RUN2_AT)):
        # loaded_at takes its default (this load's time) at write
        batch = apply_defaults(clean_frame(_flagged(spark, sf_dir, where)), {"loaded_at": F.lit(at).cast("timestamp")})
        BucketedTable(spark, root, "source_order_id").upsert(batch)
    return BucketedTable(spark, root, "source_order_id").read()


#: Order numbers in one bucket of the query below, so a load of the latest orders meets few buckets.
ORDERS_PER_BUCKET = 1000


def upsert_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: a full load, then corrections of the last page's orders, into buckets
    of consecutive order numbers: per bucket its rows and the version that
    wrote them. Buckets without a corrected order stay as version 1 wrote them."""
    root = scratch_path(spark, "marketplace_by_number")
    number = F.substring_index("source_order_id", "-", -1).cast("bigint")
    place = F.expr(f"cast(substring_index(source_order_id, '-', -1) as bigint) div {ORDERS_PER_BUCKET}")
    table = BucketedTable(spark, root, "source_order_id", place=lambda: place)
    clean = clean_frame(_flagged(spark, sf_dir))
    table.upsert(clean)
    last = table.read().agg(F.max(number)).scalar()
    table.upsert(table.read().where(number > last - 50).withColumn("amount_usd", F.col("amount_usd") + 1))
    return table.entries().select(
        "bucket", "rows", F.regexp_extract("path", "v=([0-9]+)", 1).cast("bigint").alias("version")
    )


# ---------------------------------------------------------------- oracle SQL


def _flagged_sql(where: str = "TRUE") -> str:
    return f"""
SELECT *,
       CASE WHEN rn > 1 THEN 'duplicate'
            WHEN pid IS NULL OR pid NOT IN (SELECT product_id FROM products) THEN 'unknown_product'
            WHEN ts IS NULL THEN 'bad_timestamp'
            WHEN COALESCE(quantity, 0) <= 0 THEN 'bad_quantity'
            WHEN amount_usd IS NULL OR amount_usd <= 0 THEN 'bad_amount' END AS reject_reason
FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY marketplace_order_id ORDER BY page, pos) AS rn,
           CASE WHEN isfinite(pd) AND pd = floor(pd) THEN TRY_CAST(pd AS BIGINT) END AS pid,
           TRY_CAST(order_ts AS TIMESTAMP) AS ts
    FROM (SELECT *, TRY_CAST(replace(product_sku, 'SKU-', '') AS DOUBLE) AS pd FROM mkt_flat WHERE {where})
)"""


def _clean_sql(where: str = "TRUE") -> str:
    return f"""
SELECT marketplace_order_id AS source_order_id, customer_email, pid AS product_id, quantity, ts AS order_ts,
       amount_usd
FROM ({_flagged_sql(where)}) WHERE reject_reason IS NULL"""


from ..oracle import register  # noqa: E402

register(
    "mkt_flat",
    """SELECT page, CAST(ROW_NUMBER() OVER (PARTITION BY page ORDER BY seq) - 1 AS INTEGER) AS pos,
       marketplace_order_id, customer_email, product_sku, quantity, order_ts, amount_usd
  FROM mkt_records""",
    ["mkt_records"],
)

SQL = {
    "upsert_touched_buckets": f"""
WITH c AS (SELECT CAST(substr(source_order_id, 5) AS BIGINT) AS nr FROM ({_clean_sql()}))
SELECT nr // {ORDERS_PER_BUCKET} AS bucket, COUNT(*) AS "rows",
       CASE WHEN MAX(nr) > (SELECT MAX(nr) FROM c) - 50 THEN 2 ELSE 1 END::BIGINT AS version
FROM c GROUP BY 1""",
    "page_flatten": "SELECT * FROM mkt_flat",
    "page_reconcile": """
WITH z AS (SELECT MAX(page) AS z, COUNT(*) AS announced FROM mkt_records),
got AS (SELECT 'whole' AS "fetch", page FROM mkt_records
        UNION ALL SELECT 'interrupted', page FROM mkt_records, z WHERE page <= z / 2.0 OR page >= z * 0.6)
SELECT "fetch", COUNT(*) AS records_fetched, CAST(announced AS BIGINT) AS total_records, MAX(page) AS last_page,
       COUNT(DISTINCT page) AS pages_seen, COUNT(DISTINCT page) FILTER (WHERE page = z) AS final_pages,
       MAX(page) - COUNT(DISTINCT page) AS missing_pages,
       MAX(page) = COUNT(DISTINCT page) AND COUNT(*) = announced AND bool_or(page = z) AS complete
FROM got, z GROUP BY "fetch", announced, z""",
    "page_gaps": """
WITH z AS (SELECT MAX(page) AS z FROM mkt_records)
SELECT CAST(n AS BIGINT) AS page FROM z, generate_series(1, (SELECT MAX(page) FROM mkt_records)) s(n)
WHERE n > z / 2.0 AND n < z * 0.6 ORDER BY n""",
    "clean_marketplace": _clean_sql(),
    "marketplace_json_array": _clean_sql(),
    "marketplace_reject_counts": f"""
SELECT reject_reason, CAST(COUNT(*) AS BIGINT) AS n FROM ({_flagged_sql()})
WHERE reject_reason IS NOT NULL GROUP BY reject_reason ORDER BY n DESC, reject_reason""",
    "marketplace_quarantine": f"""
SELECT page, pos, marketplace_order_id, product_sku, quantity, order_ts, amount_usd, reject_reason
FROM ({_flagged_sql()}) WHERE reject_reason IS NOT NULL""",
    "upsert_marketplace": f"""
WITH run1 AS ({_clean_sql('page * 3 <= (SELECT MAX(page) FROM mkt_flat) * 2')}),
run2 AS ({_clean_sql('page * 3 > (SELECT MAX(page) FROM mkt_flat)')})
SELECT *, TIMESTAMP '{RUN1_AT}' AS loaded_at FROM run1
WHERE source_order_id NOT IN (SELECT source_order_id FROM run2)
UNION ALL
SELECT *, TIMESTAMP '{RUN2_AT}' AS loaded_at FROM run2""",
}

QUERIES = {
    "page_flatten": page_flatten,
    "page_reconcile": page_reconcile,
    "page_gaps": page_gaps,
    "clean_marketplace": clean_marketplace,
    "marketplace_reject_counts": marketplace_reject_counts,
    "marketplace_quarantine": marketplace_quarantine,
    "marketplace_json_array": marketplace_json_array,
    "upsert_marketplace": upsert_marketplace,
    "upsert_touched_buckets": upsert_touched_buckets,
}
ORACLE = {name: with_fixtures(sql) for name, sql in SQL.items()}
