"""Master data from CSV files (S12): customers and products as header CSV,
read with declared types and landed as Parquet tables. Column defaults apply
where the file has no value (C5: a product is active, unless it says not)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import apply_defaults
from ..oracle import with_fixtures
from ..session import scratch_path
from ..sinks.writers import write_csv, write_parquet
from ..sources import files
from ..sources import fixtures as fx


def ingest(spark: SparkSession, table: DataFrame, name: str, defaults: dict | None = None) -> DataFrame:
    """``table`` exported as CSV, read back with its declared types, landed as Parquet."""
    path = write_csv(table, scratch_path(spark, f"master_{name}_csv"))
    typed = apply_defaults(files.read_csv_typed(spark, path, table.schema), defaults or {})
    return spark.read.parquet(write_parquet(typed, scratch_path(spark, f"master_{name}")))


def ingest_customers_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, fx.customers(spark, sf_dir), "customers")


def ingest_products_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file leaves the flag empty for active products; the default fills it."""
    p = fx.products(spark, sf_dir).withColumn("active", F.nullif(F.col("active"), F.lit(1)))
    out = ingest(spark, p, "products", {"active": F.lit(1)})
    return out.withColumns({c: F.col(c).cast("double") for c in ("unit_price", "unit_cost")})


SQL = {
    "ingest_customers_csv": "SELECT * FROM customers",
    "ingest_products_csv": """SELECT product_id, product_name, category, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(unit_cost AS DOUBLE) AS unit_cost, active FROM products""",
}
QUERIES = {"ingest_customers_csv": ingest_customers_csv, "ingest_products_csv": ingest_products_csv}
ORACLE = {name: with_fixtures(sql) for name, sql in SQL.items()}
