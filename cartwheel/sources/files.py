"""File sources (S1-S6, S10-S12) with explicit schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.writers import ISO_TS


def all_string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Header CSV, every column text; an empty field reads as NULL."""
    return spark.read.schema(all_string_schema(columns)).option("header", True).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a declared schema."""
    return spark.read.schema(schema).option("header", True).option("timestampFormat", ISO_TS).csv(path)


def read_json_typed(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """JSON records with a declared schema (JSON lines, or one array per file)."""
    return (
        spark.read.schema(schema).option("multiLine", multiline).option("timestampFormat", ISO_TS).json(path)
    )


def key_set(df: DataFrame, column: str) -> DataFrame:
    """The distinct keys of one column (used as a catalog)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


RECORD_SCHEMA = T.StructType(
    [
        T.StructField("marketplace_order_id", T.StringType()),
        T.StructField("customer_email", T.StringType()),
        T.StructField("product_sku", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("order_ts", T.StringType()),
        T.StructField("amount_usd", T.DoubleType()),
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page", T.LongType()),
        T.StructField("page_size", T.LongType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("has_next", T.BooleanType()),
        T.StructField("results", T.ArrayType(RECORD_SCHEMA)),
    ]
)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """Envelopes to flat records; (page, pos) is the arrival order."""
    return pages.select("page", F.posexplode("results").alias("pos", "r")).select("page", "pos", "r.*")


def reconcile_pages(pages: DataFrame) -> DataFrame:
    """Records fetched vs announced, pages seen vs the last page number.

    Pages are numbered 1..last; ``missing_pages`` counts the gaps and
    ``complete`` holds when nothing is missing and the counts agree.
    """
    agg = pages.agg(
        F.coalesce(F.sum(F.size("results")), F.lit(0)).cast("bigint").alias("records_fetched"),
        F.max("total_records").cast("bigint").alias("total_records"),
        F.max("page").cast("bigint").alias("last_page"),
        F.countDistinct("page").cast("bigint").alias("pages_seen"),
        F.count_if(~F.col("has_next")).cast("bigint").alias("final_pages"),
    )
    return agg.select(
        "*",
        (F.col("last_page") - F.col("pages_seen")).alias("missing_pages"),
        (
            (F.col("last_page") == F.col("pages_seen"))
            & (F.col("records_fetched") == F.col("total_records"))
            & (F.col("final_pages") == 1)
        ).alias("complete"),
    )


def missing_pages(pages: DataFrame) -> DataFrame:
    """The page numbers from 1 to the last one seen that are not there,
    by an anti join of the number sequence. The sequence is cut into runs of
    1,000 numbers before it is expanded, so no task makes all of them."""
    last = pages.agg(F.max("page").alias("last")).where(F.col("last").isNotNull())
    runs = last.select("last", F.explode(F.sequence(F.lit(0), F.expr("last div 1000"))).alias("run"))
    spread = runs.repartition("run")
    low, high = F.col("run") * 1000 + 1, F.least(F.col("run") * 1000 + 1000, F.col("last"))
    numbers = spread.where(low <= high).select(F.explode(F.sequence(low, high)).alias("page"))
    return numbers.join(pages.select("page").distinct(), "page", "left_anti")


def json_array_elements(lines: DataFrame, schema, indent: int = 2, options: dict[str, str] | None = None) -> DataFrame:
    """Rows of the objects of indented JSON arrays, from their text cut behind
    each object (column ``value``, see :func:`read_json_array`). What is cut is
    the object up to its closing brace, after ``[`` or a comma; behind the last
    one is only ``]``."""
    body = F.regexp_replace("value", r"^[\s\[,]+", "")
    objects = lines.select(body.alias("_cw_body")).where(F.col("_cw_body").startswith("{"))
    parsed = F.from_json(F.concat("_cw_body", F.lit("}")), schema, {"mode": "FAILFAST", **(options or {})})
    return objects.select(parsed.alias("_cw_row")).select("_cw_row.*")


def read_json_array(spark: SparkSession, path: str, schema, indent: int = 2, options: dict[str, str] | None = None) -> DataFrame:
    """S6/S10 array form: files that hold one array of objects, indented by
    ``indent`` as JSON writers do. One large file is read by several tasks.

    A JSON string cannot hold a line break, and inner objects are indented
    deeper, so a line break, ``indent`` blanks and a closing brace end an object
    of the array and nothing else. That is the line separator of a text scan,
    which splits files by byte ranges and finds the next separator by itself.
    An object that does not parse fails the read. Arrays without line breaks
    have no such mark: they are read whole by ``read_json_typed(multiline=True)``.
    """
    lines = spark.read.option("lineSep", "\n" + " " * indent + "}").text(path)
    return json_array_elements(lines, schema, indent, options)


def stream_json_array(spark: SparkSession, path: str, schema, indent: int = 2, options: dict[str, str] | None = None) -> DataFrame:
    """The same as a stream of files that are added to a folder."""
    lines = spark.readStream.option("lineSep", "\n" + " " * indent + "}").text(path)
    return json_array_elements(lines, schema, indent, options)
