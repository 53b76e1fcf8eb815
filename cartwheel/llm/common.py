"""Small helpers shared by the text operators: reading, null handling, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import scratch_path

#: ASCII white space as the contracts spell it: space and U+0009 to U+000D.
WHITE = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this library's modules, once per application, so
    Python stages run wherever the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "cartwheel.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def read_documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text as a string, null as the empty string."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so helper columns beside it clash with none."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage with a table that every executor sees, so a lost
    executor never makes earlier stages run again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def remainder(col: str, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n
