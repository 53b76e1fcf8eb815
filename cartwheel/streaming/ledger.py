"""Which source files, and which of their rows, were taken by which batch.

A mark on a timestamp cannot tell a late row from one that was loaded: either
everything is read again or late rows are lost. The ledger knows the files
instead. A run lists the source (names, sizes and times only), takes off what
the ledger has, and reads just the rest, whatever timestamps are in it. A
file that was written again (other size or time) counts as new; its repeated
keys drop out at the target.

With ``rows_per_run`` a large file is taken in slices of rows: the ledger
keeps the next row of every file, and the following runs go on from there.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.commit import commit, committed_children

ENTRY = "file string, size bigint, modified timestamp, first_row bigint, next_row bigint, whole boolean, batch_id string"
_FILE = ["file", "size", "modified"]


@dataclass
class FileSource:
    """A folder of Parquet files that grows by files. ``transform`` makes the
    rows to load from the stored ones (row by row: a projection or a filter)."""

    path: str
    schema: T.StructType | str
    transform: Callable[[DataFrame], DataFrame] | None = None
    rows_per_run: int | None = None

    def listing(self, spark: SparkSession) -> DataFrame:
        """(path, file, size, modified) of every file: the listing alone, no content."""
        files = (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(self.path)
        )
        return files.select(
            "path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
        )

    def stored(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*paths)


class FileLedger:
    """The ledger at ``root``: a committed directory of entries for each batch,
    below the round they belong to (``reset`` opens a new round)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _round(self) -> int:
        return len(committed_children(self.spark, self.root, "round="))

    def _at(self) -> str:
        return f"{self.root}/entries-{self._round()}"

    def _names(self) -> list[str]:
        return committed_children(self.spark, self._at(), "batch=")

    def reset(self) -> None:
        """The next run takes every file again (earlier entries are kept)."""
        path = f"{self.root}/round={self._round() + 1:06d}"
        self.spark.range(0).write.mode("overwrite").parquet(path)
        commit(self.spark, path)

    def next_batch(self) -> str:
        """The same name until that batch is recorded, so a repeated run replaces what a failed one wrote."""
        return f"{self._round()}-{len(self._names()) + 1:06d}"

    def entries(self) -> DataFrame:
        """Every entry since the last reset: which rows of which file each batch took."""
        names = self._names()
        if not names:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(*[f"{self._at()}/{n}" for n in names])

    def pending(self, source: FileSource) -> DataFrame:
        """(path, file, size, modified, first_row) of files with rows still to be taken."""
        done = self.entries().groupBy(*_FILE).agg(F.max("next_row").alias("first_row"), F.max("whole").alias("whole"))
        listed = source.listing(self.spark).join(done, _FILE, "left")
        left = listed.where(~F.coalesce("whole", F.lit(False)))
        return left.select("path", *_FILE, F.coalesce("first_row", F.lit(0)).cast("bigint").alias("first_row"))

    def take(self, source: FileSource) -> tuple[DataFrame, DataFrame] | None:
        """The rows of the pending files, and the entries (without a batch) that say so; None when there is none.

        The driver holds the names of the pending files, as for any scan."""
        pending = self.pending(source).collect()
        if not pending:
            return None
        kind = "file string, size bigint, modified timestamp, first_row bigint"
        files = self.spark.createDataFrame([(r["file"], r["size"], r["modified"], r["first_row"]) for r in pending], kind)
        rows = source.stored(self.spark, [r["path"] for r in pending])
        # no stored column is asked for: the counts come from the footers
        counts = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        total = F.coalesce("rows", F.lit(0))  # a file without rows has no row to count
        end = total if source.rows_per_run is None else F.least(total, F.col("first_row") + source.rows_per_run)
        entries = files.join(counts, "file", "left").select(
            *_FILE, "first_row", end.cast("bigint").alias("next_row"), (end >= total).alias("whole")
        )
        if source.rows_per_run is not None or any(r["first_row"] for r in pending):
            names = rows.columns
            ranges = entries.select(F.col("file").alias("_cw_file"), "first_row", "next_row")
            placed = rows.select("*", F.col("_metadata.file_path").alias("_cw_file"), F.col("_metadata.row_index").alias("_cw_row"))
            inside = (F.col("_cw_row") >= F.col("first_row")) & (F.col("_cw_row") < F.col("next_row"))
            rows = placed.join(ranges, "_cw_file").where(inside).select(*[F.col(f"`{c}`") for c in names])
        return (source.transform(rows) if source.transform else rows), entries

    def record(self, entries: DataFrame, batch_id: str) -> None:
        """Commits the entries of a batch; its files are not pending any more."""
        path = f"{self._at()}/batch={batch_id}"
        out = entries.withColumn("batch_id", F.lit(batch_id)).select(*_FILE, "first_row", "next_row", "whole", "batch_id")
        out.coalesce(1).write.mode("overwrite").parquet(path)
        commit(self.spark, path)
