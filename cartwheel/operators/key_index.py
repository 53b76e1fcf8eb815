"""A stored index of loaded keys: Bloom filters in front of exact key buckets
(J10, K7, U4).

Whether a batch's keys are loaded already must not cost a scan of an
ever-growing target. The index holds every loaded key once more, in hash
buckets (``sinks/snapshot.py``), and in front of each bucket a Bloom filter:
2**15-bit blocks kept as rows (block, bitmap). A key belongs to one block and
sets ``HASHES`` bits there, so asking for it is one join of the batch with
the filter rows of the batch's buckets. Keys whose bits are all set may be
loaded; only the buckets that hold such a key are read, and an exact join
settles them. A load adds parts to the buckets it touches and rewrites nothing.

Filters are made by Spark's bitmap aggregates. When more than twice as many
keys are stored as the filter was made for, it is made anew for twice as many
again, from the key buckets; until then a fuller filter only reads more
buckets, never answers wrongly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_dir, scratch_path
from ..sinks.snapshot import BUCKET, BucketedTable

#: Bits a key sets in its block, and bits of the filter per key it is made for.
HASHES, BITS_PER_KEY = 6, 10
#: Bits of one block: the size of Spark's bitmaps.
BLOCK_BITS = 32768
TAG = "batch"


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the shared scratch folder."""
    path = scratch_path(df.sparkSession, "keys")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _united(rows: DataFrame) -> DataFrame:
    """One bitmap for each block."""
    return rows.groupBy("block").agg(F.bitmap_or_agg(F.col("bitmap")).alias("bitmap"))


class KeyIndex:
    """Index over one key column at ``root``. ``buckets`` and ``expected`` (keys
    the filter is first made for) hold for a new index only."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int | None = None, expected: int = 1_000_000):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.keys = BucketedTable(spark, f"{self.root}/keys", key, buckets)
        self.buckets = self.keys.buckets
        made = [n for n in list_dir(spark, self.root) if n.startswith("filter-")]
        self.blocks = max([int(n.split("-")[1]) for n in made], default=self._blocks_for(expected))

    def _blocks_for(self, keys: int) -> int:
        """Blocks per bucket."""
        return max(1, -(-keys * BITS_PER_KEY // (BLOCK_BITS * self.buckets)))

    def _filter(self) -> BucketedTable:
        per = self.blocks
        return BucketedTable(
            self.spark, f"{self.root}/filter-{per}", "block", self.buckets, place=lambda: F.expr(f"block div {per}")
        )

    # ------------------------------------------------------------ bits

    def _block(self) -> Column:
        inside = F.pmod(F.xxhash64(F.lit(7), F.col(self.key)), F.lit(self.blocks))
        return F.col(BUCKET) * self.blocks + inside

    def _bits(self) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(11 + i), F.col(self.key)), F.lit(BLOCK_BITS)) for i in range(HASHES)]

    def _bitmaps(self, keyed: DataFrame) -> DataFrame:
        """(block, bitmap) of keys with their bucket."""
        bits = keyed.select(self._block().alias("block"), F.explode(F.array(*self._bits())).alias("bit"))
        return bits.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bitmap"))

    @staticmethod
    def _set(bitmap: Column, bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(1) == 1

    # ------------------------------------------------------------ asking

    def maybe(self, keys: DataFrame) -> DataFrame:
        """Distinct non-NULL keys of ``keys`` that the filter does not rule out, with their bucket."""
        asked = written(self.keys.with_bucket(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()))
        found = self._filter().read(self.keys.buckets_in(asked))
        if found is None:
            return asked.where(F.lit(False))
        hit = asked.withColumn("block", self._block()).join(_united(found), "block")
        every = F.lit(True)
        for bit in self._bits():
            every = every & self._set(F.col("bitmap"), bit)
        return written(hit.where(every).select(self.key, BUCKET))

    def present(self, keys: DataFrame, without: str | None = None) -> DataFrame:
        """The distinct keys of ``keys`` that are stored, those of the batch named
        ``without`` left aside. Exact; NULL is never stored. Reads the filter rows
        of the asked buckets and the key buckets the filter points to."""
        candidates = self.maybe(keys)
        stored = self.keys.read(self.keys.buckets_in(candidates))
        if stored is None:
            return candidates.select(self.key)
        if without is not None:
            stored = stored.where(F.col(TAG) != without)
        return candidates.select(self.key).join(stored.select(self.key), self.key, "left_semi")

    # ------------------------------------------------------------ loading

    def batches(self) -> set[str]:
        return self.keys.tags()

    def add(self, keys: DataFrame, batch: str) -> None:
        """Stores the keys of one batch under its name; a batch that is stored already is replaced.

        The filter comes first: a crash in between leaves bits without keys,
        which only cost a look into a bucket, never a key without its bits.
        """
        if batch in self.batches():
            self.forget(batch)
        own = written(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct().withColumn(TAG, F.lit(batch)))
        self._filter().append(self._bitmaps(self.keys.with_bucket(own)))
        self.keys.append(own, tag=batch)
        self.keys.compact(16)
        if (rows := self.keys.rows()) * BITS_PER_KEY > 2 * self.blocks * self.buckets * BLOCK_BITS:
            self._grow(2 * rows)
        else:
            self._filter().compact(16, _united)

    def forget(self, batch: str) -> None:
        """Removes a batch's keys (the filter keeps their bits)."""
        self.keys.delete_where(F.col(TAG) == batch, forget_tag=batch)

    def _grow(self, expected: int) -> None:
        self.blocks = self._blocks_for(expected)
        stored = self.keys.with_bucket(self.keys.read())
        self._filter().append(self._bitmaps(stored.select(self.key, BUCKET)))
