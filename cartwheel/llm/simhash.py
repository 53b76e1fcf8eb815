"""SimHash near-duplicates by pigeonhole blocks.

A 64-bit fingerprint is cut into six blocks. Two fingerprints that differ in
at most three bits agree on at least three of the six, so they share one of
the 20 keys made of three blocks. Fingerprints meet on those keys and their
Hamming distance is checked. A key that many different fingerprints share is
split again by the same rule over its remaining bits, and once more, so a
group never holds more than ``2**16`` fingerprints after the second cut and
``2**13`` after the third, whatever the input; no pair is lost.

Each group links its members by a spanning forest of the verified pairs
(at most members - 1 rows), never by all pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cartwheel.llm import graph
from cartwheel.llm.common import read_documents, saved, text_of, whole_row

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Groups up to this many fingerprints are compared at once; larger ones are cut again.
GROUP = 512

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """SimHash of the word n-grams of one text (unsigned 64 bits, 0 if it has no word).

    bytes.split() cuts at exactly the ASCII white space of the contract.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    k = max(1, len(words) - n + 1)
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:k]
    stops = (ends - 1)[min(n, len(words)) - 1 :][:k]
    hashes = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), stops.tolist())), np.uint64, k
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, k, 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > k).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _add_fingerprints(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` with their last column, the text, replaced by its fingerprint.
    A worker holds one text at a time beside the batch."""
    schema = StructType([*[StructField(f.name, f.dataType) for f in rows.schema.fields[:-1]], StructField("fp", LongType())])

    def run(batches):
        for batch in batches:
            *kept, texts = batch.columns
            fp = np.fromiter((fingerprint(t.as_py(), n) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*kept, pa.array(fp.view(np.int64))], names=schema.names)

    return rows.mapInArrow(run, schema)


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS, text: str = "text") -> DataFrame:
    """(doc_id, fp bigint) for every row; a null text counts as empty."""
    return _add_fingerprints(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(text).alias("text")), n)


def _cuts(bits: list[int], parts: int, keep: int) -> list[tuple[int, list[int]]]:
    """Masks of ``keep`` of ``parts`` blocks of the given bit places, each with the places left over."""
    blocks = [list(b) for b in np.array_split(np.array(bits, dtype=int), parts)]
    out = []
    for chosen in itertools.combinations(range(parts), keep):
        mask = sum(1 << int(b) for c in chosen for b in blocks[c])
        out.append((mask, [int(b) for c in range(parts) if c not in chosen for b in blocks[c]]))
    return out


def _plan(max_bits: int) -> list[dict[int, list[int]]]:
    """For each of three levels, mask -> finer masks. Level 0 hangs below mask 0."""
    levels: list[dict[int, list[int]]] = []
    todo = {0: list(range(64))}
    for parts, keep in ((2 * max_bits, max_bits), (2 * max_bits, max_bits), (max_bits + 1, 1)):
        level, below = {}, {}
        for mask, rest in todo.items():
            cuts = _cuts(rest, parts, keep) if max_bits else [(sum(1 << b for b in rest), [])]
            level[mask] = [mask | m for m, _ in cuts]
            below.update({mask | m: r for m, r in cuts})
        levels.append(level)
        todo = below
    return levels


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph of pairs within ``max_bits``.

    Breadth first from each unseen member: a round compares one member with
    the members not reached yet, so memory stays linear in the group.
    """
    fps = np.sort(fps.view(np.uint64))
    left = np.arange(len(fps))
    edges: list[tuple[int, int]] = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= max_bits
            found = left[near]
            edges += [(int(at), int(x)) for x in found]
            queue += found.tolist()
            left = left[~near]
    signed = fps.view(np.int64)
    return [(int(signed[a]), int(signed[b])) for a, b in edges]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """Edges (a, b) between fingerprints at most ``max_bits`` apart that connect
    exactly what all such pairs connect. ``distinct``: one column ``fp``."""
    spark = distinct.sparkSession
    schema = "a bigint, b bigint"
    levels = _plan(max_bits)
    parts: list[DataFrame] = []

    def forest(batches):
        """Rows come sorted by group, so a group is a run of rows, over batch borders too."""
        held: list[np.ndarray] = []
        key = None

        def close():
            e = _forest(np.concatenate(held), max_bits) if held else []
            return pd.DataFrame(np.array(e, np.int64).reshape(-1, 2), columns=["a", "b"])

        for pdf in batches:
            m, k, f = (pdf[c].to_numpy(np.int64) for c in ("mask", "key", "fp"))
            cut = np.flatnonzero((np.diff(m) != 0) | (np.diff(k) != 0)) + 1
            out = []
            for s, e in zip([0, *cut], [*cut, len(f)]):
                if s == e:
                    continue
                now = (m[s], k[s])
                if now != key and held:
                    out.append(close())
                    held = []
                key = now
                held.append(f[s:e])
            if out:
                yield pd.concat(out)
        if held:
            yield close()

    # a key of this level: the mask (as an id) and the masked fingerprint
    keyed = distinct.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in levels[0][0]])).alias("mask"))
    for depth in range(len(levels)):
        keyed = keyed.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = saved(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1"), f"blocks-{depth}")
        met = saved(keyed.join(sizes, ["mask", "key"]).select("mask", "key", "fp", "n"), f"met-{depth}")
        last = depth == len(levels) - 1
        small = met if last else met.filter(F.col("n") <= group)
        parts.append(
            small.select("mask", "key", "fp")
            .repartition("mask", "key")
            .sortWithinPartitions("mask", "key")
            .mapInPandas(forest, schema)
        )
        if last:
            break
        large = met.filter(F.col("n") > group)
        finer = [(_signed(m), [_signed(x) for x in below]) for m, below in levels[depth + 1].items()]
        table = spark.createDataFrame([(m, x) for m, below in finer for x in below], "mask bigint, finer bigint")
        # the mask table is fixed: 20 masks and 20 finer ones each at the second level
        keyed = large.join(F.broadcast(table), "mask").select("fp", F.col("finer").alias("mask")).distinct()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def near_duplicates(
    docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, group: int = GROUP, text: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each input row.

    component_id is the smallest doc_id reachable over fingerprints at most
    ``max_bits`` apart. Texts without a word have fingerprint zero and link
    like any other. Rows with a null doc_id keep a null id and take part;
    a component without any id has a null component_id. An empty table gives
    an empty result. Columns other than doc_id and text are ignored.
    """
    fps = saved(fingerprints(docs, n, text), "simhash-fp")
    least = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    of = least.join(_components(least.select("fp"), max_bits, group), "fp")
    names = saved(of.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-names")
    named = saved(of.join(names, "component").select("fp", "component_id"), "simhash-named")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _components(distinct: DataFrame, max_bits: int, group: int) -> DataFrame:
    """(fp, component) of every fingerprint; one without a link is its own component."""
    comp = saved(graph.components(links(distinct, max_bits, group)), "simhash-components")
    of = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
    return saved(of.select("fp", F.coalesce("component", "fp").alias("component")), "simhash-component-of")


def keep_one(
    docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, group: int = GROUP, text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay when each group of near-duplicates keeps
    one: that with the smallest doc_id (null last), then the smallest hash of
    its text. Of equal rows (doc_id and text) any one stays."""
    body = text_of(text)
    key = [F.xxhash64(body).alias("_r"), F.xxhash64(F.col("doc_id").cast("bigint"), body).alias("_q")]

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *key, body.alias("text"))
    fps = saved(_add_fingerprints(rows, n), "simhash-rows")
    of = _components(fps.select("fp").distinct(), max_bits, group)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_r", "_q"))
    per_fp = saved(fps.groupBy("fp").agg(best.alias("best")), "simhash-best-of-fp")
    stays = per_fp.join(of, "fp").groupBy("component").agg(F.min("best").alias("best")).select("best._r", "best._q")
    kept = docs.select(whole_row(docs), *key).join(saved(stays, "simhash-stays"), ["_r", "_q"], "left_semi")
    return kept.dropDuplicates(["_r", "_q"]).select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_documents(spark, sf_dir))


QUERIES = {"op9_simhash": op9_simhash}
