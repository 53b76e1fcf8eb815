"""Exact de-duplication by content-defined chunk recipes.

A normalised text is cut where its own bytes say so, which makes a recipe:
the ordered list of its chunks' fingerprints, and beside it the list of their
SHA-256 digests. Texts whose recipes occur once are unique. Where a recipe
occurs several times the digests decide: if they are the same everywhere, each
fingerprint stands for one chunk; if not, every distinct pair (fingerprint,
digest) of those recipes becomes a verified identifier, the fingerprint and a
variant number among the chunks that share it. Texts are equal when their
ordered identifier lists are. Only recipes and digests move, about a twentieth
of the text; the text itself is read once, where it lies.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import WHITE, read_documents, saved, text_of

#: Average chunk about 2**10 bytes, never above MAX_CHUNK.
CUT_BITS = 10
MIN_CHUNK = 256
MAX_CHUNK = 8192
#: Bytes of a fingerprint.
WIDTH = 16

_white = re.compile(WHITE)


def normalise(text: str | None) -> str:
    """Every run of ASCII white space becomes one space (null: empty)."""
    return _white.sub(" ", text or "")


def chunks(data: bytes, cut_bits: int = CUT_BITS, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> list[bytes]:
    """Content-defined chunks: a cut follows an 8-byte window whose mixed value
    has ``cut_bits`` zero bits on top. Chunks keep between ``least`` and
    ``most`` bytes (the last may be shorter); the empty text has none."""
    n = len(data)
    if n <= least:
        return [data] if n else []
    raw = np.frombuffer(data + b"\0" * 8, np.uint8)
    window = np.lib.stride_tricks.sliding_window_view(raw, 8)[: n - 7]
    mixed = np.ascontiguousarray(window).view("<u8").ravel() * np.uint64(0x9E3779B97F4A7C15)
    places = np.flatnonzero(mixed >> np.uint64(64 - cut_bits) == 0) + 8
    out, at = [], 0
    for p in [*places.tolist(), n]:
        while p - at > most:
            out.append(data[at : at + most])
            at += most
        if p - at >= least or (p == n and p > at):
            out.append(data[at:p])
            at = p
    return out


def _fingerprint(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=WIDTH).digest()


def recipes(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text_sha256, recipe, digests): the chunks' fingerprints (WIDTH
    bytes each) and SHA-256 digests (32 bytes each), joined in order."""

    def run(batches):
        for pdf in batches:
            data = [normalise(t).encode("utf-8", "surrogatepass") for t in pdf["text"]]
            cut = [chunks(d) for d in data]
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"].astype("Int64"),
                    "text_sha256": [hashlib.sha256(d).hexdigest() for d in data],
                    "recipe": [b"".join(map(_fingerprint, c)) for c in cut],
                    "digests": [b"".join(hashlib.sha256(x).digest() for x in c) for c in cut],
                }
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInPandas(run, "doc_id bigint, text_sha256 string, recipe binary, digests binary")


def _pairs(lists: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and (at, fp, digest) of every chunk in recipe and digests."""
    part = lambda c, i, n: F.substring(F.col(c), i * n + 1, F.lit(n))
    n = F.floor(F.octet_length("recipe") / WIDTH).cast("int")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    pairs = F.transform(places, lambda i: F.struct(i.alias("at"), part("recipe", i, WIDTH).alias("fp"), part("digests", i, 32).alias("digest")))
    return lists.select(*keep, F.explode(pairs).alias("c")).select(*keep, "c.*")


def verified_ids(lists: DataFrame) -> DataFrame:
    """(fp, digest, variant) of fingerprints that different chunks of ``lists``
    (recipe, digests) share; normally empty."""
    pairs = _pairs(lists.select("recipe", "digests").distinct()).select("fp", "digest").distinct()
    many = pairs.groupBy("fp").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low <> high")
    clash = pairs.join(many.select("fp"), "fp", "left_semi")
    return clash.select("fp", "digest", F.row_number().over(Window.partitionBy("fp").orderBy("digest")).alias("variant"))


def exact_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white-space normalisation; null is
    empty, so null and empty (but not blank) texts are equal. The smallest
    doc_id of a group stays. Among rows with the same smallest id (repeated
    rows) every one is marked kept, because nothing tells them apart. A null
    doc_id is larger than any other; a group without ids keeps its rows.
    Other columns are ignored; an empty table gives an empty result.
    """
    made = saved(recipes(docs, text), "recipes")
    groups = made.groupBy("recipe").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.min("digests").alias("low"), F.max("digests").alias("high")
    )
    mixed = (F.col("low") != F.col("high")).alias("mixed")  # equal recipes of different chunks
    groups = saved(groups.filter("group_size > 1").select("recipe", "keep_id", "group_size", mixed), "recipe-groups")
    clashes = groups.filter("mixed").select("recipe")
    if clashes.isEmpty():
        # every fingerprint stands for one chunk, so equal recipes are equal identifier lists
        identified, sized = made, groups
    else:
        clashes = saved(verified_ids(made.join(clashes, "recipe", "left_semi")), "chunk-clashes")
        identified = saved(_with_variants(made, clashes), "recipes-verified")
        sized = saved(
            identified.groupBy("recipe")
            .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            .filter("group_size > 1"),
            "recipe-groups-verified",
        )
    out = identified.join(sized.select("recipe", "keep_id", "group_size"), "recipe", "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def _with_variants(made: DataFrame, clashes: DataFrame) -> DataFrame:
    """Recipes of the texts that hold a clashing fingerprint, with the variant of each such chunk behind them."""
    texts = made.groupBy("text_sha256").agg(F.min(F.struct("recipe", "digests")).alias("r")).select("text_sha256", "r.*")
    marked = _pairs(texts, "text_sha256").join(clashes, ["fp", "digest"]).select("text_sha256", "at", "variant")
    lists = marked.groupBy("text_sha256").agg(F.array_sort(F.collect_list(F.struct("at", "variant"))).alias("v"))
    tail = F.coalesce(F.encode(F.to_json("v"), "utf-8"), F.lit(b""))
    return made.join(lists, "text_sha256", "left").select(
        "doc_id", "text_sha256", F.concat(F.col("recipe"), F.lit(b"\0" * WIDTH), tail).alias("recipe")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_documents(spark, sf_dir))


QUERIES = {"op8_exact_dedup": op8_exact_dedup}

ORACLE = {
    "op8_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)
"""
}
