"""Importance resampling towards a target distribution.

Texts are bags of word n-grams, hashed into buckets. A bucket's gain is the
log-ratio of its share in the target texts to its share in all documents; a
document's weight is the sum of the gains of its n-grams. Adding Gumbel noise
to the weights and taking the largest draws documents without replacement in
proportion to their importance.

The n-grams are made by Arrow kernels on whole batches: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` turn texts
into word indices; shifted against themselves, the indices form pairs and
triples. A CRC is taken once for each distinct word and each distinct pair of a
batch (a pair's from its words' CRCs, with arithmetic on whole arrays; triples
hardly repeat and are joined where they stand); ``take`` hands buckets and
gains to all places, and a segmented sum over a document's places is its weight.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import read_documents, saved, text_of
from cartwheel.llm.order import running_start

BUCKETS = 10_000
#: Words are what lies between these (after A-Z became a-z).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Texts of together this many bytes go through the kernels at once, and words
#: in runs of this many, so one very long text needs no more arrays than many short ones.
TEXT_BYTES = 4 << 20
RUN_WORDS = 1 << 20


def _through(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = table[0][x & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ table[k][(x >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _zero_tables() -> tuple[np.ndarray, np.ndarray]:
    """What zero bytes make of byte k of a CRC register, for each value of that
    byte: [n, k, value] for n < SHORT bytes, and [j, k, value] for 2**j bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1 == 1, step >> np.uint32(1) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    values = np.arange(256, dtype=np.uint32)
    none = np.stack([values << np.uint32(8 * k) for k in range(4)])
    one = np.stack([step, *none[:3]])
    short = [none]
    for _ in range(SHORT - 1):
        short.append(_through(one, short[-1]))
    powers = [one]
    for _ in range(31):
        powers.append(_through(powers[-1], powers[-1]))
    return np.stack(short), np.stack(powers)


SHORT = 64
_ZEROS, _POWERS = _zero_tables()


def joined_crc(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of texts joined: ``left`` and ``right`` are the parts' CRCs, ``length`` the right parts' bytes."""
    x = left.astype(np.uint32)
    flat, at = _ZEROS.ravel(), np.minimum(length, SHORT - 1) << 10
    out = flat[at + (x & 255)]
    for k in (1, 2, 3):
        out ^= flat[at + (256 * k) + ((x >> np.uint32(8 * k)) & 255)]
    long = np.flatnonzero(length >= SHORT)
    if len(long):
        x, n = x[long], length[long]
        for j in range(int(n.max()).bit_length()):
            odd = (n >> j) & 1 == 1
            x[odd] = _through(_POWERS[j], x[odd])
        out[long] = x
    return out ^ right


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and each word's text (by place)."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(pc.binary_length(flat), 0)
    return flat.filter(real), owner.filter(real).to_numpy(zero_copy_only=False)


def gram_buckets(words: pa.Array, owner: np.ndarray, buckets: int = BUCKETS):
    """For n = 1, 2, 3: the bucket of the n-gram that begins at each place, or
    ``buckets`` where the text ends before. Yields (first place, number of
    places, [bucket, ..]) in runs of RUN_WORDS."""
    for at in range(0, len(words), RUN_WORDS):
        run = words.slice(at, RUN_WORDS + 2).dictionary_encode()
        mine = owner[at : at + RUN_WORDS + 2]
        n = min(RUN_WORDS, len(words) - at)
        index = run.indices.to_numpy(zero_copy_only=False)
        texts = run.dictionary.cast(pa.binary()).to_pylist()
        crc = np.fromiter(map(zlib.crc32, texts), np.uint32, len(texts))
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        follow = joined_crc(np.full(len(texts), zlib.crc32(b" "), np.uint32), crc, length)
        length += 1
        # a pair's CRC once for each distinct pair, then back to all places
        pairs = pa.array(index[:-1].astype(np.int64) * len(texts) + index[1:]).dictionary_encode()
        left, right = np.divmod(pairs.dictionary.to_numpy(zero_copy_only=False), len(texts))
        two = joined_crc(crc[left], follow[right], length[right])[pairs.indices.to_numpy(zero_copy_only=False)]
        # triples hardly repeat: joined place by place from the pair and the third word
        last = index[2:]
        three = joined_crc(two[: len(last)], follow[last], length[last])
        out = [(crc % buckets).astype(np.int64)[index[:n]]]
        for order, grams in ((1, two), (2, three)):
            k = min(n, len(grams))
            bucket = np.full(n, buckets, np.int64)
            bucket[:k] = np.where(mine[:k] == mine[order : order + k], grams[:k] % np.uint32(buckets), buckets)
            out.append(bucket)
        yield at, n, out


def _pieces(batch: pa.RecordBatch, column: str):
    """Slices of the batch with at most TEXT_BYTES of text (a longer text alone)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(size):
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + TEXT_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many n-grams of all texts (column text) fall into each bucket that has any."""

    def run(batches):
        total = np.zeros(buckets + 1, np.int64)
        for batch in batches:
            for part in _pieces(batch, "text"):
                for _, _, grams in gram_buckets(*_words(part.column("text")), buckets):
                    for bucket in grams:
                        total += np.bincount(bucket, minlength=buckets + 1)
        some = np.flatnonzero(total[:buckets])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    rows = texts.select(text_of("text").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B)/((s+1)(T+B)))) for each of the B buckets; the
    counts of both sides are sums over every text, B rows a side reach the driver."""
    s, t = (np.zeros(buckets, np.int64) for _ in range(2))
    for table, side in ((documents, s), (target, t)):
        for r in bucket_counts(table, buckets).collect():
            side[r["bucket"]] = r["n"]
    all_s, all_t = int(s.sum()), int(t.sum())
    ratio = lambda i: float((int(t[i]) + 1) * (all_s + buckets)) / float((int(s[i]) + 1) * (all_t + buckets))
    return np.array([math.floor(1000 * math.log(ratio(i))) for i in range(buckets)], np.int64)


def gumbel(doc_id: str, seed: int = SEED) -> int:
    """floor(-1000 ln(-ln u)) for a number u in (0, 1) drawn from the id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(documents: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score for every row."""
    shared = documents.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    fields = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches):
        table = np.append(shared.value, 0)  # where there is no n-gram
        for batch in batches:
            for part in _pieces(batch, "text"):
                words, owner = _words(part.column("text"))
                count = np.bincount(owner, minlength=len(part)).astype(np.int64)
                weight = np.zeros(len(part), np.int64)
                for at, n, grams in gram_buckets(words, owner, len(table) - 1):
                    here = sum(np.take(table, bucket) for bucket in grams)
                    # places of one text are neighbours: a segment each
                    cuts = np.flatnonzero(np.diff(owner[at : at + n], prepend=-1))
                    weight[owner[at : at + n][cuts]] += np.add.reduceat(here, cuts)
                features = count + np.maximum(count - 1, 0) + np.maximum(count - 2, 0)
                ids = part.column("doc_id")
                noise = [gumbel("" if i is None else str(i), seed) for i in ids.to_pylist()]
                cols = [count, features, weight, weight + np.array(noise, np.int64)]
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.int64()) for c in cols]], fields)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{f} bigint" for f in fields))


def resample(
    documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``documents``.

    ``rank`` (1, 2, ..) is given to the floor(percent/100 N) rows of highest
    score among the N with at least ``least_words`` words, ties to the smaller
    doc_id (null first); the others have none. Null and empty texts have no
    feature and weight 0, and their noise alone as score. A null id draws its
    noise from the empty text. Repeated rows have equal scores and take
    neighbouring ranks. Without documents the result is empty; without target
    texts every bucket's gain falls with its count. Columns other than doc_id
    and text (of the target: text) are ignored.
    """
    scored = saved(weights(documents, gains(documents, target, buckets), seed), "resample-scored")
    eligible = scored.filter(F.col("n_words") >= least_words)
    drawn = eligible.count() * percent // 100
    marked = eligible.select(
        "doc_id", "n_features", "weight", "score", (-F.col("score")).alias("down"),
        F.monotonically_increasing_id().alias("tie"), F.lit(1).cast("bigint").alias("one"),
    )
    placed = running_start(marked, ["down", "doc_id", "tie"], "one", "before", "resample-order")
    rank = F.when(F.col("before") < drawn, F.col("before") + 1)
    out = ["doc_id", "n_features", "weight", "score"]
    rest = scored.filter(F.col("n_words") < least_words).select(*out, F.lit(None).cast("bigint").alias("rank"))
    return placed.select(*out, rank.cast("bigint").alias("rank")).unionByName(rest)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"))


QUERIES = {"op12_resampling": op12_resampling}

# CRC-32 is linear: the bytes' parts, by their distance from the end, and the
# part of the first register, by the length, are combined with xor.
ORACLE = {
    "op12_resampling": r"""
WITH RECURSIVE step AS MATERIALIZED (
  SELECT i AS b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i::BIGINT) AS v
  FROM range(256) r(i)
), word AS MATERIALIZED (
  SELECT src, nr, unnest(w) AS w, generate_subscripts(w, 1) AS place, len(w) AS n_words FROM (
    SELECT src, nr, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT 's' AS src, row_number() OVER () AS nr, text FROM documents
          UNION ALL SELECT 't', row_number() OVER (), text FROM benchmark))
), gram AS MATERIALIZED (
  SELECT src, nr, w AS f FROM word
  UNION ALL SELECT a.src, a.nr, a.w || ' ' || b.w FROM word a JOIN word b ON a.src = b.src AND a.nr = b.nr AND b.place = a.place + 1
  UNION ALL SELECT a.src, a.nr, a.w || ' ' || b.w || ' ' || c.w FROM word a JOIN word b ON a.src = b.src AND a.nr = b.nr AND b.place = a.place + 1
    JOIN word c ON a.src = c.src AND a.nr = c.nr AND c.place = a.place + 2
), feature AS MATERIALIZED (SELECT f, hex(encode(f)) AS x, strlen(f) AS n FROM (SELECT DISTINCT f FROM gram)),
longest AS MATERIALIZED (SELECT max(n) AS n FROM feature),
part(k, b, v) AS (
  SELECT 0, b, v FROM step
  UNION ALL
  SELECT p.k + 1, p.b, xor(s.v, p.v >> 8) FROM part p JOIN step s ON s.b = p.v & 255 WHERE p.k + 1 < (SELECT n FROM longest)
), first(n, v) AS (
  SELECT 0, 4294967295::BIGINT
  UNION ALL
  SELECT f.n + 1, xor(s.v, f.v >> 8) FROM first f JOIN step s ON s.b = f.v & 255 WHERE f.n < (SELECT n FROM longest)
), bucket AS MATERIALIZED (
  SELECT f.f, xor(xor(bit_xor(p.v), any_value(i.v)), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT f, n, unnest(range(n)) AS spot, x FROM feature) f
  JOIN part p ON p.k = f.n - 1 - f.spot AND p.b = (('0x' || substr(f.x, 2 * f.spot + 1, 2))::BIGINT)
  JOIN first i ON i.n = f.n GROUP BY f.f
), hit AS MATERIALIZED (SELECT src, nr, bucket, count(*) AS n FROM gram JOIN bucket USING (f) GROUP BY ALL),
side AS (
  SELECT r.bucket, coalesce(sum(n) FILTER (WHERE src = 's'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE src = 't'), 0)::DOUBLE AS t
  FROM range(10000) r(bucket) LEFT JOIN hit USING (bucket) GROUP BY r.bucket
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM side) + 10000) / ((s + 1) * ((SELECT sum(t) FROM side) + 10000)))) AS g FROM side
), total AS (SELECT nr, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM hit JOIN gain USING (bucket) WHERE src = 's' GROUP BY nr),
scored AS (
  SELECT d.doc_id, coalesce(t.n_features, 0) AS n_features, coalesce(t.weight, 0) AS weight,
    coalesce(t.weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(d.doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM (SELECT doc_id, row_number() OVER () AS nr FROM documents) d LEFT JOIN total t USING (nr)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS p, count(*) OVER () AS n
  FROM scored WHERE n_features >= 57
)
SELECT s.doc_id, s.n_features::BIGINT AS n_features, s.weight, s.score, CASE WHEN p.p <= 5 * p.n // 100 THEN p.p END AS rank
FROM scored s LEFT JOIN placed p USING (doc_id)
"""
}
