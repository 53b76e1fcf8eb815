"""Repeated byte strings by suffix sorting.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
anywhere else in the corpus. Such strings are found with suffix arrays and
their common-prefix values (:mod:`cartwheel.llm.induced`), shard by shard.

Which strings share a shard is decided by content: of the ``GRAM``-byte
strings inside a window of LENGTH bytes the one with the smallest hash (the
last of equal ones) is the window's anchor, so equal windows have equal
anchors and meet. Neighbouring windows with one anchor are a stretch. Anchors
that occur once are dropped before any text moves; the stretches of the
others (each different content once) are dealt out by anchor, and a shard
sorts the suffixes of its stretches. A window whose suffix shares LENGTH bytes
with a neighbour in the suffix array is repeated. An anchor with very many
different stretches is dealt out again by finer content: windows at nearly
the same distance from the anchor share all but a few of their bytes, and
those shared bytes decide the shard.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import read_documents, saved, text_of
from cartwheel.llm.induced import BLOCK, Files, suffix_array

LENGTH = 400
GRAM = 128
#: Bytes hashed at a time; longer texts are cut with an overlap of LENGTH.
CHUNK = 1 << 20
#: Different stretches of one anchor above which they are dealt out by finer content.
HOT = 1000
#: Windows with one shard then differ in their distance from the anchor by less than this.
FINE = 16

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two, 8 at least) from each place on."""
    n = len(data)
    raw = data + b"\0" * (8 + 7 - n % 8)
    h = np.empty((n // 8 + 1) * 8, np.uint64)
    for o in range(8):
        h[o::8] = np.frombuffer(raw, "<u8", n // 8 + 1, 0 if o == 0 else 0) if o == 0 else np.frombuffer(
            (raw + b"\0" * 8)[o : o + (n // 8 + 1) * 8], "<u8"
        )
    h = h[:n] * _ODD[0]
    h ^= h >> np.uint64(29)
    size, k = 8, 1
    while size < gram:
        nxt = h * _ODD[k % len(_ODD)]
        nxt[:-size] += h[size:] if size < n else 0
        nxt ^= nxt >> np.uint64(31)
        h, size, k = nxt, 2 * size, k + 1
    return h


def stretches(pieces: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(piece, s0, s1, anchor, o) arrays: the windows s0..s1 of a piece have one
    anchor, o bytes behind s0."""
    data = b"".join(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    first = np.cumsum(sizes) - sizes
    n, wide = len(data), length - gram + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 5
    h = _gram_hashes(data, gram)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    padded = np.full(-(-n // wide) * wide + wide, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = key
    rows = padded.reshape(-1, wide)
    up = np.minimum.accumulate(rows, axis=1).ravel()
    down = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    step = np.zeros(n + 1, np.int8)
    has = sizes >= length
    step[first[has]] += 1
    step[(first + sizes)[has] - length + 1] -= 1
    s = np.flatnonzero(np.cumsum(step[:n]))
    if not len(s):
        return (np.zeros(0, np.int64),) * 5
    least = np.minimum(down[s], up[s + wide - 1])
    anchor = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
    piece = np.searchsorted(first, s, side="right") - 1
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(s) != 1) | (np.diff(piece) != 0)) + 1
    lo, hi = np.concatenate(([0], cut)), np.concatenate((cut, [len(s)])) - 1
    owner = piece[lo]
    return owner, s[lo] - first[owner], s[hi] - first[owner], h[anchor[lo]].view(np.int64), anchor[lo] - s[lo]


def _cut(data: bytes, length: int):
    """(offset, piece): pieces of a text such that each window lies whole in one."""
    for at in range(0, max(len(data) - length + 1, 0), CHUNK):
        yield at, data[at : at + CHUNK + length - 1]


def _rows(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("suffix"), text).alias("k2"), text.cast("binary").alias("t")]


def anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text") -> DataFrame:
    """(k1, k2, anchor, s0, s1, o) of every stretch of every text."""

    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in range(2))
            held, where, size = [], [], 0
            for i, t in enumerate(batch.column(2)):
                for at, piece in _cut(t.as_py(), length):
                    held.append(piece)
                    where.append((i, at))
                    size += len(piece)
                    if size >= CHUNK:
                        yield out(k1, k2, held, where)
                        held, where, size = [], [], 0
            if held:
                yield out(k1, k2, held, where)

    def out(k1, k2, held, where):
        row, at = np.array(where, np.int64).T
        owner, s0, s1, anchor, o = stretches(held, length, gram)
        columns = (k1[row[owner]], k2[row[owner]], anchor, s0 + at[owner], s1 + at[owner], o)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["k1", "k2", "anchor", "s0", "s1", "o"])

    rows = docs.select(*_rows(text_of(text))).filter(F.octet_length("t") >= length)
    return rows.mapInArrow(run, "k1 bigint, k2 bigint, anchor bigint, s0 bigint, s1 bigint, o bigint")


def repeated_windows(contents: list[bytes], folder: str, length: int = LENGTH, buffer: int | None = None):
    """(i, a, b): windows a..b of content i whose ``length`` bytes also start
    elsewhere in the shard. Empties ``contents`` once they are in the shard's file."""
    files = Files(folder) if buffer is None else Files(folder, buffer)
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    first = np.cumsum(sizes + 1) - sizes - 1
    n = int(sizes.sum()) + len(sizes)
    used = np.zeros(256, bool)
    for c in contents:
        used[np.frombuffer(c, np.uint8)] = True
    k = int(used.sum()) + 1  # 0 separates contents
    symbol = np.cumsum(used)
    s = files.array(n, np.uint8 if k <= 256 else np.uint16)
    for c, at in zip(contents, first.tolist()):
        s[at : at + len(c)] = symbol[np.frombuffer(c, np.uint8)]
    contents.clear()
    order, prefix = suffix_array(s, k, files)
    repeated = files.array(n, bool)
    for lo in range(0, n, BLOCK):
        long = np.asarray(prefix[lo : lo + BLOCK + 1]) >= length
        mine = long[: min(BLOCK, n - lo)].copy()
        mine[: len(long) - 1] |= long[1:]
        repeated[np.asarray(order[lo : lo + BLOCK])[mine]] = True
    p = np.flatnonzero(repeated)
    owner = np.searchsorted(first, p, side="right") - 1
    rel = p - first[owner]
    ok = rel <= sizes[owner] - length
    owner, rel = owner[ok], rel[ok]
    if not len(rel):
        return owner, rel, rel
    cut = np.flatnonzero((np.diff(rel) != 1) | (np.diff(owner) != 0)) + 1
    lo, hi = np.concatenate(([0], cut)), np.concatenate((cut, [len(rel)])) - 1
    return owner[lo], rel[lo], rel[hi]


def _marked_texts(docs: DataFrame, length: int, gram: int, text: str) -> DataFrame:
    """(k1, k2, t, marks): each different text with repeated anchors, once, and those stretches."""
    every = saved(anchors(docs, length, gram, text), "suffix-anchors")
    place = F.xxhash64("k1", "k2", "s0")
    # two occurrences at least; copies of one text are one occurrence
    twice = every.groupBy("anchor").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b")
    twice = saved(twice.select("anchor"), "suffix-repeated")
    marks = every.join(twice, "anchor", "left_semi").distinct()
    marks = saved(marks.groupBy("k1", "k2").agg(F.collect_list(F.struct("s0", "s1", "anchor", "o")).alias("marks")), "suffix-marks")
    # one row stands for all copies of a text, so copies of a hot text do not meet in one task
    ids = docs.select(F.col("doc_id").cast("string").alias("d"), *_rows(text_of(text)))
    some = F.coalesce(F.col("d"), F.lit("")).alias("d")
    stands = ids.select("k1", "k2", some).groupBy("k1", "k2").agg(F.min("d").alias("d"))
    wanted = saved(marks.join(stands, ["k1", "k2"]), "suffix-wanted")
    rows = ids.select("k1", "k2", some, "t")
    return rows.join(wanted, ["k1", "k2", "d"]).dropDuplicates(["k1", "k2", "d"]).select("k1", "k2", "t", "marks")


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text"):
    """(texts, ranges): the texts that take part (k1, k2, t), each once, and
    (k1, k2, a, b): their windows a..b that also start elsewhere in another
    text or elsewhere in the same one."""
    marked = saved(_marked_texts(docs, length, gram, text), "suffix-texts")

    def cut(batches):
        seen: set[bytes] = set()
        for pdf in batches:
            out = []
            for k1, k2, t, marks in zip(pdf["k1"], pdf["k2"], pdf["t"], pdf["marks"]):
                for m in marks:
                    content = t[m["s0"] : m["s1"] + length]
                    out.append((k1, k2, m["s0"], m["s1"], m["o"], m["anchor"], *_named(content, seen)))
                if len(out) > 4000:
                    yield pd.DataFrame(out, columns=["k1", "k2", *_PART])
                    out = []
            yield pd.DataFrame(out, columns=["k1", "k2", *_PART])

    parts = saved(marked.mapInPandas(cut, f"k1 bigint, k2 bigint, {_PART_SCHEMA}"), "suffix-stretches")
    return marked.select("k1", "k2", "t"), _repeated(parts, ["k1", "k2"], length)


_PART = ["s0", "s1", "o", "shard", "name", "content"]
_PART_SCHEMA = "s0 bigint, s1 bigint, o bigint, shard bigint, name binary, content binary"


def _named(content: bytes, seen: set[bytes]) -> tuple[bytes, bytes | None]:
    """The content's digest, and the content itself the first time the task meets it."""
    name = hashlib.blake2b(content, digest_size=16).digest()
    if name in seen:
        return name, None
    if len(seen) > 1_000_000:  # only saves repeats within a task
        seen.clear()
    seen.add(name)
    return name, content


def _repeated(parts: DataFrame, owner: list[str], length: int, fine: bool = False) -> DataFrame:
    """(owner.., a, b): the windows of ``parts`` (owner.., s0, s1, o, shard,
    name, content) that also start elsewhere among them."""
    spark = parts.sparkSession
    tag = "fine" if fine else "all"
    refs = parts.select(*owner, "s0", "s1", "name")
    # contents that occur twice are repeated from end to end
    many = saved(refs.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name"), f"suffix-many-{tag}")
    contents = parts.filter("content IS NOT NULL").select("shard", "name", "o", "content").dropDuplicates(["shard", "name"])

    def sort(batches):
        names, held = [], []
        for pdf in batches:
            names += pdf["name"].tolist()
            held += pdf["content"].tolist()
        if not names:
            return
        with tempfile.TemporaryDirectory() as folder:
            i, a, b = repeated_windows(held, folder, length)
        for lo in range(0, len(i), 50_000):
            part = slice(lo, lo + 50_000)
            yield pd.DataFrame({"name": [names[x] for x in i[part]], "a": a[part], "b": b[part]})

    found = []
    if not fine:
        per_shard = parts.select("shard", "name").distinct().groupBy("shard").agg(F.count("*").alias("n"))
        hot = saved(per_shard.filter(F.col("n") > HOT).select("shard"), "suffix-hot")
        if not hot.isEmpty():
            again = contents.join(hot, "shard", "left_semi").mapInPandas(
                lambda batches: _finer(batches, length), f"parent binary, {_PART_SCHEMA}"
            )
            inner = _repeated(saved(again, "suffix-fine"), ["parent"], length, fine=True)
            found.append(inner.withColumnRenamed("parent", "name"))
            contents = contents.join(hot, "shard", "left_anti")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = contents.repartition(width, "shard").select("name", "content")
    found.append(dealt.mapInPandas(sort, "name binary, a bigint, b bigint"))
    inside = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    inside = saved(inside, f"suffix-inside-{tag}")
    whole = refs.join(many, "name", "left_semi").select(*owner, F.col("s0").alias("a"), F.col("s1").alias("b"))
    a, b = (F.col("s0") + F.col("a")).alias("a"), (F.col("s0") + F.col("b")).alias("b")
    return whole.unionByName(refs.join(inside, "name").select(*owner, a, b))


def _finer(batches, length: int):
    """Stretches cut into runs of windows by distance from the anchor; what all
    windows at such distances share decides the shard."""
    seen: set[bytes] = set()
    for pdf in batches:
        out = []
        for name, o, content in zip(pdf["name"], pdf["o"], pdf["content"]):
            last = len(content) - length
            for j in range((o - last) // FINE, o // FINE + 1):
                lo, hi = max(0, o - FINE * j - FINE + 1), min(last, o - FINE * j)
                if lo > hi:
                    continue
                core = content[o - FINE * j : o - FINE * j - FINE + 1 + length]
                shard = int.from_bytes(hashlib.blake2b(core, digest_size=8).digest(), "little", signed=True)
                out.append((name, lo, hi, o - lo, shard, *_named(content[lo : hi + length], seen)))
            if len(out) > 4000:
                yield pd.DataFrame(out, columns=["parent", *_PART])
                out = []
        yield pd.DataFrame(out, columns=["parent", *_PART])


def _kept(t: bytes, ranges, length: int):
    """(kept bytes, bytes removed, spans) after the windows of ``ranges`` are removed."""
    out, at, removed, spans, end = [], 0, 0, 0, -1
    for a, b in sorted((r["a"], r["b"] + length) for r in ranges):
        if a > end:
            spans += 1
        if b > at:
            lo = max(a, at)
            out.append(t[at:lo])
            removed += b - lo
            at = b
        end = max(end, b)
    out.append(t[at:])
    return b"".join(out), removed, spans


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    and, if asked for, kept (the remaining bytes).

    Every byte of the UTF-8 text that a repeated string of ``length`` bytes
    covers is removed, first occurrences too; texts of repeated rows repeat
    each other. Null and empty texts have no byte and stay as they are; other
    columns are ignored; an empty table gives an empty result.
    """
    texts, ranges = repeated_ranges(docs, length, gram, text)
    per = saved(ranges.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("ranges")), "suffix-ranges")

    def keep(batches):
        for pdf in batches:
            made = [_kept(t, r, length) for t, r in zip(pdf["t"], pdf["ranges"])]
            yield pd.DataFrame(
                {
                    "k1": pdf["k1"],
                    "k2": pdf["k2"],
                    "n_removed": [m[1] for m in made],
                    "n_spans": [m[2] for m in made],
                    "sha": [hashlib.sha256(m[0]).hexdigest() for m in made],
                    "kept": [m[0] if with_text else None for m in made],
                }
            )

    cut = texts.join(per, ["k1", "k2"]).mapInPandas(
        keep, "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, sha string, kept binary"
    )
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *_rows(text_of(text)))
    meta = base.select("doc_id", "k1", "k2", F.octet_length("t").cast("bigint").alias("n_bytes"), F.sha2("t", 256).alias("own"), *["t"] * with_text)
    copies = meta.groupBy("k1", "k2").agg(F.count("*").alias("copies")).filter("copies > 1")
    # one small table of what happens to which text: copies go whole, others lose their ranges
    gone = saved(copies, "suffix-copies")
    done = saved(cut, "suffix-kept")
    out = meta.join(gone, ["k1", "k2"], "left").join(done, ["k1", "k2"], "left")
    copied = F.col("copies").isNotNull() & (F.col("n_bytes") >= length)
    empty = hashlib.sha256(b"").hexdigest()
    columns = [
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copied, empty).otherwise(F.coalesce("sha", "own")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(copied, F.lit(b"")).otherwise(F.coalesce("kept", "t")).alias("kept"))
    return out.select(*columns)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_documents(spark, sf_dir))


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
