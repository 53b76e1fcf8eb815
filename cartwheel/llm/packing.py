"""Best-fit packing with several capacities at once.

A bin has room for tokens, documents and attention cost (the sum of squared
piece lengths). A piece asks for (length, 1, length**2). Pieces go by falling
length into the open bin that the rule prefers among those with room under
every capacity: the smallest weighted residual norm after placing, or the
largest weighted dot product of demand and residual.

Pieces of one length are alike, so the decisions are made on the counts per
length: bins in the same state are one group with a count, and a step places
a run of equal pieces into a run of equal bins. The plan is as large as the
number of lengths (bounded by the capacity) and the same at every input
size; the result is that of the same best-fit run over all pieces one by
one. Pieces then find their place by their rank among those of their length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import read_documents, saved, text_of, tokenizer_path
from cartwheel.llm.tokens import Encoder

CAPACITY = 4096
END_ID = 1


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids, and the
    place among the pieces of its length that its task made (task, k)."""

    def run(batches):
        task = TaskContext.get().partitionId()
        encoder = Encoder.at(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        made = np.zeros(capacity + 1, np.int64)
        for pdf in batches:
            rows = []
            for doc_id, t in zip(pdf["doc_id"].astype("Int64"), pdf["text"]):
                data = encoder.encode(t) + end
                n = len(data) // 4
                for p, s in enumerate(range(0, n, capacity)):
                    part = data[4 * s : 4 * (s + capacity)]
                    size = len(part) // 4
                    rows.append((doc_id, p, s, size, zlib.crc32(part), task, made[size], part))
                    made[size] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "k", "ids"]).astype(
                {"doc_id": "Int64"}
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInPandas(
        run,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, k bigint, ids binary",
    )


def plan(
    counts: dict[int, int],
    tokens: int = CAPACITY,
    documents: int | None = None,
    cost: int | None = None,
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
) -> pd.DataFrame:
    """Where the pieces of each length go: rows (length, lo, hi, bin, per_bin,
    offset): the piece of rank r in [lo, hi) goes to bin + (r - lo) // per_bin
    at offset + ((r - lo) % per_bin) * length.

    ``documents`` and ``cost`` default to capacities that tokens alone imply.
    A piece that no empty bin can take raises.
    """
    cap = np.array([tokens, tokens if documents is None else documents, tokens**2 if cost is None else cost], np.int64)
    w = np.array(weights)
    room = np.zeros((0, 3), np.int64)  # residual per group of equal bins
    many = np.zeros(0, np.int64)
    first = np.zeros(0, np.int64)
    used = np.zeros(0, np.int64)
    bins, out = 0, []

    def put(length, lo, n, g):
        """Places n pieces into group g, as many to a bin as fit; returns how many went."""
        nonlocal room, many, first, used
        ask = np.array([length, 1, length * length], np.int64)
        fit = int((room[g] // ask).min())
        whole = min(int(many[g]), n // fit)
        if whole:
            # the first `whole` bins of the group get `fit` pieces each
            out.append((length, lo, lo + whole * fit, int(first[g]), fit, int(used[g])))
            if whole < many[g]:
                split(g, whole)
            room[g] -= fit * ask
            used[g] += fit * length
            return whole * fit
        if many[g] > 1:
            split(g, 1)
        out.append((length, lo, lo + n, int(first[g]), n, int(used[g])))
        room[g] -= n * ask
        used[g] += n * length
        return n

    def split(g, keep):
        """Bins of group g beyond the first ``keep`` become a group of their own."""
        nonlocal room, many, first, used
        room = np.vstack((room, room[g]))
        used = np.append(used, used[g])
        first = np.append(first, first[g] + keep)
        many = np.append(many, many[g] - keep)
        many[g] = keep

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        ask = np.array([length, 1, length * length], np.int64)
        if (ask > cap).any():
            raise ValueError(f"a piece of {length} tokens fits no bin")
        n, lo = counts[length], 0
        while n:
            ok = np.flatnonzero((room >= ask).all(axis=1))
            if len(ok):
                if rule == "dot":
                    score = -((room[ok] / cap) * (ask / cap) * w).sum(axis=1)
                else:
                    score = ((((room[ok] - ask) / cap) * w) ** 2).sum(axis=1)
                g = int(ok[np.argmin(score)])
            else:
                fit = int((cap // ask).min())
                new = -(-n // fit)
                room = np.vstack((room, cap))
                many, first, used = np.append(many, new), np.append(first, bins), np.append(used, 0)
                bins += new
                g = len(many) - 1
            went = put(length, lo, n, g)
            lo, n = lo + went, n - went
        live = (room >= 1).all(axis=1)
        room, many, first, used = room[live], many[live], first[live], used[live]
    return pd.DataFrame(out, columns=["length", "lo", "hi", "bin", "per_bin", "offset"], dtype=np.int64)


def pack(cut: DataFrame, capacity: int = CAPACITY, **limits) -> DataFrame:
    """``cut`` (a written table of :func:`pieces`) with sequence_id and offset."""
    spark = cut.sparkSession
    made = saved(cut.groupBy("length", "task").agg((F.max("k") + 1).alias("n")), "pack-counts")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = saved(made.select("length", "task", F.coalesce(before, F.lit(0)).alias("before")), "pack-starts")
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = plan(counts, capacity, **limits).sort_values(["length", "lo"])
    shared = spark.sparkContext.broadcast({c: table[c].to_numpy() for c in table})

    def place(batches):
        t = shared.value
        edge = t["length"] << 48 | t["lo"]
        for pdf in batches:
            rank = (pdf["before"] + pdf["k"]).to_numpy()
            length = pdf["length"].to_numpy()
            at = np.searchsorted(edge, length << 48 | rank, side="right") - 1
            turn = rank - t["lo"][at]
            pdf["sequence_id"] = t["bin"][at] + turn // t["per_bin"][at]
            pdf["offset"] = t["offset"][at] + turn % t["per_bin"][at] * length
            pdf["doc_id"] = pdf["doc_id"].astype("Int64")
            yield pdf[columns]

    kept = [c for c in cut.columns if c not in ("task", "k")]
    columns = [*kept, "sequence_id", "offset"]
    schema = ", ".join(f"`{c}` {cut.schema[c].dataType.simpleString()}" for c in kept)
    joined = cut.join(starts, ["length", "task"])
    return joined.mapInPandas(place, schema + ", sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids binary): the packed ids themselves. A
    sequence has at most ``capacity`` ids, so a group is bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), whole.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, **limits) -> DataFrame:
    """All documents packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty (its only token is the end id). Rows with a null or
    repeated doc_id are packed like any other. An empty table gives an empty
    result. Columns besides doc_id and text are ignored.
    """
    cut = saved(pieces(docs, tokenizer, capacity).drop("ids"), "pieces")
    return pack(cut, capacity, **limits)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


QUERIES = {"op3_packing": op3_packing}
