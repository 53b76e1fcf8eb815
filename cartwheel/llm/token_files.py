"""Token ids in patched frame-of-reference files.

A file holds the ids of consecutive documents. Ids are cut into blocks of
``BLOCK``; a block stores its minimum, the differences to it packed at a
width that fits a chosen share of them, and the differences that need more
bits as exceptions (place, high bits). Layout, little-endian:

    magic "PFORIDS1"
    blocks: minimum u32 | width u8 | exceptions u16 | packed bits
            | places u16 * n | values u32 * n
    footer: doc_id i64 * docs | known u8 * docs (0: null id) | length u64 * docs
            | block start u64 * (blocks + 1)
    tail:   docs u64 | ids u64 | block size u32 | footer start u64 | magic

The block starts make any range of ids readable without the ones before it.
Writer and reader work in frames of ``FRAME`` ids, so memory does not grow
with the file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import read_documents, text_of, tokenizer_path
from cartwheel.llm.tokens import Encoder
from cartwheel.session import scratch_path

MAGIC = b"PFORIDS1"
BLOCK = 512
FRAME = BLOCK * 512
PERCENTILE = 90
END_ID = 2
_TAIL = struct.Struct("<QQIQ8s")
_HEAD = struct.Struct("<IBH")


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64) + 1, 0)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE, block: int = BLOCK) -> list[bytes]:
    """The blocks of ``ids`` (u32), the last one padded with its minimum."""
    n = len(ids)
    if not n:
        return []
    nb = -(-n // block)
    full = np.full(nb * block, ids[-block * (n // block == nb) or -(n % block) :].min(), np.uint32)
    full[:n] = ids
    full = full.reshape(nb, block)
    least = full.min(axis=1)
    diff = (full - least[:, None]).astype(np.uint64)
    need = _bit_length(diff)
    width = np.sort(need, axis=1)[:, min(block - 1, int(np.ceil(block * percentile / 100)) - 1)]
    out: list[bytes] = [b""] * nb
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        low = (diff[rows] & np.uint64((1 << int(w)) - 1)).astype("<u4")
        bits = np.unpackbits(low.view(np.uint8).reshape(len(rows), block, 4), axis=2, bitorder="little", count=int(w))
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        over = need[rows] > w
        which, at = np.nonzero(over)
        high = (diff[rows[which], at] >> np.uint64(w)).astype("<u4")
        at = at.astype("<u2")
        ends = np.cumsum(over.sum(axis=1))
        start = 0
        for i, (r, end) in enumerate(zip(rows.tolist(), ends.tolist())):
            head = _HEAD.pack(int(least[r]), int(w), end - start)
            out[r] = head + packed[i].tobytes() + at[start:end].tobytes() + high[start:end].tobytes()
            start = end
    return out


def decode_blocks(data: bytes, starts: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Ids of whole blocks; ``starts`` are their places in ``data`` and its end."""
    nb = len(starts) - 1
    raw = np.frombuffer(data, np.uint8)
    at = starts[:-1].astype(np.int64)
    least = raw[at[:, None] + np.arange(4)].copy().view("<u4").ravel()
    width = raw[at + 4].astype(np.int64)
    n_over = raw[at[:, None] + np.arange(5, 7)].copy().view("<u2").ravel().astype(np.int64)
    out = np.zeros((nb, block), np.uint64)
    body = at + _HEAD.size
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        size = -(-block * int(w) // 8)
        bits = np.unpackbits(raw[body[rows][:, None] + np.arange(size)], axis=1, bitorder="little", count=block * int(w))
        whole = np.zeros((len(rows), block, 32), np.uint8)
        whole[:, :, : int(w)] = bits.reshape(len(rows), block, int(w))
        out[rows] = np.packbits(whole, axis=2, bitorder="little").view("<u4")[:, :, 0]
    for r in np.flatnonzero(n_over):
        p = int(body[r]) + -(-block * int(width[r]) // 8)
        k = int(n_over[r])
        place = np.frombuffer(data, "<u2", k, p)
        high = np.frombuffer(data, "<u4", k, p + 2 * k).astype(np.uint64)
        out[r, place] |= high << np.uint64(width[r])
    return (out + least[:, None].astype(np.uint64)).astype(np.uint32).ravel()


def _fs(uri: str):
    """File system and path of a URI or a plain local path."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def write_file(uri: str, docs: Iterator[tuple[int | None, bytes]], percentile: float = PERCENTILE) -> int:
    """Writes (doc_id, packed ids) in order; returns the number of ids. The
    file appears under its name only when it is whole, so a repeated task
    replaces it with the same content."""
    fs, path = _fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    doc_ids, lengths, starts = [], [], []
    held, held_n, total, place = [], 0, 0, len(MAGIC)
    with fs.open_output_stream(part) as f:
        f.write(MAGIC)

        def flush(last: bool) -> None:
            nonlocal held, held_n, place
            ids = np.frombuffer(b"".join(held), "<u4")
            cut = len(ids) if last else len(ids) // FRAME * FRAME
            for s in range(0, cut, FRAME):
                blocks = encode_blocks(ids[s : min(cut, s + FRAME)], percentile)
                sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
                starts.append(place + np.concatenate(([0], np.cumsum(sizes)[:-1])))
                place += int(sizes.sum())
                f.write(b"".join(blocks))
            held, held_n = [ids[cut:].tobytes()], len(ids) - cut

        for doc_id, data in docs:
            doc_ids.append(doc_id)
            lengths.append(len(data) // 4)
            held.append(data)
            held_n += len(data) // 4
            total += len(data) // 4
            if held_n >= FRAME:
                flush(False)
        flush(True)
        f.write(np.array([x or 0 for x in doc_ids], "<i8").tobytes())
        f.write(np.array([x is not None for x in doc_ids], "u1").tobytes())
        f.write(np.array(lengths, "<u8").tobytes())
        f.write(np.concatenate([*starts, [place]]).astype("<u8").tobytes())
        f.write(_TAIL.pack(len(doc_ids), total, BLOCK, place, MAGIC))
    fs.move(part, path)
    return total


class TokenFile:
    """Reads a file's index at once and its ids on demand."""

    def __init__(self, uri: str):
        fs, path = _fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, self.total, self.block, foot, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        data = self.file.read_at(size - _TAIL.size - foot, foot)
        self.doc_ids = np.frombuffer(data, "<i8", n)
        self.known = np.frombuffer(data, "u1", n, 8 * n)
        self.lengths = np.frombuffer(data, "<u8", n, 9 * n).astype(np.int64)
        self.starts = np.frombuffer(data, "<u8", offset=17 * n).astype(np.int64)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop), from their blocks alone."""
        stop = min(stop, self.total)
        if stop <= start:
            return np.zeros(0, np.uint32)
        b0, b1 = start // self.block, -(-stop // self.block)
        s = self.starts[b0 : b1 + 1]
        ids = decode_blocks(self.file.read_at(int(s[-1] - s[0]), int(s[0])), s - s[0], self.block)
        return ids[start - b0 * self.block : stop - b0 * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) in file order, a frame of ids in memory at a time."""
        at, frame, base = 0, np.zeros(0, np.uint32), 0
        for doc_id, known, n in zip(self.doc_ids.tolist(), self.known.tolist(), self.lengths.tolist()):
            if at + n > base + len(frame):
                more = self.read(base + len(frame), max(at + n, base + len(frame) + FRAME))
                frame, base = np.concatenate((frame[at - base :], more)), at
            yield (doc_id if known else None), at, frame[at - base : at - base + n]
            at += n


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = END_ID,
    percentile: float = PERCENTILE,
    text: str = "text",
) -> list[tuple[int, str, int]]:
    """Encodes every whole text and writes one file per range of doc_id.

    Returns the manifest (shard, file, ids), one row per file, in ascending
    doc_id order. Rows with the same doc_id are ordered by the text's hash,
    then the text, and may fall into different files; null ids come first,
    a null text has only the end id.
    """

    def run(batches):
        shard = TaskContext.get().partitionId()
        encoder = Encoder.at(tokenizer)
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        name = f"{folder}/ids-{shard:06d}.pfor"
        rows = (
            (None if pd.isna(i) else int(i), encoder.encode(t) + end)
            for pdf in batches
            for i, t in zip(pdf["doc_id"].astype("Int64"), pdf["text"])
        )
        n = write_file(name, rows, percentile)
        yield pd.DataFrame({"shard": [shard], "file": [name], "ids": [n]})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ranged = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    manifest = ranged.select("doc_id", "text").mapInPandas(run, "shard int, file string, ids bigint").collect()
    return sorted((r["shard"], r["file"], r["ids"]) for r in manifest)


def read_tokens(spark: SparkSession, manifest: list[tuple[int, str, int]], with_ids: bool = True) -> DataFrame:
    """Documents of the files: doc_id, start (ids before it in all files),
    n_tokens, ids_crc32 and, if asked for, the ids. One task per file."""
    base, rows = 0, []
    for shard, file, n in manifest:
        rows.append((shard, file, base))
        base += n

    def run(batches):
        for pdf in batches:
            for file, first in zip(pdf["file"], pdf["base"]):
                out = []
                for doc_id, at, ids in TokenFile(file).documents():
                    raw = ids.astype("<u4").tobytes()
                    out.append((doc_id, int(first) + at, len(ids), zlib.crc32(raw), ids.tolist() if with_ids else None))
                    if len(out) >= 2000:
                        yield frame(out)
                        out = []
                if out:
                    yield frame(out)

    def frame(out):
        pdf = pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
        pdf["doc_id"] = pdf["doc_id"].astype("Int64")
        return pdf if with_ids else pdf.drop(columns="ids")

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    files = spark.createDataFrame(rows, "shard int, file string, base bigint")
    return files.repartitionByRange(max(1, len(rows)), "shard").select("file", "base").mapInPandas(run, schema)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "llm", "token-files")
    manifest = write_tokens(read_documents(spark, sf_dir), folder, tokenizer_path("word_bpe_49k.json"))
    return read_tokens(spark, manifest, with_ids=False)


QUERIES = {"op4_token_files": op4_token_files}
