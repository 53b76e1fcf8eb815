"""Operators 3 and 4: exact ids, exact round trips, packing rules."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cartwheel.llm import packing, token_files
from cartwheel.llm.common import tokenizer_path
from cartwheel.llm.tokens import Encoder

from .conftest import awkward_rows

PATH = tokenizer_path("word_bpe_49k.json")
ROWS = [(r[0], r[1] or "") for r in awkward_rows()]


@pytest.fixture(scope="module")
def ids():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_encoder_equals_library(ids):
    rng = random.Random(2)
    signs = "abZ'sStmdrevl 019²½ª÷×é É\n\t.,!<|_­¡İ—"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    encoder = Encoder(PATH)
    for t in texts + [t for _, t in ROWS]:
        assert encoder.encode(t) == np.array(ids(t), "<u4").tobytes(), t


@pytest.mark.parametrize("percentile", [0, 50, 90, 100])
def test_blocks_round_trip(percentile):
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        x = rng.choice([3, 70, 900, 2**32 - 1, 2**31], n, p=[0.5, 0.3, 0.1, 0.05, 0.05]).astype(np.uint32)
        for data in (x, np.full(n, 7, np.uint32), np.arange(n, dtype=np.uint32)):
            blocks = token_files.encode_blocks(data, percentile)
            starts = np.concatenate(([0], np.cumsum([len(b) for b in blocks]))).astype(np.int64)
            back = token_files.decode_blocks(b"".join(blocks), starts) if blocks else np.zeros(0, np.uint32)
            assert (back[:n] == data).all()


def test_file_ranges(tmp_path):
    rng = np.random.default_rng(2)
    docs = [(i if i % 3 else None, rng.integers(0, 50_000, rng.integers(0, 4000)).astype("<u4")) for i in range(200)]
    path = str(tmp_path / "deep" / "x.pfor")
    assert token_files.write_file(path, ((i, x.tobytes()) for i, x in docs)) == sum(len(x) for _, x in docs)
    f = token_files.TokenFile(path)
    whole = np.concatenate([x for _, x in docs])
    for a, b in ((0, 10), (511, 513), (5000, 90_000), (len(whole) - 3, len(whole) + 9), (7, 7)):
        assert (f.read(a, b) == whole[a:b]).all()
    assert [(i, n.tolist()) for i, _, n in f.documents()] == [(i, x.tolist()) for i, x in docs]
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["x.pfor"]


def test_token_files_round_trip(spark, awkward, ids, tmp_path):
    manifest = token_files.write_tokens(awkward, str(tmp_path / "ids"), PATH)
    out = token_files.read_tokens(spark, manifest).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, tuple(r["ids"])) for r in out) == sorted(
        (i is not None, i or 0, (*ids(t), 2)) for i, t in ROWS
    )
    out.sort(key=lambda r: r["start"])
    at = 0
    for r in out:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    known = [r["doc_id"] for r in out if r["doc_id"] is not None]
    assert known == sorted(known) and out[0]["doc_id"] is None


def test_packing_rules(awkward, ids):
    out = packing.pack_documents(awkward, PATH, 64).collect()
    seen = defaultdict(list)
    for r in out:
        seen[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seen.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    want = defaultdict(int)
    for i, t in ROWS:
        x = [*ids(t), 1]
        for p, s in enumerate(range(0, len(x), 64)):
            part = np.array(x[s : s + 64], "<u4")
            want[(i, p, s, len(part), zlib.crc32(part.tobytes()))] += 1
    got = defaultdict(int)
    for r in out:
        got[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
    assert got == want


def test_sequences_hold_the_ids(awkward, ids):
    cut = packing.saved(packing.pieces(awkward, PATH, 64), "test-pieces")
    packed = packing.pack(cut, 64)
    rows = packed.collect()
    for r in packing.sequences(packed).collect():
        whole = bytes(r["ids"])
        assert len(whole) == 4 * r["n_tokens"]
        for p in rows:
            if p["sequence_id"] == r["sequence_id"]:
                part = whole[4 * p["offset"] : 4 * (p["offset"] + p["length"])]
                assert zlib.crc32(part) == p["ids_crc32"]


def _one_by_one(lengths, caps, rule, weights):
    """The same best-fit over single pieces; returns the bins' contents as sorted lengths."""
    bins, cap, w = [], np.array(caps), np.array(weights)
    for n in sorted(lengths, reverse=True):
        ask = np.array([n, 1, n * n])
        fits = [b for b in bins if (b[0] >= ask).all()]
        if not fits:
            fits = [[cap.copy(), []]]
            bins += fits
        if rule == "dot":
            best = max(fits, key=lambda b: round(float(((b[0] / cap) * (ask / cap) * w).sum()), 12))
        else:
            best = min(fits, key=lambda b: round(float(((((b[0] - ask) / cap) * w) ** 2).sum()), 12))
        best[0] -= ask
        best[1].append(n)
    return bins


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(50, 50, 2500), (50, 3, 2500), (50, 50, 900), (50, 4, 1200)])
def test_plan_keeps_every_capacity(rule, caps):
    rng = random.Random(4)
    lengths = [rng.choice([1, 2, 3, 7, 11, 13, 20, 24, 29, 30]) for _ in range(500)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    weights = (1.0, 0.3, 0.2)
    table = packing.plan(counts, caps[0], caps[1], caps[2], rule, weights)
    bins = defaultdict(list)
    placed = defaultdict(int)
    for r in table.itertuples():
        for k in range(r.lo, r.hi):
            turn = k - r.lo
            bins[r.bin + turn // r.per_bin].append((r.offset + turn % r.per_bin * r.length, r.length))
            placed[r.length] += 1
    assert placed == counts
    for parts in bins.values():
        sizes = [n for _, n in parts]
        assert sum(sizes) <= caps[0] and len(sizes) <= caps[1] and sum(n * n for n in sizes) <= caps[2]
        assert sorted(parts) == [(sum(x for _, x in sorted(parts)[:k]), n) for k, (_, n) in enumerate(sorted(parts))]
    if rule == "norm":
        assert len(bins) <= 1.05 * len(_one_by_one(lengths, caps, rule, weights)) + 1


def test_plan_rejects_what_fits_nowhere():
    with pytest.raises(ValueError):
        packing.plan({30: 1}, 50, 10, 100)


def test_empty_tables(spark, nothing, tmp_path):
    assert packing.pack_documents(nothing, PATH).collect() == []
    manifest = token_files.write_tokens(nothing, str(tmp_path / "none"), PATH)
    assert token_files.read_tokens(spark, manifest).collect() == []
