"""Operators 1, 6, 8 and 9 against plain versions on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from cartwheel.llm import exact_dedup, graph, induced, line_dedup, simhash, suffix_dedup

from .conftest import awkward_rows

ROWS = [(r[0], r[1] or "") for r in awkward_rows()]


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


# operator 1


def _naive_suffixes(s):
    order = sorted(range(len(s)), key=lambda i: s[i:])
    prefix = [0] * len(s)
    for r in range(1, len(s)):
        a, b = s[order[r - 1] :], s[order[r] :]
        while prefix[r] < min(len(a), len(b)) and a[prefix[r]] == b[prefix[r]]:
            prefix[r] += 1
    return order, prefix


@pytest.mark.parametrize("small", [False, True])
def test_suffix_array_and_prefixes(tmp_path, monkeypatch, small):
    if small:  # blocks of three tuples, few queues, everything in files
        monkeypatch.setattr(induced, "BLOCK", 3)
        monkeypatch.setattr(induced, "MOST_QUEUES", 2)
    files = induced.Files(str(tmp_path), 0 if small else 1 << 20)
    rng = random.Random(3)
    for _ in range(400):
        k = rng.choice([1, 2, 3, 5])
        s = [rng.randrange(k) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.3:
            s = s + s + s[:4]
        order, prefix = induced.suffix_array(np.array(s, np.uint8), k, files)
        want = _naive_suffixes(s)
        assert (list(map(int, order)), list(map(int, prefix))) == want, s


def _repeats(rows, length):
    seen = Counter(t[s : s + length] for _, t in rows for s in range(len(t) - length + 1))
    out = []
    for i, t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return _sorted(out)


def test_repeated_strings_match_plain_search(awkward):
    got = _sorted(tuple(r) for r in suffix_dedup.remove_repeats(awkward).collect())
    assert got == _repeats([(i, t.encode()) for i, t in ROWS], 400)


def test_hot_anchors_are_dealt_again(spark, monkeypatch):
    """One passage in many different surroundings, with the finer dealing forced on every anchor."""
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    rng = random.Random(9)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = some(430)
    rows = [(i, some(rng.randint(0, 500)) + passage[rng.randint(0, 40) :] + some(rng.randint(0, 500))) for i in range(40)]
    rows += [(50, passage[:399]), (51, passage * 3)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert _sorted(tuple(r) for r in got.collect()) == _repeats([(i, t.encode()) for i, t in rows], 400)


def test_repeated_strings_kept_text(awkward):
    out = suffix_dedup.remove_repeats(awkward, with_text=True).select("kept", "kept_sha256").collect()
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in out)


def test_stretches_cover_each_window_once(monkeypatch):
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (0, 399, 400, 401, 2500, 700)]
    owner, s0, s1, _, _ = suffix_dedup.stretches(texts)
    got = Counter((int(o), s) for o, a, b in zip(owner, s0, s1) for s in range(a, b + 1))
    assert got == Counter((i, s) for i, t in enumerate(texts) for s in range(len(t) - 399))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 100)
    assert sum(len(p) - 399 for _, p in suffix_dedup._cut(texts[4], 400)) == 2500 - 399


# operator 8


def test_exact_groups(awkward):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t)) for i, t in ROWS]
    ids = defaultdict(list)
    for i, t in norm:
        ids[t].append(i)
    want = []
    for i, t in norm:
        known = [x for x in ids[t] if x is not None]
        keep = min(known) if known else None
        want.append((i, keep, len(ids[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert _sorted(tuple(r) for r in exact_dedup.exact_duplicates(awkward).collect()) == _sorted(want)


def test_chunks_are_content_defined():
    rng = random.Random(5)
    data = bytes(rng.randrange(97, 123) for _ in range(40_000))
    cut = exact_dedup.chunks(data)
    assert b"".join(cut) == data and max(map(len, cut)) <= exact_dedup.MAX_CHUNK
    shifted = exact_dedup.chunks(b"x" * 77 + data)
    assert len(set(cut) & set(shifted)) > len(cut) // 2
    assert exact_dedup.chunks(b"") == [] and exact_dedup.chunks(b"z" * 20_000)[0] == b"z" * exact_dedup.MAX_CHUNK


def test_fingerprint_clashes_do_not_merge_texts(spark, monkeypatch):
    """With a fingerprint that knows only the length, contents still decide."""
    monkeypatch.setattr(exact_dedup, "_fingerprint", lambda c: len(c).to_bytes(16, "big"))
    rows = [(1, "abc"), (2, "abd"), (3, "abc"), (4, "ab d"), (5, "ab  d")]
    out = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["keep_id"] for r in out} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 4}


# operator 9


def _plain_fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
    shingles = ([" ".join(w)] if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]) if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _roots(fps, bits):
    nodes = sorted(set(fps))
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(nodes):
        for y in nodes[:i]:
            if (x ^ y).bit_count() <= bits:
                root[max(find(x), find(y))] = min(find(x), find(y))
    return {x: find(x) for x in nodes}


def test_simhash_components(awkward):
    fps = [(i, _plain_fingerprint(t)) for i, t in ROWS]
    root = _roots([f for _, f in fps], 3)
    least = defaultdict(lambda: None)
    for i, f in fps:
        if i is not None and (least[root[f]] is None or i < least[root[f]]):
            least[root[f]] = i
    want = _sorted((i, format(f, "016x"), least[root[f]]) for i, f in fps)
    assert _sorted(tuple(r) for r in simhash.near_duplicates(awkward).collect()) == want


def test_links_lose_nothing_when_every_group_is_cut_again(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(4)]
    fps = set(base)
    for b in base:  # dense neighbourhoods and chains
        for _ in range(60):
            for _ in range(rng.randint(1, 5)):
                b ^= 1 << rng.randrange(64)
            fps.add(b)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint"), group=2).collect()
    assert all(((e["a"] ^ e["b"]) & (1 << 64) - 1).bit_count() <= 3 for e in edges)
    comp = graph.components(spark.createDataFrame([tuple(e) for e in edges], "a bigint, b bigint")).collect()
    of = {r["node"] & (1 << 64) - 1: r["component"] for r in comp}
    want = defaultdict(set)
    for x, r in _roots(fps, 3).items():
        want[r].add(x)
    got = defaultdict(set)
    for x in fps:
        got[of.get(x, ("alone", x))].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200)]
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: 0 for i in range(61)} | {200: 200, 201: 200}


def test_keep_one_keeps_columns(awkward):
    out = simhash.keep_one(awkward)
    assert out.columns == awkward.columns
    comps = {r["component_id"] for r in simhash.near_duplicates(awkward).collect()}
    assert sorted(r["doc_id"] is None or r["doc_id"] for r in out.collect()) == sorted(c is None or c for c in comps)


# operator 6


def _cut_lines(rows, least=5):
    """Plain version on rows in order: windows of up to ``least`` lines with ``least`` words."""
    seen, out = set(), []
    for i, t in rows:
        lines, gone = t.split("\n"), set()
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines]
        for s in range(len(lines)):
            for m in range(1, min(least, len(lines) - s) + 1):
                if sum(words[s : s + m]) >= least:
                    key = tuple(lines[s : s + m])
                    if key in seen:
                        gone.update(range(s, s + m))
                    seen.add(key)
        kept = "\n".join(x for p, x in enumerate(lines) if p not in gone)
        out.append((i, len(lines), len(gone), sum(p - 1 not in gone for p in gone), kept))
    return out


def test_line_runs(awkward):
    got = line_dedup.dedup_lines(awkward)
    assert got.columns == [*awkward.columns, "n_lines", "n_removed", "n_runs"]
    rows = [(r["doc_id"], r["n_lines"], r["n_removed"], r["n_runs"], r["text"] or "") for r in got.collect()]
    ordered = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    assert _sorted(rows) == _sorted(_cut_lines(ordered))


def test_short_lines_count_as_runs(spark):
    rows = [(1, "a b\nc\nd e\nx"), (2, "q\na b\nc\nd e\nz"), (3, "a b\nc\nno"), (4, "c\nc\nc\nc\nc\nc\nc")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {i: k for i, _, _, _, k in _cut_lines(rows)}


@pytest.mark.parametrize(
    "operator",
    [suffix_dedup.remove_repeats, exact_dedup.exact_duplicates, simhash.near_duplicates, simhash.keep_one, line_dedup.dedup_lines],
)
def test_empty_table(nothing, operator):
    assert operator(nothing).collect() == []
