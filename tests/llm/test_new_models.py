"""Operators 11 to 13: quality, importance resampling, Merkle manifest."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cartwheel.llm import merkle, quality, resampling
from cartwheel.llm.common import read_documents, remainder
from oracle_compare import compare, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- 11 quality


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op11_quality"](spark, sf)
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    labels = {r["doc_id"]: r["quality"] for r in read_documents(spark, sf, "labels").collect()}
    rows = got.collect()
    assert len(rows) == read_documents(spark, sf).count()
    held = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    right = [r["predicted"] == labels[r["doc_id"]] for r in held]
    assert len(held) > 50 and np.mean(right) > 0.97


def test_tables_add_up_and_pairs_are_found():
    """A label that depends on two features only together; the score is the sum of the tables."""
    rng = np.random.default_rng(3)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y, np.arange(4000) % 5 == 0)
    assert (0, 1) in model.pairs
    fresh = rng.random((500, x.shape[1]))
    want = (fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5)
    assert ((model.score(fresh) >= 0.5) == want).mean() > 0.95
    for row in fresh[:20]:
        b = [int((e <= v).sum()) for e, v in zip(model.edges, row)]
        total = model.intercept + sum(t[k] for t, k in zip(model.mains, b))
        total += sum(t[model.coarse[i][b[i]], model.coarse[j][b[j]]] for (i, j), t in zip(model.pairs, model.tables))
        assert model.log_odds(row[None])[0] == pytest.approx(total)


def test_tree_is_the_best_cut_by_trial():
    rng = np.random.default_rng(4)
    g, h, n = rng.normal(size=12), rng.random(12) + 0.1, np.full(12, 9)
    step = quality._tree(g, h, n, 2)

    def left(cut):
        value = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + quality.RIDGE)
        return value(0, cut) + value(cut, 12)

    cut = max(range(1, 12), key=left)
    want = np.zeros(12)
    for a, b in ((0, cut), (cut, 12)):
        want[a:b] = -g[a:b].sum() / (h[a:b].sum() + quality.RIDGE)
    assert np.allclose(step, want)


def test_quality_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(5, 20)] + [(5, None), (None, 1), (6, 1)], "doc_id bigint, quality int"
    )
    never = remainder("doc_id", 3) == 7
    got = quality.score_quality(awkward, labels, never)
    rows = got.collect()
    assert len(rows) == awkward.count()
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1  # null and empty alike
    assert len({r["score"] for r in rows if r["doc_id"] == 6}) == 1
    assert quality.score_quality(nothing, labels, never).count() == 0
    none = labels.filter("false")
    assert {r["score"] for r in quality.score_quality(awkward, none, never).collect()} == {0.5}
    assert quality.describe("") == quality.describe(None) and len(quality.describe("a b")) == len(quality.FEATURES)


def test_sample_is_bounded_and_repeated_ids_count_once(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('word ', id) as text")
    hot = spark.range(5000).selectExpr("cast(1 as bigint) as doc_id", "'word 1' as text")
    labels = spark.range(3000).selectExpr("id as doc_id", "cast(id % 2 as int) as label")
    seen = []
    real = quality.fit
    try:
        quality.fit = lambda x, y, aside: seen.append(len(y)) or real(x, y, aside)
        quality.learn(docs.union(hot), labels, remainder("doc_id", 3) == 1, limit=500)
    finally:
        quality.fit = real
    assert 350 < seen[0] < 650


# ---------------------------------------------------------------- 12 resampling


def grams(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_resample(rows, target, percent=5, least=20):
    bucket = lambda f: zlib.crc32(f.encode("utf-8", "surrogatepass")) % 10000
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, grams(text)[1]))
    for text in target:
        t.update(map(bucket, grams(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for i, text in rows:
        words, feats = grams(text)
        weight = sum(gain[bucket(f)] for f in feats)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    for r in out:
        r.append(None)
    for n, r in enumerate(drawn):
        r[5] = n + 1
    return [(r[0], r[1], r[2], r[3], r[5]) for r in out]


@pytest.mark.parametrize("run_words", [1, 2, 3, 7, 1 << 20])
def test_buckets_of_runs_are_those_of_whole_texts(monkeypatch, run_words):
    """Words in short runs, a word longer than the short table, empty texts between."""
    monkeypatch.setattr(resampling, "RUN_WORDS", run_words)
    texts = ["", "a", "A b", "x" * 300 + " y " + "é" * 70 + " z", " ...", "one two THREE four", "ß Ü 1a-b2", "", "a a a a"]
    words, owner = resampling._words(pa.array(texts))
    got = {i: [] for i in range(len(texts))}
    for at, n, runs in resampling.gram_buckets(words, owner):
        for bucket in runs:
            assert len(bucket) == n
            for j in np.flatnonzero(bucket < 10000):
                got[owner[at + j]].append(int(bucket[j]))
    for i, text in enumerate(texts):
        assert sorted(got[i]) == sorted(zlib.crc32(f.encode()) % 10000 for f in grams(text)[1])


def test_resample_awkward_equals_plain(spark, awkward, nothing):
    target = spark.createDataFrame([("stone river lamp",), (None,), ("",), ("seven paper",)], "text string")
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    for percent in (5, 40, 100):
        got = resampling.resample(awkward, target, percent=percent)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert [t for _, t in got.dtypes] == ["bigint"] * 5
        key = lambda r: tuple((x is None, x or 0) for x in r)
        want = plain_resample(rows, [r["text"] for r in target.collect()], percent)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert resampling.resample(nothing, target).count() == 0
    assert resampling.resample(awkward, nothing).count() == len(rows)


def test_resampling_and_manifest_match_their_oracles(spark):
    sf = "/root/testdata/sf0.001"
    con = duck(sf)
    for name in ("op12_resampling", "op13_merkle"):
        res = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], sf, con)
        assert res["status"] == "ok", res


# ---------------------------------------------------------------- 13 manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows, altered):
    """(doc_id, source, lang, n_chars, text) rows; levels as lists, proofs by walking them."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def up(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
        return levels

    def walk(levels, at, digest):
        proof = []
        for level in levels[:-1]:
            run = level[at // 2 * 2 : at // 2 * 2 + 2]
            proof += [d for k, d in enumerate(run) if k != at % 2]
            digest = sha(*[digest if k == at % 2 else d for k, d in enumerate(run)])
            at //= 2
        return proof, digest

    order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    trees = {}
    for r in rows:
        i, source, lang, n, text = r
        leaf = sha(*map(part, (i, source, lang, n, text)))
        start = sha(*map(part, (i, source, lang, n + 1, text))) if n is not None and altered(i) else leaf
        trees.setdefault(lang, []).append((i, leaf, start))
    names = sorted(trees, key=order)
    built = {}
    for name in names:
        trees[name].sort(key=lambda t: (order(t[0]), t[1]))
        built[name] = up([t[1] for t in trees[name]])
    crown = up([built[name][-1][0] for name in names])
    root = crown[-1][0] if names else None
    out = []
    for k, name in enumerate(names):
        for at, (i, leaf, start) in enumerate(trees[name]):
            proof, digest = walk(built[name], at, start)
            more, digest = walk(crown, k, digest)
            out.append((i, leaf, built[name][-1][0], root, sha(*proof, *more), digest, digest == root))
    return out


def seventh(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 0


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree string, pos string"


@pytest.mark.parametrize("stride", [1, 2, 8])
def test_manifest_equals_plain(spark, stride):
    """Trees of 1 to 37 leaves in 8 languages, null included; clashing columns; repeated rows."""
    rows = [(i, "s" if i % 3 else None, [None, "", "de", "en", "é", "z", "fr", "en"][i % 8], None if i % 5 == 0 else i, f"t{i}" if i % 4 else None) for i in range(150)]
    rows += [(None, None, None, None, None)] * 2 + [(7, "s", "en", 3, "x"), (1000, "s", "alone", 1, "x" * 100_000)]
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    got = merkle.manifest(docs, merkle.tampered(), stride)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_manifest(rows, seventh), key=key)


def test_manifest_small_tables(spark, nothing):
    one = spark.createDataFrame([(0, "s", "en", 4, "text")], "doc_id bigint, source string, lang string, n_chars int, text string")
    (row,) = merkle.manifest(one).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"]
    assert row["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    empty = merkle.manifest(nothing)
    assert empty.count() == 0 and empty.columns == list(merkle.manifest(one).columns)


def test_manifest_awkward(spark, awkward):
    got = merkle.manifest(awkward, merkle.tampered(), 2)
    cols = ["doc_id", "source", "lang", "n_chars", "text"]
    want = plain_manifest([tuple(r) for r in awkward.select(cols).collect()], seventh)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_no_key_serves_more_than_a_page_of_leaves(spark):
    """Upper nodes are stored once per bottom page: every step's join key meets at most 2**stride leaves."""
    docs = spark.range(300).selectExpr("id as doc_id", "'s' as source", "'en' as lang", "1 as n_chars", "'t' as text")
    leaves = docs.select("doc_id", "lang", F.unhex(merkle.leaf_digest()).alias("leaf"))
    placed = merkle._ranked(leaves)
    nodes = merkle.node_rows(placed, 2, reach=3)
    assert nodes.groupBy("tree", "page", "step").count().filter("count > 1").count() == 0
    assert nodes.filter("next_step IS NULL").count() == 75  # one way to the root for each bottom page
    # 300 leaves: 9 levels of pairs, of which 2 in the bottom page and 3 in each later step
    assert {r["count"] for r in nodes.groupBy("page").count().collect()} == {4}
    assert nodes.filter("size(way) > 3").count() == 0
