"""The pipeline against a plain version of its decisions, and the registered oracle queries."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest

import corpus_pipeline
from cartwheel.llm import registry
from cartwheel.llm.common import read_documents

from .conftest import awkward_rows
from .test_dedup import _cut_lines, _plain_fingerprint, _roots

SF = "/root/testdata/sf0.001"


def _stages(spark, docs, sf_dir, tmp_path):
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        out.append(docs)
    return out


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    return _stages(spark, read_documents(spark, SF), SF, tmp_path_factory.mktemp("stages"))


def _words(t):
    return re.findall(r"\w+", t.lower())


def test_stage_by_stage(spark, built):
    docs = read_documents(spark, SF)
    language, lines, near, clean, packed = built
    for df in (language, lines, near, clean):
        assert df.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {i: t for i, t in rows.items() if t and any(c.isalpha() for c in t)}
    assert {r["doc_id"]: r["text"] for r in language.collect()} == kept
    cut = {i: k for i, _, _, _, k in _cut_lines(sorted(kept.items()))}
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.collect()}
    assert got == {i: (t, len(t)) for i, t in cut.items()}
    fps = {i: _plain_fingerprint(t) for i, t in cut.items()}
    root = _roots(list(fps.values()), 3)
    least = defaultdict(list)
    for i, f in fps.items():
        least[root[f]].append(i)
    one = {min(g) for g in least.values()}
    assert {r["doc_id"] for r in near.collect()} == one
    bench = [_words(r["text"]) for r in read_documents(spark, SF, "benchmark").collect()]

    def leaks(t):
        w = _words(t)
        have = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        return any(sum(tuple(b[k : k + 5]) in have for k in range(len(b) - 4)) >= 0.5 * (len(b) - 4) for b in bench)

    assert {r["doc_id"] for r in clean.collect()} == {i for i in one if not leaks(cut[i])}
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in clean.collect()}


def test_awkward_rows_go_through(spark, awkward, nothing, tmp_path):
    last = _stages(spark, awkward, SF, tmp_path)
    gone = {r["doc_id"] for r in last[0].collect()} ^ {r[0] for r in awkward_rows()}
    assert gone == {1, 2, 3, 19}
    assert last[3].columns == awkward.columns
    assert _stages(spark, nothing, SF, tmp_path / "none")[-1].collect() == []


def test_run_equals_the_stages(spark, built):
    want = built[-1]
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, want.collect()))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracles(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = want.fetchall()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(rows, key=key)
