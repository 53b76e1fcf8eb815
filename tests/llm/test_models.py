"""Operators 2 and 7: the models against plain arithmetic, accuracy on held-out rows, awkward rows."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import lang_id, toxicity
from cartwheel.llm.common import read_documents, remainder, tokenizer_path

from .conftest import awkward_rows

PIECES = tokenizer_path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"


def _sum_of_segmentations(word, prob):
    alpha = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        alpha[j] = alpha[j - 1] * lang_id.UNSEEN
        for i in range(max(0, j - 16), j):
            alpha[j] += alpha[i] * prob.get(word[i:j], 0.0)
    return alpha[-1]


def test_word_scores_sum_all_segmentations():
    v = lang_id.vocabulary(PIECES)
    rng = np.random.default_rng(1)
    model = rng.random((len(v.pieces), 2)) * 1e-3
    words = ["a", "the", "rivière", "zzzzqqq", "überß", "漢字", "x" * 64, "therethere"]
    got = lang_id.score_words(v, words, model)
    for k in range(2):
        prob = dict(zip(v.pieces, model[:, k]))
        for w, g in zip(words, got[:, k]):
            assert math.isclose(g, math.log(_sum_of_segmentations("▁" + w, prob)), rel_tol=1e-9)


def test_expected_counts_sum_to_the_letters():
    """Each word's expected pieces cover its letters (almost no mass is on unseen letters)."""
    v = lang_id.vocabulary(PIECES)
    model = np.full((len(v.pieces), 1), 1 / len(v.pieces))
    total = lang_id._expected(v, ["river", "stones"], np.zeros(2, int), np.array([3.0, 2.0]), model)
    covered = sum(len(p) * total[i, 0] for i, p in enumerate(v.pieces))
    assert math.isclose(covered, 3 * 6 + 2 * 7, rel_tol=1e-3)


def test_language_held_out_accuracy(spark):
    docs = read_documents(spark, SF).select("doc_id", "text", "lang")
    out = lang_id.identify(docs, remainder("doc_id", 4) == 2, PIECES)
    r = out.join(docs, "doc_id").filter("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()
    assert r[0] > 0.97
    held = {x["doc_id"]: x["held_out"] for x in out.collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in held.items())


def test_language_awkward_rows(awkward, nothing):
    got = lang_id.identify(awkward, F.lit(False), PIECES).collect()
    assert len(got) == len(awkward_rows())
    for r in got:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "und")
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[1] == by[2] == by[3] == by[19] == "und" and by[5] != "und"
    assert lang_id.identify(nothing, F.lit(False), PIECES).collect() == []
    unlearned = lang_id.identify(awkward, F.lit(True), PIECES).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlearned} == {("und", 0.0)}


def test_predict_keeps_columns(awkward):
    langs, model = lang_id.fit(awkward, PIECES)
    out = lang_id.predict(awkward, langs, model, PIECES)
    assert out.columns == [c for c in awkward.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    assert out.count() == awkward.count()


def test_buckets_agree_between_spark_and_python(spark):
    units = ["a", "rivière", "", "漢字"]
    df = spark.createDataFrame([(u,) for u in units], "u string").select("u", toxicity._bucket_column(4, F.col("u")).alias("b"))
    assert {r["u"]: r["b"] for r in df.collect()} == {u: toxicity._bucket(4, u) for u in units}


@pytest.fixture(scope="module")
def planted(spark):
    """Ordinary texts, a third of them with one of a few rude words, inflected; one text is copied often."""
    rng = np.random.default_rng(3)
    plain = ["".join(rng.choice(list("aeioubcdlmnrst"), 6)) for _ in range(400)]
    rows = []
    for i in range(900):
        w = list(rng.choice(plain, 40))
        bad = i % 3 == 0
        if bad:
            for _ in range(2):
                w[rng.integers(40)] = rng.choice(["grumwald", "snorkity", "blixen"]) + rng.choice(["", "er", "ish", "ad", "oo"])
        rows.append((i, " ".join(w), int(bad)))
    rows += [(1000 + i, rows[1][1], 0) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")


def test_toxic_held_out_accuracy(planted):
    docs, labels = planted.select("doc_id", "text"), planted.select("doc_id", "toxic")
    fold = remainder("doc_id", 5)
    out = toxicity.score_toxicity(docs, labels, fold == 0, fold == 1).join(labels, "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in out)


def test_labels_of_held_out_rows_are_not_used(planted):
    docs, labels = planted.select("doc_id", "text"), planted.select("doc_id", "toxic")
    fold = remainder("doc_id", 5)
    turned = labels.withColumn("toxic", F.when(fold == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (
        {r["doc_id"]: round(r["score"], 9) for r in toxicity.score_toxicity(docs, x, fold == 0, fold == 1).collect()}
        for x in (labels, turned)
    )
    assert a == b


def test_toxic_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1), (5, None), (5, 0), (None, 1), (12, 1), (12, 0), (15, 0)], "doc_id bigint, toxic int")
    out = toxicity.score_toxicity(awkward, labels, F.lit(False), remainder("doc_id", 2) == 0).collect()
    assert len(out) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score_toxicity(nothing, labels, F.lit(False), F.lit(True)).collect() == []
    none = toxicity.score_toxicity(awkward, labels.limit(0), F.lit(False), F.lit(True)).collect()
    assert {r["predicted"] for r in none} == {0}


def test_signs_that_are_no_letters_have_no_language(spark):
    """Number signs are word characters but not letters: a text of them alone is ``und``."""
    assert lang_id.words("²½ Ⅷ ① ٣") == [] and lang_id.words("x² Aⅷb naïve ß") == ["x", "a", "b", "naïve", "ß"]
