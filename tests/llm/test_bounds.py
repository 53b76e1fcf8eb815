"""Operators 2 and 5, pipeline: what is evaluated once and what a worker holds at once."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql.types import StringType, StructField, StructType

from cartwheel.llm import decontaminate, lang_id


def test_every_step_over_a_text_is_evaluated_once(spark, monkeypatch):
    plans = {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return df

    monkeypatch.setattr(decontaminate, "saved", kept)
    docs = spark.createDataFrame([(1, "Anna sold 48 clips in the market")], "doc_id bigint, text string")
    hashes = spark.createDataFrame([(1,)], "h bigint")
    decontaminate._hits(docs, hashes, 5, "text")
    plan = plans["bench-hits"]
    assert (plan.count("regexp_replace("), plan.count("split(")) == (5, 2)


class _Frame:
    """As much of a DataFrame as predict uses; keeps the function it maps."""

    schema = StructType([StructField("text", StringType())])
    columns = ["text"]
    sparkSession = property(lambda self: self)
    sparkContext = property(lambda self: self)

    def broadcast(self, value):
        return type("Shared", (), {"value": value})

    def drop(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_a_batch_is_scored_in_groups_of_words(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(10)) for _ in range(60)]
    sizes = []

    def score(vocab, group, model):
        sizes.append(len(group))
        return np.array([[float(w < "d"), float(w > "d")] for w in group])

    monkeypatch.setattr(lang_id, "vocabulary", lambda path: None)
    monkeypatch.setattr(lang_id, "score_words", score)

    def predicted():
        run = lang_id.predict(_Frame(), ["x", "y"], np.zeros((1, 2)), "none")
        batches = [pa.RecordBatch.from_arrays([pa.array([*texts[lo : lo + 30], None, "12"])], names=["text"]) for lo in (0, 30)]
        return [(r["lang_pred"], r["score"]) for b in run(iter(batches)) for r in b.to_pylist()]

    whole = predicted()
    assert whole[30:32] == [("und", 0.0)] * 2 and len(whole) == 64
    sizes.clear()
    monkeypatch.setattr(lang_id, "AHEAD", 50, raising=False)
    monkeypatch.setattr(lang_id, "KEPT_WORDS", 70)
    assert predicted() == whole
    assert max(sizes) <= 60
