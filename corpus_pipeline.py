"""A training corpus from ``documents``: five stages, each on all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of docs:

1. language     documents without a letter, or without a likely language, go
2. line_dedup   later copies of repeated line runs are cut from the texts
3. near_dedup   one document of each SimHash group stays
4. decontaminate  documents that contain a benchmark item go
5. pack         the documents are packed into sequences of 4096 tokens
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, lang_id, line_dedup, packing, simhash
from cartwheel.llm.common import read_documents, saved, ship, tokenizer_path

#: A document whose best language has a smaller posterior than this is rejected.
LEAST_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID learned from all labelled texts; keeps what has a language."""
    ship(spark)
    pieces = tokenizer_path("piece_bpe_32k.model")
    langs, model = lang_id.fit(docs.select("text", "lang"), pieces)
    said = lang_id.predict(docs, langs, model, pieces)
    likely = (F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    # without any labelled text nothing can be said and only texts without letters are rejected
    kept = said.filter(likely if langs else F.col("text").rlike(r"\p{L}"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: texts lose the later copies of repeated line runs."""
    ship(spark)
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the smallest doc_id of each group stays."""
    ship(spark)
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold an item go."""
    return decontaminate.drop_contaminated(docs, read_documents(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("line_dedup", lines),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("pack", pack),
]

#: Fitted models and a tokenizer are part of the result, so it is tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written once and read back."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
