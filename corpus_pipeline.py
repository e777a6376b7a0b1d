"""The corpus pipeline: every stage works on all that the stage before it kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave.llm import contamination, language, mix, neardup, spans
from costweave.llm.common import held_out, table
from costweave.session import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; a null text or one without letters goes.

    The language found replaces the one stated.
    """
    model = language.fit(docs.where(~held_out("doc_id", 3, 1)))
    found = language.predict(docs, model).where(F.col("lang_pred") != language.UNDETERMINED)
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near-duplicates."""
    return neardup.representatives(docs)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that an earlier document has; one that loses all its text goes."""
    cut = spans.dedup(docs)
    left = F.coalesce(F.length(F.trim("text")), F.lit(0)) > 0
    kept = cut.where((F.col("n_removed") == 0) | left)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the number of the ``copy``."""
    return mix.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_spans),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix_sources),
]

#: No SQL: the language model, signatures and content-defined spans have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
