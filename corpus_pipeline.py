"""Training-data pipeline over ``documents``: what is toxic, repeated or leaked goes, the rest is packed.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns
a DataFrame that is written as Parquet and read again as the next one's ``docs``.  All but
the last return the columns of ``documents``.

In every stage any column may be NULL, texts may be empty or of any length, an empty table
gives an empty one, and further columns are passed through whatever they are called (the last
stage has columns of its own and ignores them).  What NULLs, ties and repeated rows do is said
at each stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemart.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity  # noqa: E402
from tidemart.llm.frames import finished, materialise, read  # noqa: E402, F401 (stages run one by one)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among ``docs``, does not reject.

    A NULL text has the score of an empty one; a NULL id is scored like any other and never
    learned from; repeated rows have one score and stay or go together; a score on the
    threshold is rejected.
    """
    return toxicity.remove(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of which an occurrence stays elsewhere; n_chars follows the text.

    The first occurrence stays: that of the smallest id (NULL before all), then of the first
    line.  A NULL text and its n_chars are left alone; rows that repeat id and text are one
    document and lose the same lines; different texts under one id are documents of their own.
    """
    cleaned = line_dedup.clean(docs, exact_words=1)
    if "n_chars" in cleaned.columns:
        kind = cleaned.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                                     .otherwise(F.char_length("text").cast(kind)))
    return cleaned


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates.

    A NULL id comes before all others; of rows that repeat id and text one stays; texts that
    are NULL or without words are linked with nothing and stay.
    """
    return jaccard_join.keep_first(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    A NULL text or an empty one has no passage and stays, an item without words has none to
    find; repeated rows stay or go together; ids are not looked at.
    """
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their text, in token-budget batches of optimal length buckets.

    A text without words, or NULL, is one piece without tokens and in no bucket; repeated rows
    and rows of a NULL id are packed each; pieces of one length are dealt by a hash of id and piece.
    """
    return packing.pack(docs, with_text=True)


STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_near),
    ("benchmark decontamination", remove_leaks),
    ("packing", pack_batches),
]

#: SQL cannot express the stages: a trained classifier, SimHash candidates, dynamic programming
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; its intermediates go then."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = finished(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
