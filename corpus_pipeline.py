"""A training corpus from raw documents: good, in a known language, without near copies, mixed and packed.

Every stage reads what the stage before has written and works on all of it. All
stages take texts whole, however long, give nothing for an empty table, keep
extra columns whatever their names, and depend on values only, never on the
order of rows; what they do with nulls and repeated rows is said of each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm import byte_cnn, jaccard_join, langid, mixing, packing
from tristrata.llm.queries import GOOD_FROM
from tristrata.llm.tables import held_out, ship, table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network, trained on the labels, finds good.

    A null text is judged as an empty one. Every row is judged by itself:
    repeated rows stay or go together, and a null id changes nothing.
    """
    labels = table(spark, sf_dir, "labels")
    model = byte_cnn.fit(docs, labels.where(~held_out(F.col("doc_id"))), "quality")
    return byte_cnn.where_good(docs, model, GOOD_FROM)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from the languages given.

    Null and empty texts and those without a letter go. Rows without a language
    are not learned from but judged like any other; repeated rows alike.
    """
    model = langid.fit(docs, ~held_out(F.col("doc_id")))
    return langid.where_known(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Texts without words are no copies of each other. Of rows with one id one
    stays; rows without an id can't be told apart and stay.
    """
    return jaccard_join.kept_documents(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them: each at least once, those of small sources up to twice.

    Null is a source like any other, a null text has no tokens and is used once,
    and repeated rows are used each.
    """
    return mixing.mix_sources(docs, keep=docs.columns).rows.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, every window in the proportions of the mix.

    Repeated rows are packed each; a null text is its end id alone, and null is
    a source like any other.
    """
    return packing.piece_digest(packing.pack(docs))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("language", known_language),
    ("near_copies", one_of_each_group),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# Trained models and a tokenizer decide: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
