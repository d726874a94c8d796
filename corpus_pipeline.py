"""Corpus pipeline: quality rules, near copies, personal data, mixing to target weights, packing.

Every stage takes the rows that the one before has kept and reads them whole; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.shared import materialise, release
from loanloom.llm import mixing, pii, quality_rules, simhash
from loanloom.llm.common import table
from loanloom.llm.queries import MIX, packed


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts have no words and go; repeated rows pass or go together; an empty table stays empty.
    """
    return quality_rules.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, that of the smallest id.

    Null ids come last, and a group of nothing else keeps one row; of repeated rows one stays; null and empty texts
    are one group; an empty table stays empty.
    """
    return simhash.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, disguised or not, is replaced by its kind; ``n_chars`` follows.

    A null text stays null and has no number of characters; rows are masked one by one, repeated or without id; an
    empty table stays empty.
    """
    return pii.mask_pii(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or dropped if they are toxic, until domains have their target shares of tokens.

    Targets beyond reach give the nearest mix. Null and empty texts weigh nothing; equal rows are repeated alike;
    without any label rows stay as they are; an empty table stays empty.
    """
    return mixing.repeated(docs, mixing.label_domains(table(spark, sf_dir, "labels")), MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, one row per piece, with the piece's ids.

    A null or empty text is the end token alone; null ids and repeated rows are packed like others; an empty table
    has no pieces.
    """
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("near copies", drop_near_copies),
    ("personal data", mask_personal_data),
    ("mixing", mix),
    ("packing", pack),
]

#: Fingerprints, detectors and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each stored before the next reads it and released after."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        kept = materialise(stage(spark, docs, sf_dir))
        if k:
            release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
