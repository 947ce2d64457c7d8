"""A corpus pipeline from five of the operators in ``sparkmart.llm``.

Language ID, quality and near duplicates decide which documents stay, secrets are masked, and
what is left is packed into training sequences.  Every stage reads the table that its
predecessor wrote, and decides on its own input.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkmart.llm import jaccard, langid, packing, pu_quality, secrets  # noqa: E402
from sparkmart.llm.common import WORD, session, table, written  # noqa: E402
from sparkmart.llm.queries import byte_bpe_path  # noqa: E402

#: A text that has fewer than this share of its n-grams in the language predicted is in none that was learned,
#: unless the language's own texts have few there: then this share of their low score is the bound.
MIN_LANGUAGE_SCORE, MIN_OF_LOW = 0.3, 0.5


def _whole(docs: DataFrame, *needed: str | Column) -> DataFrame:
    """What an operator needs, and each document as one column, so that no name can clash."""
    return docs.select(F.struct(*docs.columns).alias("document"), *needed)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; null texts and texts without a letter go.

    Where no document has a language there is none to be in, and all go.
    """
    session(spark)
    model = langid.train(docs)
    found = langid.predict(_whole(docs, "text"), model)
    bounds = [F.lit(x) for name, low in langid.low_scores(docs, model).items() for x in (name, MIN_OF_LOW * low)]
    own = F.element_at(F.create_map(*bounds), F.col("lang_pred")) if bounds else F.lit(None)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= F.least(F.lit(MIN_LANGUAGE_SCORE), own)))
    return kept.select("document.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be of quality; all of them if there are no positives to learn from."""
    session(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = pu_quality.train(docs, labels)
    return pu_quality.classify(_whole(docs, "text"), model).where("predicted = 1").select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every component; documents without a word all stay.

    Ids that are null do not name a component and stay.  Of rows of a component that share its
    smallest id, the one with the least row key stays; of equal rows, the least in all columns.
    """
    session(spark)
    found = jaccard.linked_rows(docs).where("n_shingles > 0 and component_id = doc_id")
    keepers = written(found.groupBy("component").agg(F.min("key").alias("key")).select("key"), "keepers")
    judged = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = _whole(docs.where(judged), jaccard.row_key().alias("key")).join(keepers, "key")
    first = rows.groupBy("key").agg(F.min("document").alias("document")).select("document.*")
    return first.unionByName(docs.where(~judged))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars counted anew."""
    session(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    session(spark)
    return packing.pack_digests(docs, byte_bpe_path())


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mask_secrets", mask_secrets),
    ("pack", pack),
]

#: Training of two classifiers and a tokenizer are beyond SQL; the tests compare stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
