"""A training-corpus pipeline: five stages over ``documents``.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. All but the
last return the columns of ``documents``; each works on all that its
predecessor kept, written as Parquet in between.

Cases, for every stage: an empty table gives an empty one; other columns pass unchanged, whatever
their names; null ids are documents like others; repeated rows of one document meet the same fate, but
for the join, of which one row stays. Null and empty texts have no words and are rejected by the
first stage; a stage that gets them all the same: line dedup drops them, the join keeps them apart,
the mask leaves them, and the packing packs an empty document as its end token alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow.llm import jaccard_join, line_dedup, packing, quality, secret_scan
from recoflow.llm.common import materialize, ship
from recoflow.llm.queries import BYTE_VOCABULARY


WORD = r"[^\x20\x09-\x0D]"


def _count_chars(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_documents(docs, quality.fit(docs, labels))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go from the texts, long lines alone too; documents without a word left go."""
    left = line_dedup.drop_repeated_lines(docs, words=line_dedup.LONG)
    return _count_chars(left.where(F.col("text").rlike(WORD)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship(spark)
    return jaccard_join.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    return _count_chars(secret_scan.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in the training sequences."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path(BYTE_VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: The models of the first stage and the packing of the last are beyond SQL; tests/llm checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
