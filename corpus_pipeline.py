"""From raw documents to token digests of a mixed training set.

``STAGES`` are applied in order; each gets the documents its predecessor kept,
written as parquet and read again. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm import gbdt, mixing, ngramjoin, toxicity
from txnlake.llm.common import stored, table
from txnlake.llm.queries import QUALITY_CUT, TOXIC_CUT, encoded_digests, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the cut."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score_column(F.col("text"), model) < TOXIC_CUT)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut."""
    trees = gbdt.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(gbdt.score_column(F.col("text"), trees) >= QUALITY_CUT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ngramjoin.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture draws it."""
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents left."""
    return encoded_digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# Models trained on the corpus are not expressible in SQL; tests hold the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
