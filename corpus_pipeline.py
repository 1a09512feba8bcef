"""The corpus pipeline over ``documents``: five stages of the llm operators.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
as Parquet in the shared folder and read again as the next stage's ``docs``.
All but the last keep the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casetrail.llm.common import run_dir, store, table
from casetrail.llm.exact_dedup import drop_exact_copies
from casetrail.llm.mixing import mixed_documents
from casetrail.llm.ngram_join import drop_near_copies
from casetrail.llm.pieces import encode_pieces
from casetrail.llm.queries import _documents, vocabulary
from casetrail.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that are predicted toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of equal texts the one with the largest id stays."""
    return drop_exact_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each group of near copies the smallest id stays."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: rows as often as the mix takes them."""
    return mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one row per document of the mix, encoded and decoded."""
    return encode_pieces(docs, vocabulary("piece_bpe_32k.model"), with_ids=True)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("ngram_join", ngram_join), ("mixing", mixing),
          ("pieces", pieces)]

#: The first stage is a fitted classifier and the last a tokenizer: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    path = run_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), f"{path}/{k}-{name}")
    return docs
