"""Corpus pipeline: quality rules, toxicity, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; the first three
return the columns of documents, the last one the packed pieces. ``run`` writes every stage's result as
Parquet in the shared folder and reads it again, so a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm.common import crc_bucket, written
from lakeweave.llm.near_dups import keep_one
from lakeweave.llm.packing import best_fit_pack
from lakeweave.llm.quality_rules import keep_good
from lakeweave.llm.queries import table, tokenizer_path
from lakeweave.llm.toxicity import drop_toxic, fit

#: The toxicity classifier has no SQL form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labels outside fold 0, doesn't find toxic."""
    model = fit(spark, docs, table(spark, sf_dir, "labels"), crc_bucket(F.col("doc_id"), 5) != 0)
    return drop_toxic(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.80), the one with the smallest doc_id."""
    return keep_one(spark, docs, low=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    return best_fit_pack(spark, docs, tokenizer_path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [("quality rules", quality), ("toxicity", clean), ("near duplicates", distinct), ("best-fit packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
