"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage gets what its predecessor kept, written as Parquet and read again, and all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm.best_fit import pack_documents
from ledgerlift.llm.common import written
from ledgerlift.llm.jaccard_join import keep_one
from ledgerlift.llm.line_spread import remove_boilerplate
from ledgerlift.llm.quality_model import fit_model, score_documents
from ledgerlift.llm.quality_rules import quality_rules as judged_by_rules
from ledgerlift.llm.registry import WORD_BPE, quality_labels, table

#: Documents of a lower score are rejected.
LEAST_SCORE = 0.3
#: Words that a worker keeps encoded. Fewer than the packing alone would: Python workers stay while
#: other stages need the memory.
KEPT_WORDS = 100_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and both histograms accept."""
    return judged_by_rules(docs).where("kept").select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels at hand does not score low."""
    model = fit_model(docs, quality_labels(spark, sf_dir))
    return score_documents(docs, model).where(F.col("score") >= LEAST_SCORE).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of many sites."""
    cleaned = remove_boilerplate(docs, "source")
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint"))
    return cleaned.withColumn("n_chars", F.coalesce(length, "n_chars")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies, which share 80 % of five words."""
    return keep_one(docs, n=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence of at most 2048 tokens."""
    return pack_documents(docs, WORD_BPE, end_id=0, capacity=2048, max_pieces=KEPT_WORDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("best_fit_packing", packing),
]

#: The classifier, the sketches of the join and the packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
