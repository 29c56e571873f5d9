"""From raw documents to packed training sequences.

Each stage reads all that its predecessor kept, from Parquet, and returns the
rows it keeps with the columns of ``documents``; the last returns pieces of
sequences.  ``run`` writes the stages' results to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import jaccard_join, mixing, packing, quality_knn, quality_rules
from panelforge.llm.common import stage, table
from panelforge.llm.queries import tokenizer_path


#: Rows of an Arrow batch: whole documents travel in them, several batches per task at once.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the combined rules reject go."""
    _small_batches(spark)
    return quality_rules.good_rows(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled raw documents."""
    _small_batches(spark)
    return quality_knn.good_rows(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    _small_batches(spark)
    return jaccard_join.one_per_class(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order that mixes the sources to their target weights."""
    _small_batches(spark)
    return mixing.in_mixed_order(docs)


#: Documents that are packed together: 32 slots of the mixed order.
RUN_ROWS = 32 * mixing.BLOCK_ROWS


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, whose ids follow the mixed order in runs of ``RUN_ROWS`` documents.

    A scan returns files and their splits in any order and the documents have
    no column for their slot, so the slots, which depend on nothing but the
    documents, are computed again."""
    _small_batches(spark)
    return packing.pack_documents(mixing.in_mixed_order(docs), tokenizer_path(), run_rows=RUN_ROWS)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("mixing sources", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the rules' expectation-maximisation nor tokens; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
