"""Queries over the test tables: one per operator, with production parameters
and over whole tables.  ``ORACLE_SQL`` has DuckDB SQL where SQL can express the
result; the others are tested against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .mixing import MIX_SQL
from .phrases import PHRASE_SQL
from .sharding import SHARD_SQL

TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    """Where this machine keeps a public vocabulary; every executor has it there."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract_main_text
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_verdicts
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import score_texts
    return score_texts(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


def op8_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_knn import quality_scores
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bm25 import search
    docs = table(spark, sf_dir, "documents")
    return search(docs, docs.filter("doc_id % 100 = 0"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_scores
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_identifiers, span_digests
    return span_digests(find_identifiers(table(spark, sf_dir, "documents")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import damaged, digests, repair_conversations
    rows = table(spark, sf_dir, "conversations")
    return digests(repair_conversations(damaged(rows), names=rows))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import mine_phrases
    return mine_phrases(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import assign_shards
    return assign_shards(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources
    return mix_sources(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_html_extract": op1_html_extract,
    "op2_packing": op2_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_lm_score": op4_lm_score,
    "op5_sharding": op5_sharding,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_mixing": op7_mixing,
    "op8_quality_knn": op8_quality_knn,
    "op9_bm25_search": op9_bm25_search,
    "op10_toxicity": op10_toxicity,
    "op11_pii": op11_pii,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_phrases": op13_phrases,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op5_sharding": SHARD_SQL,
    "op7_mixing": MIX_SQL,
    "op13_phrases": PHRASE_SQL,
}
