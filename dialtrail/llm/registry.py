"""The registered queries of this subpackage and the SQL some must agree with."""

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from dialtrail.llm import (
    byte_bpe,
    chat,
    digest,
    filter_audit,
    jaccard,
    langid,
    mixing,
    multi_index,
    packing,
    ppm,
    repeats,
    spelling,
    surrogates,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return filter_audit.audited_documents(docs, labels)


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard_join": _table("documents", jaccard.linked_by_three_words),
        "op1_ngram_jaccard_links": _table("documents", jaccard.links_by_three_words),
        "op2_chat_format": _table("conversations", chat.formatted_conversations),
        "op3_embedding_multi_index": _table("embeddings", multi_index.near_copies),
        "op4_mix_sources": _table("documents", mixing.mixed_documents),
        "op5_ppm_scores": _table("documents", ppm.score_documents),
        "op6_language_id": _table("documents", langid.document_languages),
        "op7_suffix_array_dedup": _table("documents", repeats.without_repeats),
        "op8_pii_surrogates": _table("documents", surrogates.documents_with_surrogates),
        "op9_pack_documents": _table("documents", packing.packed_documents),
        "pipeline": corpus_pipeline.run,
        "op10_document_digests": _table("documents", digest.compared_with_next),
        "op11_filter_audit": _audit,
        "op12_spelling_variants": _table("documents", spelling.word_variants),
        "op13_byte_bpe": _table("documents", byte_bpe.coded_documents),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard_join": jaccard.ORACLE_SQL,
        "op1_ngram_jaccard_links": jaccard.LINKS_SQL,
        "op2_chat_format": chat.ORACLE_SQL,
        "op7_suffix_array_dedup": repeats.ORACLE_SQL,
        "op11_filter_audit": filter_audit.ORACLE_SQL,
    }
