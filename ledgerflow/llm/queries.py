"""Registered queries of the operators and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import clusters, conversations, fingerprint, grammar, lines, mixing, neardup, packing, pii, quality, repeats, secrets, trie
from ledgerflow.llm.common import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": lambda spark, folder: mixing.mixed(documents(spark, folder)),
    "op2_personal_data": lambda spark, folder: pii.personal_data(documents(spark, folder)),
    "op3_token_grammar": lambda spark, folder: grammar.token_files(documents(spark, folder)),
    "op4_repeats": lambda spark, folder: repeats.without_repeats(documents(spark, folder)),
    "op5_token_counts": lambda spark, folder: trie.token_counts(documents(spark, folder)),
    "op6_fingerprints": lambda spark, folder: fingerprint.document_fingerprints(documents(spark, folder)),
    "op7_near_duplicates": lambda spark, folder: neardup.near_duplicates(documents(spark, folder)),
    "op8_packing": lambda spark, folder: packing.pack_documents(documents(spark, folder)),
    "op9_quality_cascade": lambda spark, folder: quality.quality_table(documents(spark, folder)),
    "op10_secret_ownership": lambda spark, folder: secrets.secrets(documents(spark, folder)),
    "op11_vector_clusters": lambda spark, folder: clusters.vector_clusters(table(spark, folder, "embeddings")),
    "op12_conversation_repair": lambda spark, folder: conversations.repaired_conversations(table(spark, folder, "conversations")),
    "op13_line_dedup": lambda spark, folder: lines.line_dedup(documents(spark, folder)),
}

ORACLE: dict[str, str] = {
    "op1_mixing": mixing.mixed_sql(),
    "op9_quality_cascade": quality.quality_sql(),
    "op11_vector_clusters": clusters.clusters_sql(),
    "op12_conversation_repair": conversations.repaired_conversations_sql(),
    "op13_line_dedup": lines.line_dedup_sql(),
}
