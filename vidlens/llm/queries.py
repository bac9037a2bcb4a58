"""The registered ``opN_<name>`` queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm import ctw, embedding_dedup, html_text, line_dedup, mixing, ngram_join, packing, prefix_trie, runs, simhash, span_dedup, token_store, toxicity
from vidlens.llm.common import table
from vidlens.session import scratch_path


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write_token_store(table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    return token_store.read_documents(spark, path)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = span_dedup.span_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.repeat_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return runs.run_digests(runs.periodic_runs(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_html_extraction": op5_html_extraction,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_token_store": op9_token_store,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": embedding_dedup.ORACLE_SQL,
    "op2_line_dedup": line_dedup.ORACLE_SQL,
    "op6_ngram_jaccard_join": ngram_join.ORACLE_SQL,
    "op11_substring_dedup": span_dedup.ORACLE_SQL,
    "op12_conversation_trie": prefix_trie.ORACLE_SQL,
    "op13_periodic_runs": runs.ORACLE_SQL,
}
