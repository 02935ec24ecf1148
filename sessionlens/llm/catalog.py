"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from sessionlens.llm import decontam, kd_clusters, line_dedup, near_dup, prefix_trie, span_dedup, topk
from sessionlens.llm import pipeline as corpus
from sessionlens.llm.common import table, with_package
from sessionlens.llm.decontam import contamination
from sessionlens.llm.kneser_ney import score_documents
from sessionlens.llm.line_dedup import dedup_lines
from sessionlens.llm.mixing import mix_documents
from sessionlens.llm.sharding import shard_documents
from sessionlens.llm.token_counts import count_tokens
from sessionlens.llm.toxicity import toxicity
from sessionlens.llm.url_filter import filter_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=16)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).drop("t", "class_t")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.dedup_spans(table(spark, sf_dir, "documents"), span=200)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("t")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_kd_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.run(spark, sf_dir)


def _packaged(f: Query) -> Query:
    @wraps(f)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        with_package(spark)
        return f(spark, sf_dir)

    return query


def queries() -> dict[str, Query]:
    return {f.__name__: _packaged(f) for f in (op1_sharding, op2_jaccard_join, op3_suffix_dedup, op4_mixing, op5_lm_scoring, op6_url_filter, op7_topk, op8_line_dedup, op9_decontamination, op10_toxicity, op11_token_counts, op12_prefix_trie, op13_kd_clusters, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard_join": near_dup.SQL, "op3_suffix_dedup": span_dedup.SQL, "op7_topk": topk.SQL, "op8_line_dedup": line_dedup.SQL, "op9_decontamination": decontam.SQL, "op12_prefix_trie": prefix_trie.SQL, "op13_kd_clusters": kd_clusters.SQL}
