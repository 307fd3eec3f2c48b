"""Registered queries of this package: name -> callable(spark, sf_dir), and their DuckDB SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from prodlake.llm.bpe import encode_documents
from prodlake.llm.chat import digests, expanded
from prodlake.llm.collocations import collocations
from prodlake.llm.jaccard_join import jaccard_components
from prodlake.llm.licences import scan
from prodlake.llm.main_text import extract
from prodlake.llm.media import store_documents
from prodlake.llm.mixing import mix_sources
from prodlake.llm.oracle import CHATS, COLLOCATIONS, JACCARD, TOP_K, licence_scan
from prodlake.llm.quality import quality
from prodlake.llm.session import documents, lean_batches
from prodlake.llm.suffix_dedup import repeated_passages
from prodlake.llm.topk import top_k
from prodlake.llm.toxicity import toxicity
from prodlake.llm.whitening import whiten


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), n=3, percent=90)


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    lean_batches(spark)
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    lean_batches(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without shard and offset, which differ from run to run."""
    return store_documents(documents(spark, sf_dir)).drop("shard", "offset")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With conversation -1, whose texts hold control strings."""
    hard = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digests(expanded(given.union(own)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_scan": op1_licence_scan,
    "op2_html_extraction": op2_html_extraction,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_quality": op4_quality,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_media_columns": op8_media_columns,
    "op9_bpe": op9_bpe,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_chat_formatting": op13_chat_formatting,
}

ORACLE_SQL: dict[str, str] = {
    "op1_licence_scan": licence_scan(),
    "op5_exact_top_k": TOP_K,
    "op10_ngram_jaccard_join": JACCARD,
    "op11_collocations": COLLOCATIONS,
    "op13_chat_formatting": CHATS,
}
