"""The corpus pipeline: toxicity, n-gram Jaccard join, suffix-array dedup, mixing to target weights, BPE.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from prodlake.llm.bpe import encode_documents
from prodlake.llm.jaccard_join import drop_near_duplicates
from prodlake.llm.mixing import mix_rows
from prodlake.llm.session import lean_batches, shared_dir
from prodlake.llm.suffix_dedup import drop_repeats
from prodlake.llm.toxicity import drop_toxic


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents predicted toxic go."""
    lean_batches(spark)
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: five-word shingles, similarity 0.8 or more; the smallest doc_id of each group stays."""
    lean_batches(spark)
    return drop_near_duplicates(docs, n=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: later copies of passages of 50 words or more are cut from the texts."""
    lean_batches(spark)
    return drop_repeats(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents are taken to the target weights, a row for each time."""
    lean_batches(spark)
    return mix_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: token ids, and the digest of the text decoded from them."""
    lean_batches(spark)
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("jaccard_join", join_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_to_weights),
    ("bpe", encode),
]

#: Learned scores and token merges have no SQL form; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
