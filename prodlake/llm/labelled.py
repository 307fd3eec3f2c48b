"""Training rows for the classifiers: a bounded sample of the labelled documents that may be learned from."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of what the driver sees: documents, and bytes of their texts together.
SAMPLE, SAMPLE_BYTES = 4000, 64 << 20


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, sample: int = SAMPLE, budget: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, text, y) of at most `sample` labelled documents outside the held-out fold, chosen by hash.

    Only ids and labels are ordered; the chosen ones, bounded by `sample`, are broadcast to the documents. Of
    them the shortest are taken as long as their texts together stay under `budget` bytes, so that one
    document of any length cannot exceed what the driver holds; texts are never cut.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("doc_id"), modulus) != held))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
    # a row for each length that occurs among the chosen, whatever number of rows repeats their ids
    sizes = rows.groupBy(F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).agg(F.count("*").alias("n")).orderBy("size").collect()
    upto = list(accumulate(r["size"] * r["n"] for r in sizes))
    if not upto or upto[-1] <= budget:
        return rows
    longest = max((r["size"] for r, total in zip(sizes, upto, strict=True) if total <= budget), default=-1)
    return rows.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
