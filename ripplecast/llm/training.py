"""The bounded, labelled sample a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo `modulus`."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, rows: int, usable: Column | None = None) -> DataFrame:
    """(doc_id, text, y) of at most `rows` labelled documents, chosen by the hash of their id.

    The choice is a top-k by hash (no bias by place or source) and small enough to
    broadcast to the scan of the documents. Repeated label rows count once.
    """
    picked = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
    if usable is not None:
        picked = picked.where(usable)
    picked = picked.groupBy("doc_id").agg(F.max(target).cast("double").alias("y"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])
