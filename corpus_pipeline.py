"""The corpus pipeline: documents to packed training sequences, in five stages.

Every stage takes what its predecessor kept. All but the last return the columns of
`documents`; the last returns the placed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.decontamination import drop_leaks
from ripplecast.llm.jaccard_join import keep_one_of_each
from ripplecast.llm.packing import pack
from ripplecast.llm.quality_rules import keep_quality
from ripplecast.llm.secrets import mask_secrets
from ripplecast.llm.tables import importable, materialise, read

#: Vocabulary file of the packing stage, by its name among the public tokenizers.
TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the rules reject go."""
    return keep_quality(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each class of linked documents the one with the least doc_id stays."""
    importable(spark)
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark item go."""
    return drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: secrets are masked; n_chars follows the text."""
    return mask_secrets(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the remaining documents as token pieces in sequences."""
    import public_tokenizers

    importable(spark)
    return pack(docs, public_tokenizers.path(TOKENIZER), keep_ids=False).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", scan_secrets),
    ("best_fit_packing", best_fit_packing),
]

#: Trained rules, classes of documents and packing are beyond one SQL statement: tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
