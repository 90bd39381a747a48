"""The corpus pipeline: documents in, a training mix out, one stage after another.

Every stage works on all rows that its predecessor kept, texts whole, and survives lost executors: what it returns is written
to the shared folder and read again. The last stage's rows are the mix: a document taken twice is two rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.compression import keep_good
from ledgerloom.llm.decontaminate import drop_contaminated
from ledgerloom.llm.mixing import mixed_documents
from ledgerloom.llm.pii import anonymised_documents
from ledgerloom.llm.queries import TEST_KEY
from ledgerloom.llm.shared import table, write_shared
from ledgerloom.llm.simhash import drop_near_duplicates


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier predicts to be bad go. Empty and null texts are scored like any; repeated rows share their fate."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within two bits stays, the one with the smallest id; rows without an id all stay."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts hold none; an empty benchmark takes none away."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced, and n_chars told anew. Every row stays; null and empty texts stay as they are."""
    return anonymised_documents(docs, TEST_KEY)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Texts without words are never taken; a null source is a source."""
    return mixed_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("surrogates", surrogates),
    ("mixing", mixing),
]

#: Compression, fingerprints and edit distances have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
