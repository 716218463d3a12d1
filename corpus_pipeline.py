"""A training corpus from the `documents` table, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns the columns of
`documents`; the last returns the mix. Quality classifier: rejected documents go. SimHash near-dedup: the
document with the smallest id of each group stays. Substring dedup: passages that an earlier document has are cut
from the text, and documents of which no word is left go. Decontamination: documents that hold a
benchmark item go. Mixing: how many words of each document the mix takes.

Defined cases are those of the operators. Documents without words that nothing was cut from stay; tables
without rows give an empty mix; extra columns are passed on up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqflow.llm import cotrain, decontaminate, mixing, simhash, substring
from seqflow.llm.common import short_batches, table, written

SHINGLE_WORDS, MAX_BITS = 3, 2


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cotrain.accepted(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return simhash.keep_one(docs, shingle=SHINGLE_WORDS, distance=MAX_BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    cut = substring.dedup_substrings(docs)
    cut = cut.where((F.col("_seqflow_cut.spans") == 0) | F.col("_seqflow_cut.text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.when(F.col("_seqflow_cut.spans") == 0, F.col("n_chars")).otherwise(F.length("_seqflow_cut.text")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumns({"text": F.col("_seqflow_cut.text"), "n_chars": length}).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
]

#: SQL can't express the classifier, the fingerprints, the chunks or the alignment; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
