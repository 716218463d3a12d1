"""The registered queries of this subpackage: thin calls of the operators with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqflow.llm import ann, collocations, cotrain, decontaminate, hard_negatives, html_text, lm, mixing, packing, simhash, substring, url_filter, warc
from seqflow.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).drop("url", "payload")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2).drop("fp")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_seqflow_cut.text").alias("text"), F.col("_seqflow_cut.spans").alias("spans"), F.col("_seqflow_cut.kept_in").alias("kept_in"))


#: (verdict, host and path prefix)
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


#: a public tokenizer file; a path is a parameter of the operator
WORD_BPE = "word_bpe_49k.json"


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return out.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95, scale=256)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, top=2000, scale=2_000_000, cover=80)


LLM_QUERIES = {
    "op1_quality": op1_quality,
    "op2_warc": op2_warc,
    "op3_ann": op3_ann,
    "op4_simhash": op4_simhash,
    "op5_decontaminate": op5_decontaminate,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_lm_score": op8_lm_score,
    "op9_mix_sources": op9_mix_sources,
    "op10_html_text": op10_html_text,
    "op11_packing": op11_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}

LLM_ORACLE = {
    "op2_warc": warc.ORACLE,
    "op9_mix_sources": mixing.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
