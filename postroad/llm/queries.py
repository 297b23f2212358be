"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import os
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroad.llm import collocations, context_tree, decontaminate, languages, licenses, perplexity, perspectives, piece_tokens, prefix_trie, quality_rules, simhash, url_filter, warc


def ready(spark: SparkSession) -> None:
    """Workers of a local session find this package where the driver has it; a cluster gets it as it gets any package."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, [paths])])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(licenses.spans(read(spark, sf_dir, "documents")))


def op2_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.report(perspectives.rotate(read(spark, sf_dir, "conversations")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.find(documents, benchmark))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    vocabulary = piece_tokens.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    return piece_tokens.digests(piece_tokens.encode(documents, vocabulary))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    found = simhash.duplicates(documents)
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op8_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(read(spark, sf_dir, "documents"))


#: Host, path and verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(read(spark, sf_dir, "pages"), rules)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return perplexity.judge(documents, read(spark, sf_dir, "labels"))


def op11_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(read(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(prefix_trie.trie(prefix_trie.rebuilt(read(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_perspectives": op2_perspectives,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality_rules": op4_quality_rules,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_warc": op6_warc,
    "op7_simhash": op7_simhash,
    "op8_context_tree": op8_context_tree,
    "op9_url_filter": op9_url_filter,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_languages": op11_languages,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}
