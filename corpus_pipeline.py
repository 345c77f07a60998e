"""Corpus preparation in five stages, each working on what the one before has kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents. Rows without an id, with null
texts, repeated rows and further columns pass through like any others: columns are carried by position, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import bpe, decontaminate, jaccard, langid, repetition
from tallybrook.llm.common import own_shuffles_dropped, run_folder, table

#: A text whose best language has a smaller share is not in a language that the model knows.
LEAST_LANGUAGE = 0.3
#: Near copies: words of a shingle, least similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _filtered(docs: DataFrame, judge: Callable[[DataFrame, str, list[str]], DataFrame], passes: Column) -> DataFrame:
    """Rows of ``docs`` that pass, with the columns as they were. judge gets the table, its text column and the columns to carry."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    judged = judge(docs.toDF(*names), names[docs.columns.index("text")], names)
    return judged.filter(passes).select(*names).toDF(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language that the labelled documents have."""
    model = langid.train(docs)
    return _filtered(docs, lambda d, text, keep: langid.predict(d, model, text, keep), (F.col("lang_pred") != langid.UND) & (F.col("score") >= LEAST_LANGUAGE))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that do not mostly repeat themselves."""
    return _filtered(docs, lambda d, text, keep: repetition.judge(d, text_col=text, keep=keep), F.col("kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; equal rows once. Rows without an id belong to no group."""
    linked = jaccard.link(docs, NEAR_WORDS, NEAR_PERCENT)
    first = linked.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.join(first, "doc_id", "left_semi").dropDuplicates()
    return named.unionByName(docs.filter(docs["doc_id"].isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of which stands in the benchmark."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _filtered(docs, lambda d, text, keep: decontaminate.report(d, benchmark, text_col=text, keep=keep), ~F.col("contaminated"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): token ids as little-endian 32-bit integers, decoded again as a check."""
    decoded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    n = F.floor(F.octet_length("ids") / 4).cast("long")
    return decoded.select("doc_id", n.alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("quality", quality), ("near_copies", near_copies), ("decontamination", decontamination), ("tokens", tokens)]

#: A conditional random field and byte-pair merges have no SQL; a test runs the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), run_folder(spark)
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        kept = stage(spark, docs, sf_dir)
        with own_shuffles_dropped(spark):
            kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
