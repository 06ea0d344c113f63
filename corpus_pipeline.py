"""The corpus pipeline: language ID, quality rules, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame; all but the last return the columns of ``documents``. Between stages the result is
written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from refinery.llm.bitmask_lang import UNKNOWN, identify
from refinery.llm.packing import pack_documents
from refinery.llm.quality_rules import judge
from refinery.llm.queries import fold, ready
from refinery.llm.stored import stored, table
from refinery.llm.superminhash import near_duplicates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document goes if its language is unknown, or if under this share of its n-grams belongs to
#: the language it resembles most.
LEAST_LANGUAGE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the corpus' own lang column teaches.

    Rows go whose text is null or has no letter, or of whose n-grams under ``LEAST_LANGUAGE`` belong to
    one language; those of a language that no, or hardly any, lang value teaches are among them. A null
    lang or doc_id does not matter for that; repeated rows are judged alike, texts of any length
    whole. An empty table stays empty; columns other than those of documents are dropped.
    """
    ready(spark)
    found = identify(docs, fold(3) != 1)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs of their language.

    A null or empty text has no words and goes. A null lang is a stratum of its own, and a null doc_id
    has no label. Repeated rows are judged alike, texts of any length whole; a value on a cutoff
    passes. An empty table stays empty; columns other than those of documents are dropped.
    """
    ready(spark)
    return judge(docs, table(spark, sf_dir, "labels")).filter("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the least doc_id, null after all others.

    Rows are told apart by a stored number of their own, so those with a null doc_id are grouped like
    others, and of repeated rows one stays. Texts that are null or have no words link with nothing:
    such rows are one group if they share a doc_id, and stay if it is null.
    """
    ready(spark)
    # zstd: the table holds all texts once more.
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "numbered", compression="zstd")
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("row"), "component_id", (F.col("n_shingles") > 0).alias("linking"))
    grouped = found.join(rows.select("row", "doc_id"), "row")
    by_component = F.col("linking") | F.col("doc_id").isNull()
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))["row"]
    kept = grouped.groupBy(
        F.when(by_component, F.col("component_id")).alias("component"), F.when(~by_component, F.col("doc_id")).alias("same")
    ).agg(least.alias("row"))
    return rows.join(kept.select("row"), "row", "left_semi").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, and their places in sequences of 2048 tokens.

    A null or empty text is the single id 0; longer texts than a sequence are cut, whatever their
    length, and nothing is dropped. Repeated rows are packed each, a null doc_id stays null. Pieces of
    one length are interchangeable. An empty table gives none; other columns are ignored.
    """
    ready(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: Learned filters, signatures and local search have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
