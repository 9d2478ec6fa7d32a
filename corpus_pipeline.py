"""A training corpus from documents: toxic texts out, near copies out, repeats out, secrets masked, packed.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the
last return the columns of documents. An empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import packing, repeats, secret_scan, simhash, toxicity
from surveyloom.llm.common import crc_fold, read, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Texts scored at or above this are rejected.
TOXIC = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; null and empty texts stay. The labels' test fold is not used."""
    grammar = toxicity.train(docs, read(spark, sf_dir, "labels").where(crc_fold("doc_id", 4) != 2))
    scored = toxicity.score(docs, grammar, keep=tuple(c for c in COLUMNS if c != "doc_id"))
    return scored.where(F.col("score") < TOXIC).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: SimHash of three-word shingles, at most three bits apart.

    The row with the smallest id stays, of rows that repeat this id the one whose columns hash
    smallest. Rows without an id stay only where their group has no other.
    """
    return simhash.one_of_each(docs.select(*COLUMNS), words=3, distance=3)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words and more that documents of smaller id hold.

    Texts that lose nothing stay as they are; from the others the words left are joined by spaces. A
    document that loses all its words stays with an empty text.
    """
    left = repeats.remove_repeats(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return left.withColumn("text", text).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret found replaced by a mark."""
    found = secret_scan.scan(docs.select(*COLUMNS), keep=COLUMNS[2:])
    masked = secret_scan.masked(found)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1, derive={"ids_crc32": F.crc32("ids")})


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_copies),
    ("substrings", drop_repeats),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# SQL cannot express the stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result but the last written once to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
