"""Corpus pipeline: language ID, SimHash near-dedup, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a driver writes it as Parquet and reads it again as the next
stage's docs. All but the last return the columns of documents. Every stage works on all rows that it is given.

Defined results: null, empty and letterless texts go in the first stage; a null doc_id is in no training sample and can't name a group of
near-duplicates, so its row stays a group's member that is never dropped; rows that repeat a doc_id are one document to the second stage; a null
source is a source of its own, the last; texts of any length are read whole; an empty table gives an empty result; further columns of
documents, whatever their names, are carried up to the last stage, which returns doc_id, n_tokens and two digests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import bpe, langid, mixing, simhash
from quillstone.llm.common import ensure_shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows; it learns from the labelled ones outside the held-out fold.

    Null and letterless texts go, and texts far stranger than any that the classifier was calibrated on: other languages, code, gibberish.
    """
    return langid.reject(docs, slack=langid.SLACK)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document of least doc_id."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole epochs are whole repeats, so a doc_id can come up to three times."""
    return mixing.apply_mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and of the text decoded from them, one row for each row of docs."""
    return bpe.encode_digests(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("bpe_encode", encode_tokens),
]

#: Language ID is a trained model, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs, place = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{ensure_shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    raise ValueError("no stages")
