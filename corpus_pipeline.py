"""The corpus pipeline: documents in, packed sequences out.

In every stage a null text counts as empty, repeated rows are rows of their own unless the stage removes copies, further columns go along
untouched, and an empty table gives an empty table with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm import packing, pii, quality, simhash, substrings
from tallyworks.llm.common import table, written


def sound(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null, empty and very short texts fail the base rules and go; repeated rows share their
    verdict, ties of the posterior with its bound keep the document."""
    return quality.keep_sound(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id, of one id's rows the one with the smallest fingerprint, and
    of repeated rows one. Texts without a word have the fingerprint zero and count as copies of each other; rows without an id
    stay."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that start in a document with a smaller id go. Texts that lose nothing stay as they are, others keep the
    remaining words joined by spaces; rows of one id never cut each other; a document may become empty, but stays."""
    return substrings.without_repeats(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in square brackets; overlapping spans give way as one. A null text stays null."""
    return pii.without_pii(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids: one row a piece with its ids (little-endian 32 bit), its sequence and its place there. An empty text is
    its end id alone; repeated rows are packed each."""
    return packing.pack_documents(docs, packing.word_tokenizer(), keep_ids=True)


STAGES = [
    ("sound", sound),
    ("near_dedup", near_dedup),
    ("cut_repeats", cut_repeats),
    ("mask_pii", mask_pii),
    ("pack", pack),
]

#: Tokenising and packing have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the whole of what its predecessor kept, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
