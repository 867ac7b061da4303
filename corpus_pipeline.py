"""From documents to packed training sequences: language ID, near-duplicates, personal data, mixing, packing.

Language ID drops null, empty and letterless texts, and with them all that the later stages would find empty. Each later stage takes
every row for a document of its own: null and shared doc_ids stay, repeated rows are copies that near_dedup makes one. Ties between
copies go to the smallest doc_id, then a hash of the text. Very long texts are read whole. An empty table gives an empty result in each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltweave.llm import crf, minhash, mixing, packing, pii
from voltweave.llm.common import discard, staged, table
from voltweave.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go; a missing lang is filled in."""
    return crf.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) one document stays; each row is a document."""
    return minhash.drop_near_duplicates(docs, shingle_words=5, percent=80, by_row=True)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind; n_chars follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, with their ids; the copies that mixing makes go to different sequences."""
    return packing.pack_documents(docs, tokenizer_path(), end_id=2, window=4096, with_ids=True, apart=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("pii", redact_pii),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL can express neither the language model nor the near-duplicate and packing stages; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        done = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if n:
            discard(docs)
        docs = done
    return docs
