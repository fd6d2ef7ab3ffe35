"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

All stages but the last return the columns of documents. ORACLE_SQL is None, since SQL expresses neither the compression
models nor the encoder; tests/llm holds the operators against brute-force versions, the library or held-out labels.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailq.llm import decontamination, language_id, near_dedup, piece_encoding, toxicity
from retailq.llm.common import stored, table
from retailq.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is told; rejected are texts without letters and margins below the lowest 0.5 % of those of
    held-out rows, as most texts of two languages have them."""
    model, margin = language_id.narrow_margin(docs)
    return language_id.keep_identified(docs, model, margin)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model, fitted on the labelled rows at hand, does not judge toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.keep_ordinary(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies, at five words and a similarity of 0.8.

    With 8 chunks a pair of that similarity is missed with a probability of about 1e-6.
    """
    return near_dedup.keep_one_each(docs, near_dedup.Settings(percent=80, chunks=8))


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with less than a twentieth of their words inside benchmark windows."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids, ids_crc32, decoded_crc32, round_trip of every row that is left."""
    return piece_encoding.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("toxicity", not_toxic),
    ("near_dedup", one_of_each_group),
    ("decontamination", not_in_benchmark),
    ("piece_encoding", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
