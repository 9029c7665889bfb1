"""The corpus pipeline: documents graded, deduplicated, mixed and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the docs of the next. All but the last return the columns
of ``documents``, whatever they are called. An empty table gives no rows in any stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import exact_dedup, mixing, packing, quality, simhash
from ledgerfold.sources.workspace import shared_folder, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that reach the best grade more likely than not.

    NULL texts are graded as empty ones, rows that repeat alike; without labels all stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.graded(docs, labels, carry=docs.columns).where("kept").select(*_carried(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space: the longest, then that of the smallest doc_id.

    NULL, empty and blank texts are one group; of rows that repeat, one stays.
    """
    return exact_dedup.exact_dedup(docs, carry=docs.columns).where("kept").select(*_carried(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest doc_id, or one of those without.

    NULL and empty texts have the fingerprint zero and are linked like any other.
    """
    found = simhash.near_duplicates(docs, shingle=3, max_bits=2, carry=docs.columns)
    return found.where("kept").select(*_carried(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix of their sources.

    A missing source is one of its own; rows without doc_id are ordered by their text.
    """
    mixed = mixing.mix(docs, carry=docs.columns)
    ordered = mixed.repartitionByRange("slot", "start", "doc_id").sortWithinPartitions("slot", "start", "doc_id")
    return ordered.select(*_carried(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens.

    Pieces are used, and sequences numbered, in the order of the mix. A document's place
    in it depends on the documents alone, so it is worked out again here: the files that
    hold them may be read in any order.
    """
    mixed = mixing.mix(docs, carry=["text"]).select("doc_id", F.col("row.text").alias("text"), "slot", "start")
    path = public_tokenizers.path("word_bpe_49k.json")
    # Written, so that no task sorts texts and encodes them at the same time.
    return packing.pack_documents(written(mixed), path, order=["slot", "start"])


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", select_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

# A fitted classifier, XXH64 fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def _carried(docs: DataFrame) -> list:
    return [F.col("row").getField(c).alias(c) for c in docs.columns]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below the shared folder."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_folder(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/stage-{i}")
    return docs
