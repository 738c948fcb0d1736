"""The corpus pipeline: language filter, exact and near deduplication, decontamination, packing.

``STAGES`` holds (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a frame that is
written as Parquet and read again as the next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import all_columns, bound_batches, documents, release_shuffles, stored
from tidemark.llm.decontamination import without_contaminated
from tidemark.llm.exact_dedup import without_copies
from tidemark.llm.language import identify
from tidemark.llm.near_copies import without_similar
from tidemark.llm.packing import pack
from tidemark.sources.tables import load_parquet

#: Language models, shuffles of hashes and linear programs have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def _begin(spark: SparkSession) -> None:
    """Before a stage: bounded Arrow batches, and what earlier stages left behind is given back."""
    bound_batches(spark)
    release_shuffles(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the identifier, trained on these documents, rejects: no letters, or no language it knows."""
    _begin(spark)
    found = identify(docs, keep=True, prefix="__identified_")
    return found.where("not __identified_rejected").select(*all_columns(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (up to white space) the smallest doc_id stays."""
    _begin(spark)
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard index of 0.8 or more) the smallest doc_id stays.

    Fingerprints and multi-index hashing fetch the first candidates, a prefix filter all others; both are compared exactly.
    """
    _begin(spark)
    return without_similar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in passages of the benchmark."""
    _begin(spark)
    return without_contaminated(docs, load_parquet(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences."""
    _begin(spark)
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
