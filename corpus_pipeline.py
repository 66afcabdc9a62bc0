"""From documents to packed training sequences, each stage one of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playlake.llm.frames import stored
from playlake.llm.hostrules import kept_documents
from playlake.llm.mixing import mixed_documents
from playlake.llm.packing import packed
from playlake.llm.simhash import one_of_each
from playlake.llm.suffixes import without_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Fingerprints (XXH64) and greedy packing have no SQL; tests compare with brute force instead.
ORACLE_SQL: str | None = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail a rule, unless their host clears them, or whose host fails nearly always.

    A null or blank text is short and goes; a null source is a host; repeated rows are judged alike.
    """
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each SimHash group, that with the smallest id: 3-word shingles, at most 3 bits apart.

    A null text has fingerprint zero, a null id comes last, of repeated rows one stays.
    """
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages of 50 bytes that a document with a smaller id holds already.

    A null text stays null; a null id is in no order with others; a document may be left empty.
    """
    return without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source as often as its weight asks: a document not at all, in part, or twice.

    A null source is a source; texts without words are in no mix; null ids and repeated rows are rows.
    """
    return mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into training sequences of permitted lengths; long texts are cut into pieces."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("source_mix", source_mix),
    ("best_fit_packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
