"""The text operators as one corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from seatgrid.llm import mixing, packing, privacy, quality, simhash
from seatgrid.llm.common import stored

#: Sources are weighted by their numbers of rows to this power.
TEMPERATURE = 0.7


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by labels."""
    return privacy.sanitise(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted into the mix of their sources."""
    return mixing.mixed(docs, temperature=TEMPERATURE)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and their places in sequences of 2048 ids, numbered in the order of the mix.

    Row order does not outlast a table, so a document's slot and place are worked out again: they follow from ids and sources.
    """
    mix = mixing.mix(docs.select("doc_id", "text", "source"), carry=True, temperature=TEMPERATURE)
    mix = mix.select("slot", "place", "row.doc_id", "row.text")
    return packing.pack_in_order(mix, public_tokenizers.path("word_bpe_49k.json"), 2048, 0, memo=400_000)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("best-fit packing", sequences),
]

#: Fingerprints, components and tokenizers are beyond SQL; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
