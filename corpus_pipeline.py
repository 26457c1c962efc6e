"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept, and returns a DataFrame that ``run`` writes
as Parquet to the shared folder and reads again for the next one; what a stage made on its way goes when its output is
written. All but the last return the columns of documents, and further columns as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact, langid, mixing, packing, simhash
from tessera.llm.common import fresh_path, keep, scratch
from tessera.llm.queries import tokenizer_path

#: SQL cannot express the stages: profiles, XXH64 fingerprints, seeded blocks and tokenizer ids have no counterpart there.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language stay. Null, empty and letterless texts are in none, so they go; a null id, language or source is no reason to."""
    return langid.classify(docs).where("accepted").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: null and empty ones are one group, rows without an id come last, of repeated rows one stays."""
    return exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, a similarity of 0.8 or more). Rows without an id stay."""
    return simhash.keep_one_each(docs, width=5, rule=simhash.SIMILAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are left out, repeated or, once a shard, cut, so that sources come to their target weights. Texts without words go; a null source is one of its own."""
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining rows with their place in sequences of 4096 tokens; texts of any length are cut into pieces."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), fresh_path(spark, "pipeline")
    for name, stage in STAGES:
        with scratch(spark):
            docs = keep(stage(spark, docs, sf_dir), name, path)
    return docs
