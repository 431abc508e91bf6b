"""From raw documents to token files, stage by stage; each stage's rows are written before the next reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import language_id
from footfall.llm.catalog import token_rows
from footfall.llm.decontaminate import decontaminated
from footfall.llm.mixing import mixed
from footfall.llm.simhash_dedup import deduplicated
from footfall.llm.text import packed, table
from footfall.session import discard, scratch_path, scratch_scope


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language: not null, and with at least one letter."""
    model = language_id.fit_table(docs, language_id.trained_on())
    tagged = language_id.tag(docs, model, packed(docs))
    return tagged.filter(F.col("lang_pred") != language_id.NONE).select("kept.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return deduplicated(docs, shingle=3, distance=3)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in one piece or reordered."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the token files, in the order of their ids."""
    return token_rows(docs)


STAGES = [
    ("language id", identify_language),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("mixing to target weights", mix_sources),
    ("token output", write_token_files),
]

#: SQL can express neither the classifier nor the fingerprints; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. What a stage made on its way, and the table it read, are deleted once its own is written.

    Repeated rows, nulls, empty and very long texts are each stage's; an empty table gives an empty result; of the
    columns beside those of `documents`, stages keep what they are given.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "_"))
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
