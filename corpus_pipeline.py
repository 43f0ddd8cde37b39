"""From raw documents to token ids: quality rules, line dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next one's ``docs``. All stages but
the last return the columns of ``documents``; the last adds ``n_tokens`` and
``token_ids``. Null and empty texts, repeated rows and null ids are treated as
each operator's docstring says; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, linededup, mixing, rules, simhash
from tessera.llm.common import table
from tessera.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from the labelled ones."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line is 0.8 or more alike to."""
    return linededup.keep_first_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, 3 bits."""
    return simhash.keep_one(docs, shingle=3, bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the raked source, language and topic weights."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids; small tables, as earlier stages have filled the executors' heaps."""
    return bpe.encode(docs, remember=50_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Learned rules, similarity joins and byte-pair encoding are beyond SQL. Tests of the whole run look at row and
#: token counts only; no brute-force version of the five stages is there to compare kept rows with.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; results between them are in the shared scratch folder."""
    folder = scratch_path(spark, "pipeline", unique=True)
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
