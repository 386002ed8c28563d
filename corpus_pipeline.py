"""A corpus pipeline out of the operators: each stage's result is written as Parquet and read as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstat.llm import decision_list, decontaminate, near_dup, piece_encoding, repeats
from regstat.llm.common import staged, table
from regstat.llm.queries import PIECE_MODEL, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the decision list learned from the labels keep."""
    return decision_list.accepted(docs, decision_list.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 100 bytes that start earlier in the corpus; n_chars follows the text."""
    cut = repeats.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in cut.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document left."""
    return piece_encoding.encode(docs, tokenizer_path(PIECE_MODEL))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
          ("decontamination", decontamination), ("encoding", encoding)]

#: The stages learn, hash or encode: no SQL expresses them; tests hold them to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
