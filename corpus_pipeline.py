"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup,
benchmark decontamination, SentencePiece encoding.

Each stage is one operator of ``pulseline.llm`` and works on all that the
stage before it kept.  All but the last return the columns of documents; the
last adds the piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.llm.common import table
from pulseline.llm.fmindex import decontaminate
from pulseline.llm.linedup import dedup_lines
from pulseline.llm.pieces import encode_texts
from pulseline.llm.quality import keep_good
from pulseline.llm.simhash import keep_first
from pulseline.session import materialize


def _recount(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites go from all documents but the first with each."""
    return _recount(dedup_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go from contaminated documents."""
    return _recount(decontaminate(docs, table(spark, sf_dir, "benchmark")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, input_ids, n_tokens and both checks."""
    return encode_texts(docs).drop("decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("sentencepiece encoding", encoding),
]

#: Robust estimates, fingerprints and tokenisation are not SQL; tests/llm has a brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
