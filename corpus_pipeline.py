"""The training-text pipeline: each stage takes what the one before it kept."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tracemill.llm import minhash, pieces, templates, tiling, toxicity
from tracemill.llm.common import table
from tracemill.session import spool


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go from all but the first; documents stay."""
    return templates.drop_repeated(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document, with the check that they decode to its text."""
    return pieces.encode(docs, public_tokenizers.path(pieces.MODEL))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_near),
    ("decontamination", decontaminate),
    ("piece encoding", encode_pieces),
]

# Training a compressor, tiling strings and sampling hashes aren't SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = spool(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
