"""From raw documents to packed training sequences. Each stage is written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crewcast.llm import decontaminate, exact_dedup, near_dedup, toxicity
from crewcast.llm.queries import pack_documents, toxicity_model
from crewcast.llm.registry import table
from crewcast.llm.storage import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not reject. Null and empty texts stay, as do all where no label is known; repeated rows are judged alike."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, sf_dir))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that of the smallest id; null counts as the empty text."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id. Texts without words and rows without an id stay."""
    return near_dedup.drop_near_copies(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; none goes where the benchmark is empty. Rows of one id go together."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences; a null or empty text is the end id alone."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("best_fit_packing", pack),
]

#: A trained model, estimated registers and a tokeniser have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
