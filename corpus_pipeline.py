"""A training-data pipeline over ``documents``, in five stages of the ``figmine.llm`` operators.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps; its result is written as
Parquet and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figmine.llm import decontaminate, jaccard, line_dedup, mixing, toxicity
from figmine.llm.common import scratch
from figmine.sinks.shared import remove, shared_path


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.  The model learns from the labels of ``docs``.

    Null and empty texts get the score of a text without words; repeated rows are scored each; rows with
    a null id are scored and not learned from; without usable labels, or documents, all rows stay."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in the largest doc_id only.

    Null and empty texts stay as they are; rows that repeat an id count as one document, and each loses its
    own lines; rows with a null id lose nothing; an empty table stays empty."""
    return _recounted(line_dedup.without_repeated_lines(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest doc_id stays.

    Texts without words are linked with nothing and stay; rows that repeat an id stay or go together; rows
    with a null id stay; an empty table stays empty."""
    return jaccard.one_of_each(docs, n=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans that repeat a window of a benchmark item are removed from the texts.

    Null and wordless texts stay as they are; every row is judged by its own text, whatever its id; an empty
    benchmark removes nothing."""
    return _recounted(decontaminate.without_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: rows taken at least once, with size, source_size, target and taken words.

    Every row is drawn for itself, whatever its id; rows without words take none and go; a null source is
    a source of its own; columns named like one of the four are replaced; an empty table stays empty."""
    return mixing.mixed(docs).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", keep_one_of_each),
    ("decontaminate", drop_benchmark),
    ("mix_sources", mix_sources),
]

#: the stages of learned and balanced sampling cannot be expressed in SQL; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Once a stage's result is written, the tables it was made from go."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
