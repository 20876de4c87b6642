"""Outputs and state: dataset JSON, counts CSV, reference vectors, and the resume checkpoint.

Paths are read and written through Spark, so they may lie in any store that Spark knows.  Datasets, counts and states are
versions (``snapshots``): a rewrite that fails leaves what was there."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figmine.sinks import snapshots
from figmine.sinks.shared import remove

STATE = "last_paper_index int, last_paper_id string, total_found int, processed int, skipped int, failed int, timestamp string, version string"
REQUIRED = ("last_paper_index", "last_paper_id", "total_found", "processed", "timestamp")
COUNTS = "arxiv_id string, circuit_count int"


def _json(records: DataFrame, folder: str) -> None:
    records.write.json(folder)


def _csv(counts: DataFrame, folder: str) -> None:
    counts.select("arxiv_id", "circuit_count").write.csv(folder, header=True, nullValue="", emptyValue="")


def write_dataset(records: DataFrame, path: str) -> int:
    """One JSON object a line, ``filename`` with its record: the form that scales.  The number of the version."""
    return snapshots.write(records.sparkSession, path, lambda folder: _json(records, folder))


def dataset_object(records: DataFrame) -> DataFrame:
    """One JSON object keyed by file name, for datasets of a bounded size (the output cap)."""
    rest = [c for c in records.columns if c != "filename"]
    return records.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("filename", F.struct(*rest).alias("record")))))).alias("json"))


def read_dataset(spark: SparkSession, path: str, schema: str, part: str = "") -> DataFrame:
    """Records of the last version; none where nothing was ever committed.  Broken lines are left out (``broken_lines``
    has them); a version whose files are gone is an error, not an empty dataset."""
    folder = snapshots.folder(spark, path)
    if folder is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(folder + part)


def broken_lines(spark: SparkSession, path: str, schema: str, part: str = "") -> DataFrame:
    """``line``: lines of the last version that are no record of the schema."""
    folder = snapshots.folder(spark, path)
    if folder is None:
        return spark.createDataFrame([], "line string")
    rows = spark.read.text(folder + part).where(F.length(F.trim("value")) > 0)
    parsed = F.from_json("value", f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"})
    return rows.where(parsed["_broken"].isNotNull()).select(F.col("value").alias("line"))


def save_all(records: DataFrame, counts: DataFrame, path: str) -> bool:
    """Both outputs as one version: readers see both or neither.  Whether the commit names this version."""
    spark = records.sparkSession

    def both(folder: str) -> None:
        _json(records, f"{folder}/dataset")
        _csv(counts, f"{folder}/counts")

    version = snapshots.write(spark, path, both)
    return snapshots.versions(spark, path)[-1] == version


def write_counts(counts: DataFrame, path: str) -> int:
    """Rows of id and count, each file with a header; an id without a count has an empty field."""
    return snapshots.write(counts.sparkSession, path, lambda folder: _csv(counts, folder))


def read_counts(spark: SparkSession, path: str, part: str = "") -> DataFrame:
    folder = snapshots.folder(spark, path)
    if folder is None:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).csv(folder + part, header=True, mode="PERMISSIVE")


def write_reference_index(vectors: DataFrame, centroids: DataFrame, path: str) -> None:
    """Vectors by class, class centroids, and metadata: counts by class and dimension."""
    vectors.write.mode("overwrite").partitionBy("is_target").parquet(f"{path}/vectors")
    centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    meta = vectors.agg(F.count_if(F.col("is_target") == 1).alias("n_target"), F.count_if(F.col("is_target") == 0).alias("n_other"), F.count("*").alias("total"), F.max(F.size("embedding")).cast("long").alias("embedding_dim"))
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_reference_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Vectors with their label, and class centroids; a missing index is a FileNotFoundError."""
    try:
        return spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/centroids")
    except AnalysisException as e:
        raise FileNotFoundError(path) from e


def output_records(records: DataFrame) -> DataFrame:
    """Records with the names of the dataset (words joined by _) and text positions as [start, end]."""
    named = records.select(*(F.col(c).alias("".join("_" + x.lower() if x.isupper() else x for x in c)) for c in records.columns))
    return named.withColumn("text_positions", F.transform("text_positions", lambda p: F.array(p["start"], p["end"])))


def save_state(spark: SparkSession, path: str, **state) -> None:
    """The state as the next commit file: it appears whole or not at all, and the one before goes only then."""
    known = snapshots.versions(spark, path)
    snapshots.publish(spark, path, (known[-1] if known else 0) + 1, {c.split()[0]: state.get(c.split()[0]) for c in STATE.split(", ")})
    for old in known:
        remove(spark, snapshots.commit_path(path, old))


def state_file(spark: SparkSession, path: str) -> str | None:
    """The file of the last state."""
    known = snapshots.versions(spark, path)
    return snapshots.commit_path(path, known[-1]) if known else None


def load_state(spark: SparkSession, path: str) -> dict | None:
    """The last state, or None where it is missing, broken or incomplete: a fresh start."""
    try:
        state = snapshots.latest(spark, path)
    except (json.JSONDecodeError, UnicodeDecodeError, Py4JJavaError):  # the last: a file that fails its checksum
        return None
    return state if isinstance(state, dict) and all(state.get(c) is not None for c in REQUIRED) else None


def clear_state(spark: SparkSession, path: str) -> None:
    """Delete the saved state after a whole run; nothing happens where there is none."""
    remove(spark, path)


def resume_point(state) -> tuple[int, int]:
    return (0, 0) if state is None else (state["last_paper_index"] + 1, state["total_found"])
