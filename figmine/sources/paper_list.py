"""Paper lists: one id a line, with comments, in file order.

A list is read by splits.  Each line gets its place within its split; splits are counted, one row each, and the
lines before a split are added.  So no task holds more than a split, however long the list or its files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from figmine.functions import text as T
from figmine.sinks.shared import shared_path


def _before(groups: DataFrame, order: list[str], count: str) -> DataFrame:
    """What the groups before have in all: one row a group, so one small window."""
    whole = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return groups.withColumn("__before", F.coalesce(F.sum(count).over(whole), F.lit(0))).drop(count)


def indexed(df: DataFrame, order: str, name: str) -> DataFrame:
    """0-based position in an order, without gathering all rows in one task: rows are range-partitioned, sorted
    and written with their place; the sizes of the partitions before (one row a partition) are added."""
    path, place = shared_path(df.sparkSession, "ordered"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    df.orderBy(order).withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumn("__part", F.shiftright("__at", 33))
    parts = _before(rows.groupBy("__part").agg(F.count("*").alias("__n")), ["__part"], "__n")
    return rows.join(parts, "__part").select(*df.columns, (place + F.col("__before")).alias(name))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, raw`` of a file, or of the files of a folder by name: lines end at ``\\n`` or ``\\r\\n``, numbers start
    at 0.  The last line may lack its end; a file that ends with one has no empty line after it."""
    split = ["__file", "__start"]
    lines = spark.read.text(path, lineSep="\n").select(
        F.regexp_replace("value", "\r$", "").alias("raw"), F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__at"))
    counted = lines.groupBy(*split).agg(F.count("*").alias("__n"))
    placed = lines.withColumn("__place", F.row_number().over(W.partitionBy(*split).orderBy("__at")) - 1)
    return placed.join(_before(counted, split, "__n"), split).select((F.col("__before") + F.col("__place")).alias("line_no"), "raw")


def read_paper_list(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, raw, id, kind`` of each line; kind is empty, comment, invalid, duplicate or valid.
    A missing file gives an empty result.  An id counts where it stands first: one row an id is aggregated
    and joined back, so comments and blank lines are no group of their own; a frequent id is a skewed join key."""
    try:
        lines = numbered_lines(spark, path)
    except AnalysisException:
        return spark.createDataFrame([], "line_no long, raw string, id string, kind string")
    raw = T.strip(F.col("raw"))
    known = lines.withColumn("id", T.clean_id(F.col("raw"))).withColumn("__ok", T.valid_id(F.col("id")) & ~raw.startswith("#"))
    first = known.where("__ok").groupBy(F.col("id").alias("__id")).agg(F.min("line_no").alias("__first"))
    kind = F.when(raw == "", "empty").when(raw.startswith("#"), "comment").when(~F.col("__ok"), "invalid").when(F.col("line_no") > F.col("__first"), "duplicate").otherwise("valid")
    # lines without an id get a key of their own that no id has, else they would all meet in a few partitions
    key = F.when(F.col("__ok"), F.col("id")).otherwise(F.concat(F.lit("#"), F.col("line_no").cast("string")))
    return known.withColumn("__key", key).join(first, F.col("__key") == F.col("__id"), "left").withColumn("kind", kind).select("line_no", "raw", "id", "kind")
