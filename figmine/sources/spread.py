"""Small tables and costly groups over all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt out once if it comes in fewer splits than there are cores, as one small file with one row
    group does: what follows would run in one task.  A table with splits enough is left as it is, so at
    scale there is no exchange here."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt_by(df: DataFrame, column: str) -> DataFrame:
    """``df`` dealt by a column into the session's shuffle partitions, as many as it says.  Partitions counted
    in bytes alone are merged where rows are few, and pages that cost Python much then share one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), column)
