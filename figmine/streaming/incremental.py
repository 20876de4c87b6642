"""Incremental runs: papers in order, batch by batch, until enough figures are found.

A batch's records are written into a folder of their own; one commit file then names that folder together with
the state that counts it, before the next batch begins.  So a stopped run goes on after the last whole batch and gives what
one run would have given, whatever the size of its batches; folders of a stopped batch, or of a run whose state was
cleared, are named by no commit and never read."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from figmine.sinks import snapshots
from figmine.sinks.shared import remove


def run(papers: DataFrame, detect: Callable[[DataFrame], DataFrame], out: str, batch: int = 1000, most: int | None = None, stop_after: int | None = None) -> DataFrame:
    """``papers`` has ``paper_idx``; ``detect`` turns papers into accepted rows with ``paper_idx`` and
    ``image_index``.  Only papers of the current batch reach ``detect``; ``most`` caps the total in
    order.  ``stop_after`` batches ends early.  Returns all rows written so far; none without papers."""
    spark = papers.sparkSession
    last = papers.agg(F.max("paper_idx")).first()[0]
    n = 0 if last is None else last + 1
    state = snapshots.latest(spark, out) or {"next": 0, "found": 0}
    snapshots.sweep(spark, out)  # what stopped batches left
    start, found, done = state["next"], state["found"], 0
    while start < n and (most is None or found < most) and (stop_after is None or done < stop_after):
        rows = detect(papers.where((F.col("paper_idx") >= start) & (F.col("paper_idx") < start + batch)))
        if most is not None:
            rows = rows.orderBy("paper_idx", "image_index").limit(most - found)
        written = {}

        def write(folder: str, rows=rows, written=written, start=start, found=found) -> None:
            rows.write.parquet(folder)
            written["found"] = found + spark.read.parquet(folder).count()

        start, done = min(start + batch, n), done + 1
        snapshots.write(spark, out, write, keep=0, note=lambda written=written, start=start: {"next": start, "found": written["found"]})
        found = written["found"]
    folders = snapshots.folders(spark, out)
    return spark.read.parquet(*folders) if folders else detect(papers.limit(0))


def clear(spark, out: str) -> None:
    """Forget a run: its commits go first, so that nothing of it is read, then its rows."""
    remove(spark, f"{out}/commits")
    remove(spark, f"{out}/data")


def capped(rows: DataFrame, most: int, order: tuple[str, ...] = ("paper_idx", "image_index")) -> DataFrame:
    """The first ``most`` rows of a stream: of each micro-batch, in order, as many as the total leaves room for.

    The total is keyed state: it lies in the state store and is committed with the batch's offsets, so a restart goes on
    with it.  The task that holds it keeps no more rows than there is room for, whatever the size of the batch."""
    columns = list(order)

    def first(_, frames, state):
        found = state.get[0] if state.exists else 0
        room, held = most - found, None
        for frame in frames:
            if room > 0:
                held = (frame if held is None else pd.concat([held, frame])).sort_values(columns, kind="stable").head(room)
        if held is not None and len(held):
            state.update((found + len(held),))
            yield held

    keyed = rows.withColumn("total_of", F.lit("run"))
    out = keyed.groupBy("total_of").applyInPandasWithState(first, keyed.schema, "found long", "append", "NoTimeout")
    return out.drop("total_of")


def file_stream(spark, path: str, schema: str, detect: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, most: int | None = None, files: int = 1):
    """The same detection over a stream of Parquet files, ``files`` a micro-batch in the order of their times, until
    ``most`` rows are found; offsets, the number found and results commit together.  Ends with the files that are there:
    started again, it goes on with new ones."""
    papers = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    rows = detect(papers)
    if most is not None:
        rows = capped(rows, most)
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).outputMode("append").trigger(availableNow=True).start()


def numbered(rows: DataFrame) -> DataFrame:
    """``filename`` of the n-th accepted figure of each paper."""
    n = F.row_number().over(W.partitionBy("paper_idx").orderBy("image_index"))
    return rows.withColumn("filename", F.concat(F.replace(F.col("arxiv_id"), F.lit("/"), F.lit("_")), F.lit("_"), n.cast("string"), F.lit(".png")))
