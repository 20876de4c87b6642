"""An inverted file of vectors that is written once and opened many times.

Every vector lies in the folder of its cell, so a search reads the folders of the cells that its queries ask
and no others (partition pruning at run time).  The index is one committed version: centres, sizes of cells and
vectors appear together, and writing it anew leaves the one before readable until then."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figmine.operators import classify as K
from figmine.sinks import snapshots

#: vectors of a file, about
FILE_ROWS = 500_000


@dataclass(frozen=True)
class StoredIndex:
    vectors: DataFrame  # ref_id, ref, label, cell
    sizes: DataFrame  # cell, n
    centres: np.ndarray
    probes: int


def write_index(references: DataFrame, path: str, k: int = 10, cells: int | None = None, file_rows: int = FILE_ROWS) -> int:
    """Index ``vec_id, embedding, label`` under ``path``; the number of the version.

    Centres, and how many cells a query must ask, are fitted on a bounded sample; every row with a vector is
    stored.  Rows without one are left out; an empty table gives an empty index.  Vectors have one length."""
    spark = references.sparkSession
    sound = references.where("embedding is not null")
    known = K._sides(sound, sound)[1]
    cells = cells or int(min(K.MOST_CELLS, max(1, round(known.count() ** 0.5))))
    centres, probes = K.fit_cells(sound, cells, k)

    def write(folder: str) -> None:
        placed = K.in_cells(known, "ref", centres, 1).withColumn("cell", F.col("cells")[0]).drop("cells") if len(centres) else known.withColumn("cell", F.lit(0))
        sizes = placed.groupBy("cell").agg(F.count("*").alias("n"))
        sizes.coalesce(1).write.parquet(f"{folder}/sizes")
        files = F.broadcast(spark.read.parquet(f"{folder}/sizes").select("cell", F.ceil(F.col("n") / file_rows).cast("int").alias("files")))
        dealt = placed.join(files, "cell").withColumn("file", F.pmod(F.xxhash64("ref_id"), "files")).repartition("cell", "file").drop("files", "file")
        dealt.write.partitionBy("cell").parquet(f"{folder}/vectors")
        rows = [(i, c.tolist()) for i, c in enumerate(centres)]
        spark.createDataFrame(rows, "cell int, centre array<double>").coalesce(1).write.parquet(f"{folder}/centres")

    return snapshots.write(spark, path, write, note=lambda: {"probes": probes})


def open_index(spark: SparkSession, path: str) -> StoredIndex:
    """The last committed index; FileNotFoundError where there is none.  At most MOST_CELLS centres are held."""
    last = snapshots.latest(spark, path)
    if last is None:
        raise FileNotFoundError(path)
    folder = f"{path}/{last['data']}"
    vectors = spark.read.schema("ref_id long, ref array<float>, label int, cell int").parquet(f"{folder}/vectors")
    rows = spark.read.parquet(f"{folder}/centres").orderBy("cell").toArrow()
    centres = np.array(rows["centre"].to_pylist(), float) if rows.num_rows else np.zeros((0, 0))
    return StoredIndex(vectors, spark.read.parquet(f"{folder}/sizes"), centres, last["probes"])


def search(index: StoredIndex, queries: DataFrame, k: int = 10, probes: int | None = None, block: int = 4096) -> DataFrame:
    """The k nearest stored vectors of each query among its nearest cells: ``vec_id, ref_id, label, distance, rank``.

    Queries without a vector find nothing, and so do all of them in an empty index.  What lies in cells that
    were not asked is missed; ``classify.recall`` measures it, and as many probes as cells miss nothing."""
    asked = queries.where("embedding is not null").select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"))
    if not len(index.centres):
        return asked.limit(0).selectExpr("vec_id", "vec_id AS ref_id", "0 AS label", "0.0D AS distance", "0 AS rank")
    asking = K.in_cells(asked, "embedding", index.centres, probes or index.probes).select("vec_id", "embedding", F.explode("cells").alias("cell"))
    # the cells asked are a small table; joined by it, the scan opens their folders only
    wanted = F.broadcast(asking.where("cell >= 0").select("cell").distinct())
    return K.among(asking, index.vectors.join(wanted, "cell", "left_semi"), index.sizes, asked.count(), k, block)
