"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figmine.llm.common import stored


#: edges that one task joins: 16 bytes each
ONE_TASK = 1_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars (node, smallest node of its component) of a local edge list, without self loops."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        np.minimum.at(label, before[x], low)
        np.minimum.at(label, before[y], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            break
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _contract(edges: DataFrame) -> DataFrame:
    """Each task replaces its edges by a spanning forest of stars, which is never larger."""

    def run(batches):
        table = [b for b in batches if b.num_rows]
        if table:
            t = pa.Table.from_batches(table)
            node, root = forest(t.column(0).to_numpy(), t.column(1).to_numpy())
            if len(node):
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def _labelled(stars: DataFrame) -> DataFrame:
    return stars.toDF("node", "root").unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def components(edges: DataFrame, max_rounds: int = 40, one_task: int = ONE_TASK) -> DataFrame:
    """``node, root`` for every node with an edge; ``root`` is the smallest node it can reach.

    At most ``one_task`` edges (a proven bound: they are counted) are joined by union-find in one task.
    More take alternating large-star and small-star steps; every step is a grouped minimum (combined before
    the shuffle) joined back, so a node with very many neighbours does not gather in one task.
    A step's result is written to the shared folder, which cuts the lineage."""
    current = stored(_contract(edges.toDF("a", "b").where("a <> b")), "edges")
    if current.count() <= one_task:
        return _labelled(stored(_contract(current.coalesce(1)), "edges"))
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        # large star: larger neighbours hang on the smallest of the neighbourhood
        large = both.join(low, both["a"] == low["k"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # small star: smaller neighbours and the node itself hang on the smallest
        down = large.distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        joined = down.join(least, down["a"] == least["k"])
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b"))).where("a <> b")
        following = stored(small.distinct(), "edges")
        # done when every node has one edge and no root has one itself
        roots = following.select("b").distinct()
        left = following.join(roots.withColumnRenamed("b", "r"), F.col("a") == F.col("r"), "left_semi").limit(1).count()
        many = following.groupBy("a").count().where("count > 1").limit(1).count()
        current = following
        if not left and not many:
            return _labelled(current)
    raise RuntimeError("components did not settle")
