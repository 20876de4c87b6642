"""Vector scoring and decision operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from figmine import vocab
from figmine.functions import text as T
from figmine.functions import vectors as V


def class_centroids(vectors: DataFrame, label: str = "is_target") -> DataFrame:
    """Element-wise means by class, not normalised; partial sums meet per (class, position)."""
    parts = vectors.select(label, F.posexplode("embedding").alias("pos", "x")).groupBy(label, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return parts.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))


def centroid_scores(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """score = distance to the others / sum of both distances; 0.5 where both are 0.  Two rows are broadcast."""
    one = lambda k, name: F.broadcast(centroids.where(F.col("is_target") == k).select(F.col("centroid").alias(name)))
    d = vectors.crossJoin(one(1, "c1")).crossJoin(one(0, "c0")).withColumn("d1", V.distance(F.col("embedding"), F.col("c1"))).withColumn("d0", V.distance(F.col("embedding"), F.col("c0")))
    return d.withColumn("centroid_score", F.when(F.col("d0") + F.col("d1") > 0, F.col("d0") / (F.col("d0") + F.col("d1"))).otherwise(0.5)).drop("c1", "c0")


_NEAR = "vec_id long, ref_id long, label int, d2 double"


def _nearest(k: int):
    """The k nearest references of each query within one group, ties by id."""

    def run(key, asked: pa.Table, known: pa.Table) -> pa.Table:
        names = ("vec_id", "ref_id", "label", "d2")
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64())
        if not asked.num_rows or not known.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        known = known.sort_by("ref_id")
        matrix = lambda t, c: t[c].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(t.num_rows, -1)
        a, b = matrix(asked, "embedding"), matrix(known, "ref")
        ids, labels = known["ref_id"].to_numpy(), known["label"].to_numpy()
        # candidates by a matrix product, then the distances themselves: no cancellation in what is returned
        rough = (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
        wide = min(len(b), k + 16)
        part = np.sort(np.argpartition(rough, wide - 1, axis=1)[:, :wide], axis=1)
        cut = np.take_along_axis(rough, part, 1).max(axis=1)
        d2 = np.stack([((b[j] - x) ** 2).sum(axis=1) for j, x in zip(part, a, strict=True)])
        out = []
        for i in range(len(a)):
            j, d = part[i], d2[i]
            top = np.argsort(np.round(d, 9), kind="stable")[:k]
            scale = 1e-9 * (1 + (a[i] ** 2).sum() + abs(cut[i]))
            if wide < len(b) and d[top[-1]] >= cut[i] + (a[i] ** 2).sum() - scale:  # ties may reach beyond: look at all
                j, d = np.arange(len(b)), ((b - a[i]) ** 2).sum(axis=1)
                top = np.argsort(np.round(d, 9), kind="stable")[:k]
            out.append((j[top], d[top]))
        rows = np.concatenate([x for x, _ in out])
        asked_ids = np.repeat(asked["vec_id"].to_numpy(), [len(x) for x, _ in out])
        return pa.table([pa.array(x, t) for x, t in zip((asked_ids, ids[rows], labels[rows], np.concatenate([d for _, d in out])), kinds, strict=True)], names=names)

    return run


def _ranked(near: DataFrame, k: int) -> DataFrame:
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("vec_id").orderBy(F.round("d2", 9), "ref_id")))
    return ranked.where(F.col("rank") <= k).select("vec_id", "ref_id", "label", F.sqrt("d2").alias("distance"), "rank")


def _sides(queries: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    asked = queries.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"))
    known = references.select(F.col("vec_id").alias("ref_id"), F.col("embedding").cast("array<float>").alias("ref"), F.col("label").cast("int").alias("label"))
    return asked, known


def knn(queries: DataFrame, references: DataFrame, k: int = 10, block: int = 4096) -> DataFrame:
    """Exact nearest references by L2, ties by id: ``vec_id, ref_id, label, distance, rank``.

    Both sides are cut into blocks of about ``block`` rows and every pair of blocks is one group, so a
    group holds two blocks, whatever the tables.  Each side is shuffled once for every block of the
    other: 2 |Q| |R| / block rows.  That is the cost of an exact answer; ``knn_indexed`` asks fewer pairs."""
    asked, known = _sides(queries, references)
    blocks = lambda df: max(1, -(-df.count() // block))
    n_q, n_r = blocks(asked), blocks(known)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(n_q)).cast("int")).withColumn("rb", every(n_r))
    known = known.withColumn("rb", F.pmod(F.xxhash64("ref_id"), F.lit(n_r)).cast("int")).withColumn("qb", every(n_q))
    return _ranked(asked.groupBy("qb", "rb").cogroup(known.groupBy("qb", "rb")).applyInArrow(_nearest(k), _NEAR), k)


#: rows that the index is fitted on, at most, and its cells, at most
SAMPLE_ROWS, MOST_CELLS = 20_000, 4096


def fit_cells(references: DataFrame, cells: int, k: int = 10, target: float = 0.95, sample: int = SAMPLE_ROWS, rounds: int = 8) -> tuple[np.ndarray, int]:
    """Centres of ``cells`` cells by k-means on at most about ``sample`` rows, drawn by a hash of the id, and
    how many cells a query must ask so that, within the sample, it finds ``target`` of its k neighbours."""
    share = min(1.0, sample / max(1, references.count()))
    drawn = references.where((F.lit(share) >= 1) | (F.xxhash64("vec_id").cast("double") < F.lit(share * 2.0**64 - 2.0**63)))
    rows = drawn.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")).orderBy("vec_id").toArrow()
    if not rows.num_rows:
        return np.zeros((0, 0)), 0
    x = rows["embedding"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(rows.num_rows, -1)
    centres = x[np.random.default_rng(1).permutation(len(x))[:cells]]
    for _ in range(rounds):
        near = _cells_of(x, centres, 1)[:, 0]
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    home, asks = _cells_of(x, centres, 1)[:, 0], x[:: max(1, len(x) // 500)]
    d = (x * x).sum(axis=1)[None, :] - 2 * asks @ x.T
    near = np.argpartition(d, min(k, len(x)) - 1, axis=1)[:, :k]
    order = np.argsort(_cells_of(asks, centres, len(centres)), axis=1)  # place of each cell in a query's order
    places = np.sort(np.take_along_axis(order, home[near], 1).ravel())
    return centres, int(places[min(len(places) - 1, int(target * len(places)))]) + 1


def _cells_of(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest cells of each row, nearest first."""
    n = min(n, len(centres))
    d = (centres * centres).sum(axis=1)[None, :] - 2 * x @ centres.T
    near = np.argpartition(d, n - 1, axis=1)[:, :n]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)


def in_cells(df: DataFrame, column: str, centres: np.ndarray, most: int) -> DataFrame:
    """``cells``: the ``most`` cells nearest to each vector, nearest first."""
    shared = df.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        for batch in batches:
            x = batch.column(batch.schema.get_field_index(column)).flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, -1)
            near = _cells_of(x, shared.value, most) if batch.num_rows else np.zeros((0, 1), int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))], [*batch.schema.names, "cells"])

    return df.mapInArrow(run, StructType([*df.schema.fields]).add("cells", ArrayType(IntegerType())))


def among(asking: DataFrame, held: DataFrame, sizes: DataFrame, asked_rows: int, k: int, block: int) -> DataFrame:
    """The k nearest of the references that lie in the cells that each query asks.  ``sizes`` has a row a cell
    (cell, n), at most MOST_CELLS.  Cells larger than ``block`` are split, and the queries of a cell come in
    groups as well: a third of them may ask one cell."""
    parts = F.broadcast(sizes.select("cell", F.ceil(F.col("n") / block).cast("int").alias("parts")))
    held = held.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("ref_id"), "parts").cast("int")).drop("parts")
    asking = asking.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    turns = max(1, -(-asked_rows // block))
    asking = asking.withColumn("turn", F.pmod(F.xxhash64("vec_id"), F.lit(turns)).cast("int"))
    held = held.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    key = ("cell", "part", "turn")
    return _ranked(asking.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(_nearest(k), _NEAR), k)


def knn_indexed(queries: DataFrame, references: DataFrame, k: int = 10, cells: int | None = None, probes: int | None = None, block: int = 4096) -> DataFrame:
    """As ``knn``, by an inverted file: every reference lies in the cell of its nearest centre, and a query
    asks its ``probes`` nearest cells (by default as many as the fit found enough).  Centres are fitted on a
    bounded sample, all rows are indexed, and no group grows.  Neighbours in cells that were not asked
    are missed: ``recall`` measures how many.  ``stored_index`` keeps such an index."""
    asked, known = _sides(queries, references)
    n = known.count()
    cells = cells or int(min(MOST_CELLS, max(1, round(n**0.5))))
    centres, enough = fit_cells(references, cells, k)
    probes = probes or enough
    if not len(centres):
        return knn(queries, references, k, block)
    held = in_cells(known, "ref", centres, 1).withColumn("cell", F.col("cells")[0]).drop("cells")
    sizes = held.groupBy("cell").agg(F.count("*").alias("n"))
    asking = in_cells(asked, "embedding", centres, probes).select("vec_id", "embedding", F.explode("cells").alias("cell"))
    return among(asking, held, sizes, asked.count(), k, block)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``n, found, recall``: the share of exact neighbours that an index found."""
    keys = ["vec_id", "ref_id"]
    hit = exact.select(*keys).join(found.select(*keys).withColumn("hit", F.lit(1)), keys, "left")
    return hit.agg(F.count("*").alias("n"), F.count("hit").alias("found"), (F.count("hit") / F.count("*")).alias("recall"))


def knn_scores(neighbours: DataFrame) -> DataFrame:
    return neighbours.groupBy("vec_id").agg(F.count_if(F.col("label") == 1).alias("n_target"), F.count("*").alias("n")).withColumn("knn_score", F.col("n_target") / F.col("n"))


def confidence(score: Column, high: float = 0.80, medium: float = 0.60) -> Column:
    return F.when(score >= high, "HIGH").when(score >= medium, "MEDIUM").otherwise("LOW")


def decide(w: Column, h: Column, readable: Column, caption: Column, has_gates: Column, score: Column, min_w: int = 100, min_h: int = 100, threshold: float = 0.70) -> Column:
    """The decision table, first matching row wins: (is_target, confidence, tier, negative)."""
    row = lambda ok, conf, tier, neg: F.struct(F.lit(ok).alias("is_target"), (conf if isinstance(conf, Column) else F.lit(conf)).alias("confidence"), F.lit(tier).alias("tier"), F.lit(neg).cast("string").alias("negative"))
    less = F.round(1 - score, 6)
    return (F.when(~readable, row(False, 0.0, "error", "read_error"))
            .when((w < min_w) | (h < min_h), row(False, 0.0, "too_small", "too_small"))
            .when((caption == "ACCEPT") & ~has_gates, row(False, 0.8, "caption_whitelist_no_gates", "no_gates_found"))
            .when(caption == "ACCEPT", row(True, 0.95, "caption_whitelist", None))
            .when(caption == "REJECT", row(False, 0.95, "caption_blacklist", "caption_blacklist"))
            .when(score.isNull(), row(False, 0.0, "detection_error", "detection_error"))
            .when((score >= threshold) & ~has_gates, row(False, less, "dinov2_high_no_gates", "no_gates_found"))
            .when(score >= threshold, row(True, score, "dinov2_high", None))
            .when(score >= 0.50, row(False, less, "dinov2_medium_rejected", "dinov2_medium"))
            .otherwise(row(False, less, "dinov2_low_rejected", "dinov2_low")))


def topic_similarity(texts: DataFrame, refs: DataFrame) -> DataFrame:
    """Cosine with each reference text vector; accept at 0.65 with a margin of 0.10.  ``refs`` has a row a
    topic (ord, category, ref): a bounded table, broadcast as one array."""
    packed = F.broadcast(refs.agg(F.array_sort(F.collect_list(F.struct("ord", "category", "ref"))).alias("refs")))
    scored = texts.crossJoin(packed).withColumn("top", F.slice(F.array_sort(F.transform("refs", lambda r: F.struct((-F.round(V.cosine(F.col("embedding"), r["ref"]), 6)).alias("neg"), r["ord"].alias("ord"), r["category"].alias("category")))), 1, 3))
    best, second = -F.col("top")[0]["neg"], -F.col("top")[1]["neg"]
    ok = (best >= 0.65) & (F.round(best - second, 6) >= 0.10)
    return scored.select("vec_id", F.when(ok, F.col("top")[0]["category"]).otherwise("Unknown").alias("category"), best.alias("score"), F.round(best - second, 6).alias("margin"),
                         F.when(~ok, "LOW").when(best >= 0.80, "HIGH").when(best >= 0.70, "MEDIUM").otherwise("LOW").alias("confidence"), F.array_join(F.transform("top", lambda t: t["category"]), ",").alias("top3"))


def detect_gates(texts: DataFrame) -> DataFrame:
    """Symbols of each image from the texts read in its regions (``image_id, raw_text``): sorted output
    symbols, their number, ``symbol:count:tier`` of each, and the verdict on all symbols found.  Images
    without a known symbol give empty lists.  Counts meet per (image, symbol) first, so an image's lists
    are bounded by the vocabulary."""
    every = tuple(dict.fromkeys([*vocab.HIGH_GATES, *vocab.MEDIUM_GATES, *vocab.LOW_GATES]))
    gate = T.normalize_gate_ocr(F.col("raw_text"))
    named = texts.select("image_id", gate.alias("gate")).select("image_id", F.when((F.length("gate") <= 20) & F.col("gate").isin(*every), F.col("gate")).alias("gate"))
    counts = named.groupBy("image_id", "gate").agg(F.count("*").alias("n"))
    found = counts.groupBy("image_id").agg(F.sort_array(F.collect_list(F.when(F.col("gate").isNotNull(), F.struct("gate", "n", T.gate_tier(F.col("gate")).alias("tier"))))).alias("all"))
    shown = F.filter("all", lambda s: s["gate"].isin(*vocab.OUTPUT_GATES))
    verdict = T.gate_validation(F.transform("all", lambda s: s["gate"]))
    out = found.select("image_id", F.transform(shown, lambda s: s["gate"]).alias("gates"), F.size(shown).cast("long").alias("gate_count"), F.transform(shown, lambda s: F.concat_ws(":", s["gate"], s["n"].cast("string"), s["tier"])).alias("tiers"), verdict.alias("v"))
    return out.select("image_id", "gates", "gate_count", "tiers", F.col("v.ok").alias("is_valid"), F.col("v.confidence").alias("confidence"), F.col("v.reason").alias("reason"))
