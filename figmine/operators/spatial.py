"""Spatial joins within pages: boxes meet in the cells of grids, one grid a size class.

A box belongs to the grid whose cells are the smallest power of two not below its longer side, so it touches
four cells at most.  It is the owner there, and a guest in every coarser grid that its page uses.  Two boxes
meet in the grid of the larger one, so small boxes are never compared because a large cell holds both, and a
pair counts only in the cell of the lower corner of its overlap.  Only crowded pages are dealt out this way;
which these are is counted and written first.  The others, most of the time all, cost one equi-join on the page.

Boxes with null, non-finite or reversed sides meet nothing.  Column names that start with ``__`` are ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figmine.sinks.shared import shared_path

SIDES = ("x0", "y0", "x1", "y1")
#: pages of more boxes are crowded
FEW = 256
#: so many crowded pages, with the exponents of their grids, are broadcast; more are joined by shuffles
BROADCAST = 50_000
#: exponents of the cells of boxes without extent, and of the widest that a double holds
POINT, WIDEST = -20, 1023


def _sound(box: tuple[str, ...]) -> Column:
    x0, y0, x1, y1 = (F.col(c) for c in box)
    sound = (x0 <= x1) & (y0 <= y1)
    for c in (x0, y0, x1, y1):
        sound &= F.abs(c) < float("inf")
    return F.coalesce(sound, F.lit(False))


def _graded(df: DataFrame, keys: list[str], box: tuple[str, ...]) -> DataFrame:
    """Thin rows of the sound boxes: keys, the box as a struct, and the exponent of its grid."""
    x0, y0, x1, y1 = (F.col(c) for c in box)
    grade = F.least(F.greatest(F.ceil(F.log2(F.greatest(x1 - x0, y1 - y0))), F.lit(POINT)), F.lit(WIDEST))
    return df.where(_sound(box)).select(*keys, F.struct(*(F.col(c).cast("double").alias(s) for c, s in zip(box, SIDES, strict=True))).alias("__box"), grade.cast("int").alias("__grade"))


def _crowded(rows: DataFrame, keys: list[str], few: int) -> DataFrame | None:
    """The crowded pages with the exponents of their boxes, or None where no page is crowded."""
    path = shared_path(rows.sparkSession, "crowded")
    counted = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.collect_set("__grade").alias("__grids"))
    counted.where(F.col("__n") > few).drop("__n").write.parquet(path)
    crowded = rows.sparkSession.read.parquet(path)
    pages = crowded.count()
    return (F.broadcast(crowded) if pages <= BROADCAST else crowded) if pages else None


def _cell(x: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), F.col("__grid")))


def _owners(rows: DataFrame) -> DataFrame:
    """A row for every cell that a box touches in its own grid."""
    b = F.col("__box")
    placed = rows.withColumn("__grid", F.col("__grade")).withColumn("__cx", F.explode(F.sequence(_cell(b["x0"]), _cell(b["x1"]))))
    return placed.withColumn("__cy", F.explode(F.sequence(_cell(b["y0"]), _cell(b["y1"])))).drop("__grids")


def _guests(rows: DataFrame, corner: bool) -> DataFrame:
    """A row for every cell that a box, or its lower corner, touches in its own grid and the coarser ones."""
    b = F.col("__box")
    placed = rows.withColumn("__grid", F.explode(F.filter("__grids", lambda g: g >= F.col("__grade")))).drop("__grids")
    if corner:
        return placed.withColumn("__cx", _cell(b["x0"])).withColumn("__cy", _cell(b["y0"]))
    return placed.withColumn("__cx", F.explode(F.sequence(_cell(b["x0"]), _cell(b["x1"])))).withColumn("__cy", F.explode(F.sequence(_cell(b["y0"]), _cell(b["y1"]))))


def _meeting(owners: DataFrame, guests: DataFrame, keys: list[str], condition: Column, how: str) -> DataFrame:
    """Guests beside the owners of their cell: ``o`` and ``g`` hold the boxes, ``og`` and ``gg`` the grids."""
    at = [*keys, "__grid", "__cx", "__cy"]
    o = owners.select(*(F.col(c).alias(f"__o{i}") for i, c in enumerate(at)), F.col("__box").alias("o"), F.col("__grade").alias("og"))
    g = guests.withColumnsRenamed({"__box": "g", "__grade": "gg"})
    for i, c in enumerate(at):
        condition &= F.col(c) == F.col(f"__o{i}")
    return g.join(o, condition, how)


def overlapping_pairs(df: DataFrame, keys: list[str], box: tuple[str, ...] = SIDES, few: int = FEW) -> DataFrame:
    """``keys, a, b``: each two different boxes with equal keys whose overlap has an area, ``a`` before ``b``.

    Rows that repeat a box pair with others as often as they occur, never with each other; null keys meet
    nothing; an empty table has no pairs."""
    rows = _graded(df, keys, box)
    crowded = _crowded(rows, keys, few)
    o, g = F.col("o"), F.col("g")
    later, lower = F.greatest(o["x0"], g["x0"]), F.greatest(o["y0"], g["y0"])
    overlap = (F.least(o["x1"], g["x1"]) > later) & (F.least(o["y1"], g["y1"]) > lower)
    calm = (rows.join(crowded, keys, "left_anti") if crowded else rows).drop("__grade")
    pairs = calm.withColumnRenamed("__box", "o").join(calm.withColumnRenamed("__box", "g"), keys).where((o < g) & overlap).select(*keys, o.alias("a"), g.alias("b"))
    if not crowded:
        return pairs
    dense = rows.join(crowded, keys)
    once = (F.col("gg") < F.col("og")) | ((F.col("gg") == F.col("og")) & (g < o))
    here = (_cell(later) == F.col("__cx")) & (_cell(lower) == F.col("__cy"))
    met = _meeting(_owners(dense), _guests(dense, corner=False), keys, once & overlap & here, "inner")
    return pairs.unionByName(met.select(*keys, F.least(o, g).alias("a"), F.greatest(o, g).alias("b")))


def without_nested(df: DataFrame, keys: list[str], box: tuple[str, ...] = SIDES, few: int = FEW) -> DataFrame:
    """The rows whose box lies strictly inside no other box with equal keys; all columns stay.

    A box that contains another has the longer side, and holds the other's lower corner.  Equal boxes stay
    together, boxes that meet nothing stay."""
    rows = _graded(df, keys, box)
    crowded = _crowded(rows, keys, few)
    o, g = F.col("o"), F.col("g")
    inside = lambda a: (o["x0"] < a[0]) & (o["y0"] < a[1]) & (o["x1"] > a[2]) & (o["y1"] > a[3])
    names = [f"__k{i}" for i in range(len(keys))]
    same = F.lit(True)
    for c, n in zip(keys, names, strict=True):
        same &= F.col(c) == F.col(n)
    own = [F.col(c).alias(n) for c, n in zip(keys, names, strict=True)]
    calm = df.join(crowded, keys, "left_anti") if crowded else df
    outer = (rows.join(crowded, keys, "left_anti") if crowded else rows).select(*own, F.col("__box").alias("o"))
    kept = calm.join(outer, same & _sound(box) & inside([F.col(c) for c in box]), "left_anti")
    if not crowded:
        return kept
    dense = rows.distinct().join(crowded, keys)
    nested = _meeting(_owners(dense), _guests(dense, corner=True), keys, inside([g[s] for s in SIDES]), "left_semi")
    gone = nested.select(*own, *(g[s].alias(f"__{s}") for s in SIDES)).distinct()
    for c, s in zip(box, SIDES, strict=True):
        same &= F.col(c) == F.col(f"__{s}")
    return kept.unionByName(df.join(crowded, keys, "left_semi").join(gone, same, "left_anti"))
