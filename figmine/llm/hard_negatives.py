"""Hard negatives by branch and bound over ball trees, one tree for each part of the rows.

Rows are dealt into parts of bounded size: by the nearest of a few pivot rows first, so that a part is a
ball as small as the data allow, then by hash, so that a hot cell is many parts.  A task builds the tree
of a part: a node has the centre and radius of its rows and their label, if they share one.  With centre c
and radius r, the inner product of a query q with any row below lies within ``q.c - |q| r`` and ``q.c + |q| r``.
A search goes down all queries at once and drops, at every node, the queries whose score window
lies outside these bounds, whose current k-th score lies strictly above the upper one, or that look for
another label.  It has two rounds: every anchor asks the part it lies in, and its k-th score there
goes with it to the other parts, where most of the tree is then below it.  Positives are searched in the
window of all scores, negatives in one window for each positive.

Defined cases: rows with a null id, label or vector, or with null or non-finite components (also after scaling),
take no part; rows that repeat an id count once, as the least of them by label, then vector; vectors of
different lengths are not compared; an anchor without positives, or a positive without negatives in
its window, has no rows; ties go to the smaller id; scores are exact, and held within the range of a long.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from figmine.llm.common import bound_batches, groups, stored
from figmine.llm.near_vectors import usable

POSITIVES = NEGATIVES = 5
#: rows of a tree and of a leaf, and bytes of a tree's vectors, about
TREE_ROWS, LEAF_ROWS, TREE_BYTES = 16384, 128, 64 << 20
PIVOTS = 256
#: root balls, and anchors, of a block
ROOTS, ASKED = 4096, 2048
#: anchors that go down a tree at once, with their windows
STRIP = 512
_EXACT, _LONG = 2.0**53, 2**63 - 1
_NONE = np.int64(-_LONG - 1)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact, held within the range of a long."""
    if not a.size or not b.size or a.shape[1] * np.abs(a).max() * np.abs(b).max() < _EXACT:
        return (a @ b.T).astype(np.int64)
    x, y = ([[int(v) for v in row] for row in m] for m in (a, b))
    return np.array([[max(-_LONG, min(_LONG, sum(map(int.__mul__, u, v)))) for v in y] for u in x], np.int64).reshape(len(a), len(b))


class BallTree:
    """Rows in order of the leaves; node i has rows ``start[i]:end[i]`` and children ``left[i]``, ``left[i] + 1``
    (0: a leaf).  ``own[i]``: the label of all its rows, where ``pure[i]``."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order, todo, at = np.arange(len(ids)), [(0, len(ids), 0)], 1
        nodes: dict[int, tuple] = {}
        while todo:
            a, z, me = todo.pop()
            x = vectors[order[a:z]]
            centre = x.mean(axis=0)
            away = np.sqrt(((x - centre) ** 2).sum(axis=1))
            kinds = labels[order[a:z]]
            left = 0
            if z - a > leaf_rows and away.max() > 0:
                # two rows far apart, and each half of the rows nearer to one than the other
                one = x[away.argmax()]
                two = x[((x - one) ** 2).sum(axis=1).argmax()]
                half = np.argsort(x @ (two - one), kind="stable")
                order[a:z] = order[a:z][half]
                middle, left, at = (a + z) // 2, at, at + 2
                todo += [(a, middle, left), (middle, z, left + 1)]
            nodes[me] = (a, z, left, centre, away.max(), kinds[0], (kinds == kinds[0]).all())
        start, end, left, centre, radius, own, pure = zip(*(nodes[i] for i in range(at)), strict=True)
        self.start, self.end, self.left, self.own = (np.array(c, np.int64) for c in (start, end, left, own))
        self.centre, self.radius, self.pure = np.stack(centre), np.array(radius, float), np.array(pure)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]

    def packed(self) -> bytes:
        out, parts = io.BytesIO(), dict(vars(self))
        v = parts["vectors"]
        if v.size and np.abs(v).max() < 1 << 15:
            parts["vectors"] = v.astype(np.int16)
        np.savez(out, **parts)
        return out.getvalue()

    @classmethod
    def unpacked(cls, raw: bytes) -> BallTree:
        tree = cls.__new__(cls)
        for k, v in np.load(io.BytesIO(raw)).items():
            setattr(tree, k, v.astype(np.float64) if k == "vectors" else v)
        return tree

    def search(self, q: Queries) -> int:
        """Fold this tree's rows into the best rows of ``q``; how many scores it computed."""
        size = np.sqrt((q.vector**2).sum(axis=1))
        todo, computed = [(0, np.arange(len(q.anchor)))], 0
        while todo:
            node, active = todo.pop()
            middle = q.vector[q.of[active]] @ self.centre[node]
            # what rounding can take from the bounds is far below this
            reach = size[q.of[active]] * self.radius[node] * (1 + 1e-9) + 1e-9 * (np.abs(middle) + size[q.of[active]] * np.abs(self.centre[node]).sum()) + 0.5
            # written so that bounds beyond the range of a double, which are not numbers, drop nothing
            open_ = ~((middle + reach < q.least[active]) | (middle - reach > q.most[active]))
            if self.pure[node]:
                open_ &= (q.label[q.of[active]] == self.own[node]) == q.same
            active = active[open_]
            if not len(active):
                continue
            if self.left[node]:
                # the half that promises more last, so that it is searched first
                a, b = self.left[node], self.left[node] + 1
                gain = float((q.vector[q.of[active]] @ (self.centre[b] - self.centre[a])).sum())
                todo += [(a, active), (b, active)] if gain >= 0 else [(b, active), (a, active)]
                continue
            a, z = self.start[node], self.end[node]
            asked, row = np.unique(q.of[active], return_inverse=True)
            score = inner(q.vector[asked], self.vectors[a:z])
            computed += score.size
            fits = ((q.label[asked][:, None] == self.labels[a:z][None, :]) == q.same) & (q.id[asked][:, None] != self.ids[a:z][None, :])
            q.fold(active, score[row], fits[row], self.ids[a:z])
        return computed


class Queries:
    """Anchors, and their windows: ``anchor`` and ``of`` give the window's place, ``low``, ``high`` its
    limits, ``score``, ``found`` its best rows so far, ``least`` the score below which nothing is wanted."""

    def __init__(self, ids, labels, vectors, of, low, high, floor, k: int, same: bool):
        self.id, self.label, self.vector, self.same, self.k = ids, labels, vectors, same, k
        self.of, self.anchor, self.low, self.most = of, ids[of], low, high
        self.least = np.maximum(low, floor)
        self.score, self.found = np.full((len(of), k), _NONE), np.zeros((len(of), k), np.int64)

    def fold(self, active, score, fits, ids) -> None:
        good = fits & (score >= self.least[active][:, None]) & (score <= self.most[active][:, None])
        some = good.any(axis=1)
        active, score, good = active[some], score[some], good[some]
        if not len(active):
            return
        all_scores = np.hstack([self.score[active], np.where(good, score, _NONE)])
        all_ids = np.hstack([self.found[active], np.broadcast_to(ids, score.shape)])
        # -score of the least long is itself: use the complement, which turns the order round
        best = np.lexsort((all_ids, ~all_scores), axis=1)[:, : self.k]
        self.score[active], self.found[active] = np.take_along_axis(all_scores, best, 1), np.take_along_axis(all_ids, best, 1)
        self.least[active] = np.maximum(self.least[active], self.score[active][:, -1])


def _parts(rows: DataFrame, tree_rows: int) -> DataFrame:
    """Rows with the part they lie in: ``dim, cell, salt``."""
    spark = rows.sparkSession
    n = rows.count()
    wanted = min(PIVOTS, max(1, n // tree_rows))
    picked = rows.select(F.xxhash64("vec_id").alias("h"), "vec_id", "vector").orderBy("h", "vec_id").limit(wanted).collect()
    pivots = {}
    for r in picked:
        pivots.setdefault(len(r["vector"]), []).append(r["vector"])
    shared = spark.sparkContext.broadcast({d: np.array(v, float).reshape(len(v), d) for d, v in pivots.items()})

    def cell(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int64)
            size = batch.column("dim").to_numpy()
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                if d in shared.value:
                    p = shared.value[d]
                    x = batch.column("vector").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)
                    scale = max(1.0, np.abs(x).max(initial=0), np.abs(p).max(initial=0))  # so that no square overflows
                    out[at] = ((x / scale) @ (p / scale).T * 2 - ((p / scale) ** 2).sum(axis=1)).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "cell"])

    dealt = stored(rows.mapInArrow(cell, "vec_id long, label long, vector array<double>, dim int, anchor boolean, cell long"), "cells")
    room = F.greatest(F.lit(1), F.least(F.lit(tree_rows), F.lit(TREE_BYTES) / (8 * F.greatest("dim", F.lit(1)))))
    sizes = dealt.groupBy("dim", "cell").agg(F.count("*").alias("held")).select(F.col("dim").alias("d"), F.col("cell").alias("c"), F.ceil(F.col("held") / room).alias("parts"))
    salted = dealt.join(sizes, (F.col("dim") == F.col("d")) & (F.col("cell") == F.col("c")))
    return salted.withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit("part")), "parts")).drop("d", "c", "parts")


_PART = ["dim", "cell", "salt"]


def _matrix(column, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dim)


def _trees(parts: DataFrame) -> DataFrame:
    """A row for each part: its tree, and the centre and radius of its root."""

    def run(batches):
        for t in groups(batches, _PART):
            dim, cell, salt = (t[c][0].as_py() for c in _PART)
            tree = BallTree(t["vec_id"].to_numpy(), t["label"].to_numpy(), _matrix(t["vector"], dim))
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([cell]), pa.array([salt]), pa.array([tree.packed()], pa.binary()), pa.array([tree.centre[0]], pa.list_(pa.float64())), pa.array([tree.radius[0]])], [*_PART, "tree", "centre", "radius"])

    ordered = parts.select(*_PART, "vec_id", "label", "vector").repartition(*_PART).sortWithinPartitions(*_PART, "vec_id")
    return ordered.mapInArrow(run, "dim int, cell long, salt long, tree binary, centre array<double>, radius double")


_ASKED = [*_PART, "vec_id", "label", "vector", "low", "high", "floor"]
_ASKED_TYPE = "dim int, cell long, salt long, vec_id long, label long, vector array<double>, low array<long>, high array<long>, floor array<long>"


def _search(asked: DataFrame, trees: DataFrame, k: int, same: bool) -> DataFrame:
    """``vec_id, window, found, score``: the best k rows of every window in the parts it is sent to."""
    side = trees.select(*_PART, *(F.lit(None).cast(t).alias(c) for c, t in (("vec_id", "long"), ("label", "long"), ("vector", "array<double>"), ("low", "array<long>"), ("high", "array<long>"), ("floor", "array<long>"))), "tree")
    both = side.unionByName(asked.select(*_ASKED, F.lit(None).cast("binary").alias("tree"))).withColumn("strip", F.when(F.col("tree").isNull(), F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))).otherwise(-1))

    def run(batches):
        place, tree, held = None, None, []

        def answer():
            t = pa.Table.from_batches(held)
            dim = t["dim"][0].as_py()
            many = np.array([len(x) for x in t["low"]])
            of = np.repeat(np.arange(t.num_rows), many)
            low, high, floor = (t[c].combine_chunks().flatten().to_numpy() for c in ("low", "high", "floor"))
            q = Queries(t["vec_id"].to_numpy(), t["label"].to_numpy(), _matrix(t["vector"], dim), of, low, high, floor, k, same)
            tree.search(q)
            i, j = np.nonzero(q.score != _NONE)
            window = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            return pa.RecordBatch.from_arrays([pa.array(q.anchor[i]), pa.array(window[i]), pa.array(q.found[i, j]), pa.array(q.score[i, j])], ["vec_id", "window", "found", "score"])

        for batch in batches:
            for a in range(0, batch.num_rows, STRIP):
                piece = batch.slice(a, STRIP)
                for t in groups([piece], _PART):
                    part = tuple(t[c][0].as_py() for c in _PART)
                    if held and (part != place or sum(h.num_rows for h in held) >= STRIP):
                        yield answer()
                        held = []
                    if part != place:
                        place, tree = part, None
                    rows = t
                    if t["tree"][0].is_valid:
                        tree, rows = BallTree.unpacked(t["tree"][0].as_py()), t.slice(1)
                    if rows.num_rows:
                        if tree is None:
                            raise RuntimeError("anchors came to a part without its tree")
                        held += rows.drop_columns(["tree"]).to_batches()
        if held:
            yield answer()

    ordered = both.repartition(*_PART).sortWithinPartitions(*_PART, "strip", "vec_id")
    return ordered.mapInArrow(run, "vec_id long, window long, found long, score long")


def _elsewhere(asked: DataFrame, trees: DataFrame) -> DataFrame:
    """Anchors sent to the parts other than their own whose root ball reaches their windows: blocks of anchors
    meet blocks of root balls."""
    blocks, chunks = (max(1, -(-t.count() // m)) for t, m in ((trees, ROOTS), (asked, ASKED)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    roots = trees.select(*_PART, "centre", "radius").withColumn("block", F.pmod(F.xxhash64(*_PART), F.lit(blocks)).cast("int")).withColumn("chunk", every(chunks))
    asked = asked.select(*_ASKED).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")).withColumn("block", every(blocks))
    both = roots.unionByName(asked, allowMissingColumns=True).withColumn("second", F.col("vec_id").isNotNull())
    keys = ["dim", "block", "chunk"]

    def run(batches):
        names, centre, radius, at = np.zeros((0, 2), np.int64), None, np.zeros(0), None
        for t in groups(batches, [*keys, "second"]):
            dim, place = t["dim"][0].as_py(), [t[k][0].as_py() for k in keys]
            if not t["second"][0].as_py():
                names, centre, radius, at = np.stack([t["cell"].to_numpy(), t["salt"].to_numpy()], axis=1), _matrix(t["centre"], dim), t["radius"].to_numpy(), place
                continue
            if at != place:
                continue  # no root of this block has the anchors' length
            x = _matrix(t["vector"], dim)
            middle, size = x @ centre.T, np.sqrt((x * x).sum(axis=1))[:, None]
            reach = size * radius * (1 + 1e-9) + 1e-9 * (np.abs(middle) + size * np.abs(centre).sum(axis=1)) + 0.5
            floor = np.array([min(map(max, a, b)) for a, b in zip(t["low"].to_pylist(), t["floor"].to_pylist(), strict=True)], float)
            high = np.array([max(a) for a in t["high"].to_pylist()], float)
            own = (t["cell"].to_numpy()[:, None] == names[:, 0]) & (t["salt"].to_numpy()[:, None] == names[:, 1])
            i, j = np.nonzero(~((middle + reach < floor[:, None]) | (middle - reach > high[:, None]) | own))
            for a in range(0, len(i), 1024):
                rows = t.select(_ASKED).take(pa.array(i[a : a + 1024])).combine_chunks()
                rows = rows.set_column(1, "cell", pa.array(names[j[a : a + 1024], 0])).set_column(2, "salt", pa.array(names[j[a : a + 1024], 1]))
                yield from rows.to_batches()

    ordered = both.select(*keys, "second", "centre", "radius", *_ASKED[1:]).repartition(*keys).sortWithinPartitions(*keys, "second")
    return ordered.mapInArrow(run, _ASKED_TYPE)


def _best(asked: DataFrame, trees: DataFrame, k: int, same: bool, name: str) -> DataFrame:
    """``vec_id, window, found, score, rank`` over all parts, in two rounds."""
    home = stored(_search(asked, trees, k, same), name)
    kth = home.groupBy("vec_id", "window").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k).groupBy("vec_id").agg(F.map_from_entries(F.collect_list(F.struct("window", "kth"))).alias("kths")).withColumnRenamed("vec_id", "of")
    further = asked.join(kth, F.col("vec_id") == F.col("of"), "left").withColumn("floor", F.expr("transform(floor, (x, i) -> coalesce(try_element_at(kths, cast(i as bigint)), x))"))
    far = _search(_elsewhere(further, trees), trees, k, same)
    ranks = F.row_number().over(W.partitionBy("vec_id", "window").orderBy(F.desc("score"), "found"))
    return stored(home.unionByName(far).withColumn("rank", ranks).where(F.col("rank") <= k), name)


def hard_negatives(rows: DataFrame, anchor, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = 80, high: int = 100, scale: float = 256, vec_id: str = "vec_id", vector: str = "embedding", label=None, tree_rows: int = TREE_ROWS) -> DataFrame:
    """For every row where ``anchor`` (a condition) holds, its first ``n_positives`` other rows of its label by inner product of
    the components' ``floor(scale * x)``, and for each of these the first ``n_negatives`` rows of another label
    whose score lies within ``low`` and ``high`` hundredths of the positive's: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score."""
    bound_batches(rows.sparkSession)
    label = F.col("label") if label is None else label
    base = rows.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("raw"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    base = base.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull() & F.coalesce(finite, F.lit(False)))
    # one row an id; floor() of Spark ends at the range of a long, so whole numbers beyond it stay as they are
    whole = F.transform("raw", lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale))
    one = base.groupBy("vec_id").agg(F.min(F.struct("label", "raw", "anchor")).alias("r")).select("vec_id", "r.label", "r.anchor", F.col("r.raw").alias("raw"))
    one = stored(one.select("vec_id", "label", whole.alias("vector"), F.size("raw").alias("dim"), "anchor"), "rows")
    parts = _parts(one, tree_rows)
    trees = stored(_trees(parts), "trees")
    lowest, highest = F.lit(-_LONG), F.lit(_LONG)
    anchors = stored(parts.where("anchor").select(*_PART, "vec_id", "label", "vector"), "anchors")
    asked = anchors.withColumns({"low": F.array(lowest), "high": F.array(highest), "floor": F.array(lowest)})
    positive = _best(asked, trees, n_positives, True, "positives")
    # ceil(low * p / 100) and floor(high * p / 100) in whole numbers
    least, most = (F.expr(f"cast({e} as bigint)") for e in (f"ceil(cast(score as decimal(20, 0)) * {low} / 100)", f"floor(cast(score as decimal(20, 0)) * {high} / 100)"))
    windows = positive.withColumns({"least": least, "most": most}).groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("rank", "least", "most"))).alias("w")).withColumnRenamed("vec_id", "of")
    asked = anchors.join(windows, F.col("vec_id") == F.col("of")).withColumns({"low": F.col("w.least"), "high": F.col("w.most"), "floor": F.transform("w", lambda x: lowest)})
    negative = _best(asked.select(*_ASKED), trees, n_negatives, False, "negatives")
    named = positive.select(F.col("vec_id").alias("anchor_id"), (F.col("rank") - 1).alias("w"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    out = negative.join(named, (F.col("vec_id") == F.col("anchor_id")) & (F.col("window") == F.col("w")))
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
