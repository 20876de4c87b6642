"""Near duplicates among embeddings: int8 tile products with rigorous error bounds.

Equal vectors of one label are one class, counted and compared once.  The classes of a label (and length)
are dealt into blocks; each block is written once, with every unit vector quantised to int8 codes, the
scale of the codes and the measured length of what the codes leave out.  A tile is the product of two
blocks' codes, exact in integers.  The cosine lies within ``|x'| e + e' |y| + e e`` of the scaled product,
where x' is the coded vector and e the length of what it leaves out: pairs whose bound stays below the threshold
go, pairs whose lower bound reaches it are linked, and only the others are computed again in double precision.
A tile returns the number of links of each vector and a spanning forest, never its pairs.

Defined cases: rows with a null label, id or vector, and vectors that are empty, zero or hold null or non-finite
components, link with nothing; vectors of different lengths are not compared; rows that repeat an id are
vectors of their own, each with its own links, and carry the component of their own vector; a null id gives a null component,
not kept.  A vector is known by 128 bits of its label and components.  Columns other than the three are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figmine.llm.common import bound_batches, groups, stored, to_bytes
from figmine.llm.components import components, forest

THRESHOLD = 0.93
#: rows of a block: 16 roots of the label's vectors within these limits, and at most so many bytes
LEAST_ROWS, MOST_ROWS, BLOCK_BYTES = 1024, 8192, 16 << 20
#: pairs of a strip of a tile: bounds the memory of a task
STRIP = 1 << 20
#: dimensions whose int8 products float32 adds exactly (127 * 127 * 1024 < 2^24)
EXACT = 1024
#: rounding of the bounds themselves, far above what doubles of unit vectors lose
SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, of any magnitude."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scale, length of the coded vector and of its error, for rows of unit vectors."""
    scale = np.abs(u).max(axis=1) / 127
    codes = np.rint(u / scale[:, None])
    coded = codes * scale[:, None]
    error = np.sqrt(((u - coded) ** 2).sum(axis=1)) + SLACK / 8
    return codes.astype(np.int8), scale, np.sqrt((coded * coded).sum(axis=1)), error


class Block:
    """Rows of one block, as packed in ``payload``."""

    def __init__(self, row: dict):
        self.node = np.frombuffer(row["nodes"], np.int64)
        self.weight = np.frombuffer(row["weights"], np.int64)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(len(self.node), -1)
        self.scale, self.length, self.error = np.frombuffer(row["bounds"]).reshape(3, -1)
        self.full = np.frombuffer(row["vectors"], row["kind"]).reshape(len(self.node), -1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of two blocks of codes."""
    if a.shape[1] <= EXACT:
        return a.astype(np.float32) @ b.astype(np.float32).T
    return sum((_product(a[:, i : i + EXACT], b[:, i : i + EXACT]).astype(np.float64) for i in range(0, a.shape[1], EXACT)), 0.0)


def _exact(x: Block, y: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of pairs in double precision."""
    step, out = max(1, (4 << 20) // (8 * x.codes.shape[1])), np.empty(len(i))
    for a in range(0, len(i), step):
        out[a : a + step] = np.einsum("ij,ij->i", unit(x.full[i[a : a + step]]), unit(y.full[j[a : a + step]]))
    return out


def tile_links(x: Block, y: Block, threshold: float):
    """Strips of linked pairs ``(i, j, pairs computed again)`` of two blocks; of one block with itself, i < j."""
    same, step = x is y, max(1, STRIP // len(y.node))
    widest = y.scale.max()
    for a in range(0, len(x.node), step):
        z = min(len(x.node), a + step)
        g = _product(x.codes[a:z], y.codes)
        # no scale of y is wider, no error larger: a sure lower limit of the product, by row
        slack = x.length[a:z] * y.error.max() + x.error[a:z] * (y.length.max() + y.error.max()) + SLACK
        least = (threshold - slack) / (x.scale[a:z] * widest)
        i, j = np.nonzero(g >= np.where(least > 0, least * (1 - 1e-6), -np.inf)[:, None])
        value = g[i, j].astype(np.float64)
        i = i + a
        if same:
            i, j, value = (c[i < j] for c in (i, j, value))
        near = value * x.scale[i] * y.scale[j]
        bound = x.length[i] * y.error[j] + x.error[i] * (y.length[j] + y.error[j]) + SLACK
        i, j, low = (c[near + bound >= threshold] for c in (i, j, near - bound))
        open_ = np.flatnonzero(low < threshold)
        linked = np.ones(len(i), bool)
        linked[open_] = _exact(x, y, i[open_], j[open_]) >= threshold
        yield i[linked], j[linked], len(open_)


def usable(vector, *known) -> F.Column:
    """Whether the keys are known and the vector is finite and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    out = vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    for k in known:
        out = k.isNotNull() & out
    return out


def _blocks(classes: DataFrame, kind: str) -> DataFrame:
    """One row a block: its classes, quantised."""
    label = classes.groupBy("label", "dim").agg(F.count("*").alias("m")).withColumnsRenamed({"label": "of", "dim": "wide"})
    rows = F.least(F.greatest(F.lit(LEAST_ROWS), F.least(F.lit(MOST_ROWS), 16 * F.sqrt("m"))), F.greatest(F.lit(1), F.lit(BLOCK_BYTES) / (9 * F.col("wide") + 40)))
    label = label.select("of", "wide", F.ceil(F.col("m") / rows).alias("n_blocks"))
    dealt = classes.join(label, (F.col("label") == F.col("of")) & (F.col("dim") == F.col("wide"))).withColumn("block", F.pmod(F.xxhash64("node"), "n_blocks"))
    keys = ["label", "dim", "block"]

    def run(batches):
        for t in groups(batches, keys):
            full = t["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
            codes, *bounds = quantised(unit(full))
            row = {k: [t[k][0].as_py()] for k in (*keys, "n_blocks")} | {"kind": [full.dtype.str], "nodes": [to_bytes(t["node"].to_numpy())], "weights": [to_bytes(t["copies"].to_numpy())]}
            row |= {"codes": [to_bytes(codes)], "bounds": [to_bytes(np.stack(bounds))], "vectors": [to_bytes(full)]}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, schema.field(k).type) for k, v in row.items()})

    schema = pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("block", pa.int64()), ("n_blocks", pa.int64()), ("kind", pa.string()), *((c, pa.binary()) for c in ("nodes", "weights", "codes", "bounds", "vectors"))])
    ordered = dealt.select(*keys, "n_blocks", "node", "copies", "vector").repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, "label long, dim int, block long, n_blocks long, kind string, nodes binary, weights binary, codes binary, bounds binary, vectors binary")


def _links(blocks: DataFrame, threshold: float) -> DataFrame:
    """``a, n`` (links of class a) and ``a, b`` (spanning forests) of all tiles, and pairs computed again as ``again``."""
    tiles = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    keys = ["label", "dim", "i", "j"]

    def run(batches):
        for t in groups(batches, keys):
            side = sorted(t.to_pylist(), key=lambda r: r["block"])
            x, y = Block(side[0]), Block(side[-1])
            if len(side) == 1:
                y = x
            n, again, edges = (np.zeros(len(x.node), np.int64), np.zeros(len(y.node), np.int64)), 0, [(np.zeros(0, np.int64),) * 2]
            for i, j, c in tile_links(x, y, threshold):
                n[0][:] += np.bincount(i, y.weight[j], len(x.node)).astype(np.int64)
                n[1][:] += np.bincount(j, x.weight[i], len(y.node)).astype(np.int64)
                again += c
                edges.append(forest(x.node[i], y.node[j]))
                if sum(len(e[0]) for e in edges) > 4 * MOST_ROWS:
                    edges = [forest(*(np.concatenate(e) for e in zip(*edges, strict=True)))]
            a, b = forest(*(np.concatenate(e) for e in zip(*edges, strict=True)))
            node, count = np.concatenate([x.node, y.node]), np.concatenate(n)
            node, count = node[count > 0], count[count > 0]
            nothing = lambda k: pa.nulls(k, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([node, a, [0]])), pa.concat_arrays([nothing(len(node)), pa.array(b), nothing(1)]), pa.concat_arrays([pa.array(count), nothing(len(a) + 1)]), pa.concat_arrays([nothing(len(node) + len(a)), pa.array([again])])], ["a", "b", "n", "again"])

    dealt = tiles.drop("other", "n_blocks").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a long, b long, n long, again long")


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, n_links (other vectors of the label with a cosine of at least ``threshold``),
    component_id and kept.  ``threshold`` is above 0; labels and ids are integers."""
    bound_batches(rows.sparkSession)
    kind = "float" if rows.schema[vector].dataType.elementType.simpleString() == "float" else "double"
    base = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast(f"array<{kind}>").alias("vector"))
    good = usable(F.col("vector"), F.col("vec_id"), F.col("label"))
    prints = [F.xxhash64("label", "vector"), F.xxhash64(F.lit("second"), "vector", "label")]
    base = base.withColumns({"good": good, "p": F.when(good, prints[0]), "q": F.when(good, prints[1])})
    classes = base.where("good").groupBy("p", "q").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    # numbers are written once and never made again
    classes = stored(classes.withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("vector")}), "classes")
    links = stored(_links(stored(_blocks(classes, kind), "blocks"), threshold), "links")
    counts = links.where("n is not null").groupBy(F.col("a").alias("counted")).agg(F.sum("n").alias("n"))
    joined = components(links.where("b is not null").select("a", "b"))
    known = classes.drop("vector").join(counts, F.col("node") == F.col("counted"), "left").join(joined.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    known = known.select("p", "q", "low", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "node").alias("root"))
    least = known.groupBy("root").agg(F.min("low").alias("least")).withColumnRenamed("root", "part")
    known = known.join(least, F.col("root") == F.col("part")).select(F.col("p").alias("kp"), F.col("q").alias("kq"), "links", "least")
    out = base.select("vec_id", "p", "q").join(known, (F.col("p") == F.col("kp")) & (F.col("q") == F.col("kq")), "left")
    component = F.coalesce("least", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def without_near_vectors(rows: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """The rows that are kept, with all their columns: of each component those with its smallest id, and rows
    with a null id.  Rows that repeat an id stay or go by the id: it stays if one of them is kept."""
    kept = near_vectors(rows, threshold, vec_id, vector, label).where("kept").select(F.col("vec_id").alias("kept_id")).distinct()
    ids = rows[vec_id]
    return rows.where(ids.isNull()).unionByName(rows.join(kept, ids.cast("long") == kept["kept_id"], "left_semi"))
