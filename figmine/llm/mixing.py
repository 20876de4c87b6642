"""Mixing sources to target weights by the cube method.

A source's ratio r = target / size gives every document floor(r) whole copies and one more with
probability r - floor(r).  The extra copies are drawn by balanced sampling: the vector of inclusion
probabilities moves along directions in the null space of the constraints (document count and token
total) until every entry is 0 or 1.  Three documents at a time have such a direction in closed form.

The flight runs in groups of about ``group_docs`` documents of one source, dealt by a hash of the id;
at most two documents of a group stay fractional, and these meet again in larger groups, level by
level, until one group per source is left, whose last two documents land on the nearest token total.
Group seeds come from source rank, bucket and level, so reruns agree.

Defined cases: null texts have size 0 and take 0; a null source is a source of its own, ranked last;
an empty table gives an empty result; repeated rows, and rows with a null id, are separate documents, dealt
by id and text; ``mixed`` replaces columns named like an output.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from figmine.llm.common import bound_batches, fresh, stored
from figmine.llm.kernels import BLANK, Words, text_slices

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
GROUP_DOCS = 4096
FAN_IN = 1024
_EPS = 1e-9


def document_sizes(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (doc_id, source) with ``mix`` (a hash of id and text, by which rows are dealt) and
    ``size``, the words of each text."""
    kept = ["doc_id", "source"] if carry is None else carry
    mix, size = ("mix", "size") if carry is None else (fresh(docs, "mix"), fresh(docs, "size"))

    def run(batches):
        for batch in batches:
            counts = [Words(data, offsets, BLANK, False).counts for _, _, data, offsets in text_slices(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))], [*kept, mix, size])

    bound_batches(docs.sparkSession)
    asked = docs.select(*kept, F.xxhash64("doc_id", "text").alias(mix), F.col("text").alias(fresh(docs, "text")))
    schema = T.StructType([docs.schema[c] for c in kept]).add(mix, "long").add(size, "long")
    return asked.mapInArrow(run, schema)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``rank, name, n_docs, source_size, target`` per source; each round fixes sources at their cap
    and shares the rest anew by weight, as aggregates over the table of sources."""
    spark = sizes.sparkSession
    sources = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    kind = sizes.schema["source"].dataType.simpleString()
    ranked = spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (x[1], *x[0])), f"rank long, name {kind}, n_docs long, source_size long")
    cases = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", cases), "sources")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, fixed = 0.0, -1
    while True:
        above = F.col("weight") * level > F.col("source_size") * cap
        n, held, free = ranked.agg(F.coalesce(F.sum(above.cast("int")), F.lit(0)), F.coalesce(F.sum(F.when(above, F.col("source_size") * cap)), F.lit(0.0)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == fixed or not free:
            break
        fixed, level = n, (total - held) / free
    return ranked.withColumn("target", F.least(F.col("source_size") * cap, F.col("weight") * level)).drop("weight")


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities to 0 or 1, balanced on count and size; at most two stay fractional."""
    p = p.astype(float).copy()
    queue = np.flatnonzero((p > _EPS) & (p < 1 - _EPS)).tolist()
    draws = iter(rng.random(len(queue)).tolist())
    active, at = queue[:3], 3
    while len(active) == 3:
        a, b, c = (float(size[i]) for i in active)
        u = (c - b, a - c, b - a)
        if not any(u):
            u = (1.0, -1.0, 0.0)
        q = [float(p[i]) for i in active]
        up = min((1 - x) / d if d > 0 else x / -d for x, d in zip(q, u, strict=True) if d)
        down = min(x / d if d > 0 else (1 - x) / -d for x, d in zip(q, u, strict=True) if d)
        move = up if next(draws) * (up + down) < down else -down
        left = []
        for i, x, d in zip(active, q, u, strict=True):
            x += move * d
            p[i] = 0.0 if x < _EPS else 1.0 if x > 1 - _EPS else x
            if 0 < p[i] < 1:
                left.append(i)
        need = 3 - len(left)  # at least one: the step ends on a face of the cube
        active = left + queue[at : at + need]
        at += need
    return p


#: open documents of a source that wait for the landing
LANDING = 14


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the few fractional entries so that the token total, then the count, is nearest."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if not len(open_):
        return p
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))[::-1]) & 1
    tokens, count = np.abs(ways @ size[open_] - p[open_] @ size[open_]), np.abs(ways.sum(axis=1) - p[open_].sum())
    out = p.copy()
    out[open_] = ways[np.lexsort((np.round(count, 6), np.round(tokens, 6)))[0]]
    return out


def last_flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The flight that ends a source.  A few documents wait for the landing, so that what the flight leaves open
    can be made up for: a ladder of sizes, each half of the one before if there is such a one, then the smallest."""
    order = np.argsort(-size, kind="stable")
    open_ = order[(p[order] > _EPS) & (p[order] < 1 - _EPS)]
    ladder, left = [], open_
    while len(left) and len(ladder) < LANDING - 3:
        half = np.flatnonzero(2 * size[left] >= (size[ladder[-1]] if ladder else 2 * size[left[0]]))
        at = int(half[-1]) if len(half) else 0
        ladder.append(int(left[at]))
        left = left[at + 1 :]
    rest = open_[~np.isin(open_, ladder)]
    flown = rest[: max(0, len(rest) - (LANDING - len(ladder)))]
    out = p.astype(float).copy()
    out[flown] = flight(p[flown], size[flown], rng)
    return land(out, size)


_ROW = "row long, rank long, mix long, bucket long, size long, p double"
_COLUMNS = ["row", "rank", "mix", "bucket", "size", "p"]


def _level(rows: DataFrame, level: int, last: bool) -> DataFrame:
    def solve(table: pa.Table):
        p, size = table["p"].to_numpy(), table["size"].to_numpy()
        key = [int(table[c][0].as_py()) for c in ("rank", "bucket")]
        p = (last_flight if last else flight)(p, size, np.random.default_rng([7, level, *key]))
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p)).select(_COLUMNS)

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            group = np.stack([table[c].to_numpy() for c in ("rank", "bucket")])
            cut = np.flatnonzero(np.append(True, (group[:, 1:] != group[:, :-1]).any(axis=0))).tolist() if table.num_rows else []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                yield from solve(table.slice(a, b - a)).to_batches()
            rest = table.slice(cut[-1]) if cut else None
        if rest is not None and rest.num_rows:
            yield from solve(rest).to_batches()

    # rows that tie in hash and size are equal rows: which of them is drawn makes no difference
    dealt = rows.select(*_COLUMNS).repartition("rank", "bucket").sortWithinPartitions("rank", "bucket", "mix", "size", "row")
    return dealt.mapInArrow(run, _ROW)


def _copies(sizes: DataFrame, weights, share: float, cap: float, group_docs: int) -> DataFrame:
    """``row, size, source_size, target, taken`` of every row of ``sizes`` (row, source, mix, size)."""
    targets = source_targets(sizes, weights, share, cap)
    known = targets.withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    known = known.withColumn("whole", F.floor(F.col("ratio") + _EPS)).withColumn("p", F.greatest(F.lit(0.0), F.col("ratio") - F.col("whole"))).withColumn("p", F.when(F.col("p") < _EPS, 0.0).otherwise(F.col("p")))
    known = known.withColumn("n_groups", F.ceil(F.col("n_docs") / group_docs))
    rows = sizes.join(known, sizes["source"].eqNullSafe(known["name"]))
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    groups = max(1, math.ceil(most / group_docs))
    current = rows.select("row", "rank", "mix", F.pmod("mix", "n_groups").alias("bucket"), "size", "p")
    done, level = [], 0
    while True:
        last = groups == 1
        made = stored(_level(current, level, last), "flight")
        done.append(made if last else made.where("p = 0 or p = 1"))
        if last:
            break
        current = made.where("p > 0 and p < 1").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
        groups, level = math.ceil(groups / FAN_IN), level + 1
    chosen = done[0]
    for d in done[1:]:
        chosen = chosen.unionByName(d)
    brief = known.select("rank", "source_size", "target", "whole")
    taken = (F.col("size") * (F.col("whole") + F.col("p").cast("long"))).cast("long")
    return chosen.join(brief, "rank").select("row", "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Per document: size, source_size, target (its source's) and taken words."""
    sizes = stored(document_sizes(docs).withColumn("row", F.monotonically_increasing_id()), "sizes")
    taken = _copies(sizes, weights, share, cap, group_docs).withColumnRenamed("row", "taken_row")
    return sizes.select("doc_id", "row").join(taken, F.col("row") == F.col("taken_row")).select("doc_id", "size", "source_size", "target", "taken")


OUTPUTS = ("size", "source_size", "target", "taken")


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, group_docs: int = GROUP_DOCS) -> DataFrame:
    """``docs``, row by row, with size, source_size, target and taken words; columns of these names are
    replaced.  Rows are known by a key that is made once and stored with them."""
    kept = docs.select(*[c for c in docs.columns if c.lower() not in OUTPUTS])
    row, key = fresh(docs, "row"), fresh(docs, "key")
    keyed = stored(kept.withColumn(row, F.monotonically_increasing_id()), "rows")
    inner = keyed.select("doc_id", "source", "text", F.col(row).alias("row"))
    sizes = document_sizes(inner, ["row", "source"])
    sizes = stored(sizes.toDF("row", "source", "mix", "size"), "sizes")
    taken = _copies(sizes, weights, share, cap, group_docs).withColumnRenamed("row", key)
    return keyed.join(taken, F.col(row) == F.col(key)).drop(row, key)
