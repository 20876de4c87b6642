"""Exact n-gram Jaccard join as a blocked sparse matrix product.

Documents with the same set of shingles are one row of the incidence matrix (a class), so copies cost
nothing.  Columns of the matrix are cut into blocks: for sets of a size level, the universe of
shingles is divided into K blocks by hash, with K above the largest symmetric difference D that two
linked sets of that level can have.  By the pigeonhole principle linked sets disagree on D blocks at
most, so they agree on all the others.  A class with fewer shared non-empty blocks than that bound is
linked with nothing and goes; classes are multiplied only where a block's content is equal, and all
other pairs are below the size-derived bound and never looked at.  A set with too many empty blocks is
divided anew by further seeds, so that empty blocks need not count.

Classes that still meet in a block form candidate clusters.  A cluster's rows are multiplied in blocks of
about ``block_rows`` rows (fewer, where rows are long): overlap counts are accumulated from the sparse
incidence, column block by column block, and after each one every pair whose count cannot reach the overlap
that its two sizes demand any more is discarded; rows without a pair left go.  A link needs
``100 * overlap >= percent * union``.  Large clusters are multiplied in two rounds: every row against
its own block and the cluster's first block, then only rows outside the largest component found
against the others.  Pairs already in one component are skipped: they cannot change the result.

A class is known by 126 bits: a 63-bit key, and a second one that tells sets apart whose keys are equal
(``key_conflicts``).  Shingles are compared by 64-bit hashes within a pair.

Defined cases: documents without words (null, empty, blank) have an empty set and are linked with
nothing; fewer words than ``n`` make one shingle; repeated rows of one id count as copies; rows with a
null id get a null component and link nothing; ids are integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from figmine.llm.common import blobs, bound_batches, n_buckets, stored, to_bytes
from figmine.llm.components import components, forest
from figmine.llm.kernels import BLANK, Words, mix64, text_slices, window_hashes

SHINGLE = 3
PERCENT = 90
#: rows of a block, at least; blocks of large clusters have half the square root of the cluster's rows
BLOCK_ROWS = 32
#: shingles of a block of rows, about: bounds the memory of a task where rows are long
BLOCK_SHINGLES = 4_000_000
COLUMN_BLOCK = 4096
_PIECE = 1 << 20
_U = np.uint64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, with the limits of the rows."""
    w = Words(data, offsets, BLANK, True)
    h = window_hashes(w.hash, n)
    ok = w.row[: len(h)] == w.row[n - 1 :] if len(h) else np.zeros(0, bool)
    rows, h = w.row[: len(h)][ok], h[ok]
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(short):
        few = np.array([window_hashes(w.hash[w.first[r] : w.first[r + 1]], int(w.counts[r]))[0] for r in short], _U) + w.counts[short].astype(_U)
        rows, h = np.concatenate([rows, short]), np.concatenate([h, few])
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    rows, h = rows[new], h[new]
    return h, np.searchsorted(rows, np.arange(len(offsets)))


_RESOLVED = _U(1 << 62)


def set_keys(h: np.ndarray, limits: np.ndarray, conflicts: np.ndarray | None = None, bits: int = 62) -> tuple[np.ndarray, np.ndarray]:
    """Two keys of each set (sums of mixed hashes with the size); 0 for empty sets.  Sets whose first key
    is among ``conflicts`` get one made from the second."""
    size = np.diff(limits)
    full = np.flatnonzero(size)
    out = []
    for salt in (0x51ED2701, 0x2545F4914F6CDD1D):
        total = np.zeros(len(size), _U)
        if len(full):
            total[full] = np.add.reduceat(mix64(h ^ _U(salt)), limits[full])
        key = np.maximum(mix64(total + size.astype(_U) * _U(0x9E3779B97F4A7C15)) & _U((1 << (bits if salt == 0x51ED2701 else 62)) - 1), _U(1))
        key[size == 0] = 0
        out.append(key)
    first, second = out
    if conflicts is not None and len(conflicts):
        clash = np.isin(first, conflicts.astype(_U))
        first = np.where(clash, second | _RESOLVED, first)
    return first.astype(np.int64), second.astype(np.int64)


def size_levels(largest: int, percent: int) -> np.ndarray:
    """First sizes of the levels: linked sets lie in one level or in neighbours."""
    out = [1]
    while out[-1] <= largest:
        out.append(out[-1] * 100 // percent + 1)
    out.append(out[-1] * 100 // percent + 1)
    out.append(out[-1] * 100 // percent + 1)
    return np.array(out, np.int64)


#: independent divisions of the universe tried for a set whose non-empty blocks are too few
SEEDS = 5


class Sheets:
    """Block contents of sets: a sheet is one set divided at one level by one seed.  ``key``, ``tag``
    (level and seed) and ``need`` by sheet; ``signature`` and ``sheet`` by non-empty block."""

    def __init__(self, h: np.ndarray, limits: np.ndarray, keys: np.ndarray, percent: int):
        size = np.diff(limits)
        full = np.flatnonzero(size)
        _, one = np.unique(keys[full], return_index=True)  # a class once
        full = full[np.sort(one)]
        levels = size_levels(int(size.max(initial=1)), percent)
        self.parts: list[tuple] = []
        own = np.searchsorted(levels, size[full], "right") - 1
        for step in (0, 1):
            level = own + step
            # |x ^ y| <= (|x| + |y|) (100 - p) / (100 + p), both sizes at most the level's last
            most = 2 * (levels[level + 1] - 1) * (100 - percent) // (100 + percent)
            todo = np.flatnonzero(most > 0)  # with no difference allowed only copies are linked
            for seed in range(SEEDS):
                if len(todo):
                    todo = todo[self._divide(h, limits, keys, full[todo], level[todo], most[todo], seed)]
        join = lambda i, kind: np.concatenate([np.zeros(0, kind), *(p[i] for p in self.parts)])
        self.key, self.tag, self.need, self.signature = join(0, np.int64), join(1, np.int32), join(2, np.int32), join(3, _U)
        at = np.cumsum([0, *(len(p[0]) for p in self.parts)])
        self.sheet = np.concatenate([np.zeros(0, np.int64), *(p[4] + a for p, a in zip(self.parts, at, strict=False))])
        del self.parts

    def _divide(self, h, limits, keys, rows, level, most, seed) -> np.ndarray:
        """One sheet for each of the rows; mask of those that need the next seed too."""
        blocks = most + 1 + np.maximum(1, (most + 1) // 4)
        size = limits[rows + 1] - limits[rows]
        member = np.repeat(np.arange(len(rows)), size)
        value = h[np.arange(len(member)) + np.repeat(limits[rows] - (np.cumsum(size) - size), size)]
        salt = mix64((level * SEEDS + seed).astype(_U))
        part = ((mix64(value ^ salt[member]) >> _U(32)) * blocks.astype(_U)[member]) >> _U(32)
        first = np.cumsum(blocks) - blocks
        place = first[member] + part.astype(np.int64)
        total = np.zeros(int(blocks.sum()), _U)
        np.add.at(total, place, mix64(value + _U(77)))
        filled = np.zeros(len(total), bool)
        filled[place] = True
        sheet = np.repeat(np.arange(len(rows)), blocks)
        n_filled = np.bincount(sheet, filled, len(rows)).astype(np.int64)
        # linked sets differ in at most ``most`` blocks, so they agree on this many non-empty ones
        need = n_filled - most
        poor = need <= 0
        if seed == SEEDS - 1:
            filled |= poor[sheet]  # the last resort: empty blocks count as well
        number = np.arange(len(total)) - first[sheet]
        signature = mix64(mix64(total + salt[sheet]) + number.astype(_U))
        self.parts.append((keys[rows], (level * SEEDS + seed).astype(np.int32), np.maximum(need, 1).astype(np.int32), signature[filled], sheet[filled]))
        return poor


def _set_rows(docs: DataFrame, n: int, conflicts: np.ndarray, bits: int) -> DataFrame:
    """``doc_id, n_shingles, key, second`` of every row."""

    def run(batches):
        for batch in batches:
            sizes, keys = [], []
            for _, _, data, offsets in text_slices(batch.column(1)):
                h, limits = shingle_sets(data, offsets, n)
                sizes.append(np.diff(limits))
                keys.append(set_keys(h, limits, conflicts, bits))
            if keys:
                columns = [np.concatenate(sizes), *(np.concatenate(x) for x in zip(*keys, strict=True))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], ["doc_id", "n_shingles", "key", "second"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key long, second long")


def _classes(sets: DataFrame) -> DataFrame:
    known = sets.where("key <> 0 and doc_id is not null")
    return known.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("n_shingles").alias("n_shingles"), F.min("second").alias("least"), F.max("second").alias("most"))


def key_conflicts(classes: DataFrame) -> np.ndarray:
    """First keys that two different sets share.  Of n sets about n * n / 2^63 do: ten billion have a handful;
    more than a million would mean a broken hash."""
    found = classes.where("least <> most").select("key").limit(1_000_001).collect()
    if len(found) > 1_000_000:
        raise RuntimeError("too many equal keys of different sets")
    return np.sort(np.array([r[0] for r in found], np.int64))


_BLOB = "bucket int, keys binary, tags binary, needs binary, counts binary, signatures binary"


def _shared_blocks(docs: DataFrame, n: int, percent: int, buckets: int, conflicts: np.ndarray, bits: int) -> DataFrame:
    """``block, key, tag, need``: the blocks whose content at least two classes have.

    Signatures travel with 32 bits beside their bucket.  Blocks of one sheet that these do not tell apart
    count once, and the sheet's need falls by as many."""

    def emit(batches):
        held, size = [], 0

        def out():
            base = np.cumsum([0, *(len(x.key) for x in held)])
            key, tag, need, sig = (np.concatenate([getattr(x, f) for x in held]) for f in ("key", "tag", "need", "signature"))
            sheet = np.concatenate([x.sheet + a for x, a in zip(held, base, strict=False)])
            bucket = (((sig >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
            where, sig = bucket * len(key) + sheet, sig.astype(np.uint32)
            order = np.lexsort((sig, where)) if buckets * len(key) >= 1 << 32 else np.argsort((where.astype(_U) << _U(32)) | sig, kind="stable")
            where, sig = where[order], sig[order]
            again = np.append(False, (where[1:] == where[:-1]) & (sig[1:] == sig[:-1]))
            if again.any():
                need = np.maximum(need - np.bincount(where[again] % len(key), minlength=len(key)).astype(np.int32), 1)
                where, sig = where[~again], sig[~again]
            cut = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            count = np.diff(np.append(cut, len(where))).astype(np.uint32)
            group, of = where[cut] // len(key), where[cut] % len(key)
            edge, span = np.searchsorted(group, np.arange(buckets + 1)), np.append(cut, len(where))
            rows = [(b, edge[b], edge[b + 1]) for b in np.flatnonzero(np.diff(edge)).tolist()]
            columns = [[to_bytes(x[of[a:z]]) for _, a, z in rows] for x in (key, tag, need)]
            columns += [[to_bytes(count[a:z]) for _, a, z in rows], [to_bytes(sig[span[a] : span[z]]) for _, a, z in rows]]
            return pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in rows], pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["bucket", "keys", "tags", "needs", "counts", "signatures"])

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(1)):
                h, limits = shingle_sets(data, offsets, n)
                sheets = Sheets(h, limits, set_keys(h, limits, conflicts, bits)[0], percent)
                if len(sheets.signature):
                    held.append(sheets)
                    size += len(sheets.signature)
                if size > 750_000:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    def meet(key, table):
        count = blobs(table["counts"], np.uint32).astype(np.int64)
        sig = blobs(table["signatures"], np.uint32)
        sheet = np.repeat(np.arange(len(count)), count)
        # the same sheet of another chunk's copy counts once
        keys, tags, needs = (blobs(table[c], t) for c, t in (("keys", np.int64), ("tags", np.int32), ("needs", np.int32)))
        order = np.lexsort((tags[sheet], keys[sheet], sig))
        sig, sheet = sig[order], sheet[order]
        key_, tag = keys[sheet], tags[sheet]
        new = np.append(True, (sig[1:] != sig[:-1]) | (key_[1:] != key_[:-1]) | (tag[1:] != tag[:-1]))
        sig, key_, tag, need = sig[new], key_[new], tag[new], needs[sheet[new]]
        cut = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        size = np.diff(np.append(cut, len(sig)))
        shared = np.repeat(key_[cut] != key_[cut + size - 1], size)  # keys are sorted: two of them, at least
        block = (np.int64(key[0].as_py()) << 32) | sig[shared].astype(np.int64)
        return pa.table([pa.array(block, pa.int64()), pa.array(key_[shared], pa.int64()), pa.array(tag[shared], pa.int32()), pa.array(need[shared], pa.int32())], names=["block", "key", "tag", "need"])

    return docs.mapInArrow(emit, _BLOB).groupBy("bucket").applyInArrow(meet, "block long, key long, tag int, need int")


def _candidate_edges(docs: DataFrame, n: int, percent: int, buckets: int, conflicts: np.ndarray, bits: int) -> DataFrame:
    """Classes that may be linked, as stars ``a, b`` around the smallest class of a block.

    A class stays only if, in one of its sheets, as many of its blocks are shared as any link needs.
    Of its c shared blocks only the c - need + 1 that fewest classes hold are used (a prefix filter:
    two classes that share ``need`` blocks share one of those), so the blocks of a passage that many
    documents hold do not chain groups of copies together."""
    shared = stored(_shared_blocks(docs, n, percent, buckets, conflicts, bits), "blocks")
    able = shared.groupBy("key", "tag").agg(F.count("*").alias("c"), F.max("need").alias("least")).where("c >= least").select(F.col("key").alias("k"), F.col("tag").alias("t"))
    kept = stored(shared.join(able, (F.col("key") == F.col("k")) & (F.col("tag") == F.col("t"))).select("block", "key", "tag", "need"), "kept")
    holders = kept.groupBy("block").agg(F.count("*").alias("held")).where("held > 1").withColumnRenamed("block", "of")
    sheet = W.partitionBy("key", "tag")
    ranked = kept.join(holders, F.col("block") == F.col("of")).select("block", "key", "need", F.row_number().over(sheet.orderBy("held", "block")).alias("place"), F.count("*").over(sheet).alias("c"))
    used = stored(ranked.where("place <= c - need + 1").select("block", "key"), "used")
    lead = used.groupBy("block").agg(F.min("key").alias("b"), F.max("key").alias("most")).where("b < most").select(F.col("block").alias("of"), "b")
    return used.join(lead, F.col("block") == F.col("of")).where("key <> b").select(F.col("key").alias("a"), "b").distinct()


def _entries(rows: list[np.ndarray], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse incidence ``(column, row)`` in order of columns, without columns that are not asked for."""
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    values, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), size)
    j = np.minimum(np.searchsorted(columns, values), max(len(columns) - 1, 0))
    hit = columns[j] == values if len(columns) else np.zeros(len(values), bool)
    order = np.argsort(j[hit], kind="stable")
    return j[hit][order], row[hit][order]


def _sparse_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Counts of common columns of the rows of two boolean blocks.  A column that most rows hold is turned
    round, so that only its exceptions are multiplied: |x & y| = 1 - !x - !y + !x & !y there."""
    common = a.sum(axis=0) + b.sum(axis=0) > (len(a) + len(b)) / 2
    x, y = a ^ common, b ^ common
    full = int(common.sum()) - x[:, common].sum(axis=1)[:, None] - y[:, common].sum(axis=1)[None, :]
    (cx, rx), (cy, ry) = np.nonzero(x.T), np.nonzero(y.T)
    first = np.searchsorted(cy, np.arange(a.shape[1] + 1))
    times = np.diff(first)[cx]  # each entry of x meets the entries of y in its column
    ends, met, i = np.cumsum(times), np.zeros(len(a) * len(b), np.int64), 0
    while i < len(cx):  # in pieces of bounded size
        z = max(i + 1, int(np.searchsorted(ends, ends[i] + _PIECE)))
        part = times[i:z]
        other = np.arange(int(part.sum())) - np.repeat(np.cumsum(part) - part - first[cx[i:z]], part)
        met += np.bincount(np.repeat(rx[i:z], part) * len(b) + ry[other], minlength=len(met))
        i = z
    return full + met.reshape(len(a), len(b))


def overlaps(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Overlap counts of two blocks of rows, and the mask of pairs that reach what their sizes demand.

    Counts are accumulated over column blocks.  A pair is discarded as soon as its count and what is left
    of its smaller row fall below the demand; counts of discarded pairs are not completed."""
    na, nb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right))
    demand = -(-percent * (na[:, None] + nb[None, :]) // (100 + percent))
    columns = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = [_entries(left, columns), _entries(right, columns)]
    rest = [np.bincount(row, minlength=m) for (_, row), m in zip(sides, (len(left), len(right)), strict=True)]
    count = np.zeros(demand.shape, np.int64)
    alive = np.minimum(rest[0][:, None], rest[1][None, :]) >= demand
    for start in range(0, len(columns), COLUMN_BLOCK):
        width = min(COLUMN_BLOCK, len(columns) - start)
        rows = [np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))]
        if not len(rows[0]):
            break
        blocks = []
        for k, (j, row) in enumerate(sides):
            x, y = np.searchsorted(j, (start, start + width))
            held = np.zeros((len(rest[k]), width), bool)
            held[row[x:y], j[x:y] - start] = True
            rest[k] = rest[k] - np.bincount(row[x:y], minlength=len(rest[k]))
            blocks.append(held[rows[k]])
        count[np.ix_(*rows)] += _sparse_product(*blocks)
        alive &= count + np.minimum(rest[0][:, None], rest[1][None, :]) >= demand
    return count, alive


def block_links(left_keys, left, right_keys, right, percent: int):
    """Keys of the linked pairs between two blocks of rows."""
    if len(left) == 1 and len(right) == 1:
        both = len(np.intersect1d(left[0], right[0], assume_unique=True))
        linked = np.array([[100 * both >= percent * (len(left[0]) + len(right[0]) - both)]])
    else:
        _, linked = overlaps(left, right, percent)
    i, j = np.nonzero(linked)
    return left_keys[i], right_keys[j]


def _multiply(tasks: DataFrame, percent: int) -> DataFrame:
    """``tasks``: cluster, i, j, side (0 left, 1 right, 2 both), key, hashes.  Spanning forests of the links."""

    def one(table: pa.Table):
        side = table["side"].to_numpy()
        keys = table["key"].to_numpy()
        sets = [np.frombuffer(x, _U) for x in table["hashes"].to_pylist()]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if not len(left) or not len(right):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(keys) == 2 and (side == 2).all():
            left, right = left[:1], right[1:]
        a, b = block_links(keys[left], [sets[i] for i in left], keys[right], [sets[i] for i in right], percent)
        other = a != b
        return forest(a[other], b[other])

    def run(batches):
        """Groups of a partition sorted by task; the last group of a batch is carried on."""
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            group = np.stack([table[c].to_numpy() for c in ("cluster", "i", "j")])
            cut = np.flatnonzero(np.append(True, (group[:, 1:] != group[:, :-1]).any(axis=0))) if table.num_rows else np.zeros(0, int)
            made = [one(table.slice(a, b - a)) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*made, strict=True)], ["a", "b"])
            rest = table.take(np.arange(cut[-1], table.num_rows)) if len(cut) else None  # a copy: frees the batch
        if rest is not None and rest.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in one(rest)], ["a", "b"])

    columns = ["cluster", "i", "j", "side", "key", "hashes"]
    dealt = tasks.select(*columns).repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "key")
    return dealt.mapInArrow(run, "a long, b long")


def _rows_of(docs: DataFrame, nodes: DataFrame, n: int, conflicts: np.ndarray, bits: int) -> DataFrame:
    """``nodes`` (rep, key, cluster, block, n_blocks) with the sorted shingle hashes of their texts; of rows
    that repeat an id with another text, those of the class."""

    def run(batches):
        for batch in batches:
            hashes, own = [], []
            for _, rows, data, offsets in text_slices(batch.column(0)):
                h, limits = shingle_sets(data, offsets, n)
                hashes += [to_bytes(h[limits[r] : limits[r + 1]]) for r in range(rows)]
                own.append(set_keys(h, limits, conflicts, bits)[0])
            out = pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(hashes, pa.binary())], ["key", "cluster", "block", "n_blocks", "hashes"])
            yield out.filter(pa.array(np.concatenate([np.zeros(0, np.int64), *own]) == batch.column(1).to_numpy()))

    joined = docs.join(nodes.hint("shuffle_hash"), docs["doc_id"] == nodes["rep"]).select("text", "key", "cluster", "block", "n_blocks")
    return joined.mapInArrow(run, "key long, cluster long, block long, n_blocks long, hashes binary").dropDuplicates(["key"])


def class_components(docs: DataFrame, classes: DataFrame, conflicts: np.ndarray, n: int = SHINGLE, percent: int = PERCENT, block_rows: int = BLOCK_ROWS, bits: int = 62) -> DataFrame:
    """``node, root`` over class keys, for classes linked with a class of another text."""
    spark = docs.sparkSession
    clusters = stored(components(_candidate_edges(docs, n, percent, n_buckets(spark), conflicts, bits)), "clusters")
    nodes = clusters.withColumnsRenamed({"node": "key", "root": "cluster"}).join(classes.select("key", F.col("low").alias("rep"), "n_shingles"), "key")
    sizes = nodes.groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("all"))
    sizes = sizes.select("cluster", F.greatest(F.ceil(F.col("m") / F.greatest(F.lit(block_rows), F.sqrt("m") / 2)), F.ceil(F.col("all") / BLOCK_SHINGLES)).alias("n_blocks"))
    nodes = nodes.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("key"), "n_blocks"))
    rows = stored(_rows_of(docs, nodes.select("rep", "key", "cluster", "block", "n_blocks"), n, conflicts, bits), "incidence")

    # round 1: each block with itself and with the cluster's first block
    block, blocks = F.col("block"), F.col("n_blocks")
    own = rows.withColumns({"i": block, "j": block, "side": F.lit(2)})
    later = rows.where("block > 0").withColumns({"i": F.lit(0).cast("long"), "j": block, "side": F.lit(1)})
    first = rows.where("block = 0 and n_blocks > 1").withColumn("i", F.lit(0).cast("long")).withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), blocks - 1))).withColumn("side", F.lit(0))
    cols = ["cluster", "i", "j", "side", "key", "hashes"]
    links = stored(_multiply(own.select(cols).unionByName(later.select(cols)).unionByName(first.select(cols)), percent), "links")

    large = rows.where("n_blocks > 1")
    if large.limit(1).count():
        # round 2: rows outside their cluster's largest component against all its rows
        found = components(links)
        state = large.join(found, large["key"] == found["node"], "left").select(large["*"], F.coalesce("root", "key").alias("part"))
        count = state.groupBy("cluster", "part").agg(F.count("*").alias("c")).groupBy("cluster").agg(F.max(F.struct("c", "part")).alias("top"), F.sum("c").alias("m"))
        state = state.join(count.select("cluster", F.col("top.part").alias("top"), "m", (F.col("m") - F.col("top.c")).alias("outside")), "cluster").where("outside > 0")
        state = stored(state.withColumn("n_out", F.ceil(F.col("outside") * F.col("n_blocks") / F.col("m"))), "open")
        out = state.where("part <> top").withColumn("i", -1 - F.pmod(F.xxhash64("key", F.lit(1)), "n_out")).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).withColumn("side", F.lit(0))
        all_ = state.withColumn("i", F.explode(F.sequence(-F.col("n_out"), F.lit(-1).cast("long")))).withColumn("j", block).withColumn("side", F.lit(1))
        links = links.unionByName(_multiply(out.select(cols).unionByName(all_.select(cols)), percent))
    return components(links)


def jaccard_components(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, block_rows: int = BLOCK_ROWS, bits: int = 62) -> DataFrame:
    """Per document: n_shingles and component_id, the smallest doc_id reachable by links.  (``bits`` of the
    first key are less in tests of conflicting keys only.)"""
    bound_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    conflicts = np.zeros(0, np.int64)
    sets = stored(_set_rows(base, n, conflicts, bits), "sets")
    classes = stored(_classes(sets), "classes")
    found = key_conflicts(classes)
    if len(found):
        conflicts = found
        sets = stored(_set_rows(base, n, conflicts, bits), "sets")
        classes = stored(_classes(sets), "classes")
    linked = class_components(base.where("doc_id is not null"), classes, conflicts, n, percent, block_rows, bits)
    named = classes.join(linked, classes["key"] == linked["node"], "left").select("key", "low", F.coalesce("root", "key").alias("root"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_key = named.join(least, "root").select(F.col("key").alias("class"), "component_id")
    return sets.join(by_key, sets["key"] == by_key["class"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents that are the first of their component; all columns stay.  Repeated rows of one id
    stay together; rows with a null id stay."""
    first = jaccard_components(docs, n, percent).where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.where("doc_id is null").unionByName(docs.join(first, docs["doc_id"].cast("long") == first["__kept"], "left_semi"))
