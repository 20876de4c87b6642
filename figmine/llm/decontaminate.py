"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Benchmark texts are cut into windows of ``window`` words (an item with fewer words is one window).
Their hashes go to every executor, each training text is scanned once without a shuffle, and every
hash hit is compared word by word before it counts.  The set is broadcast only up to
``max_windows`` windows.  Of a larger benchmark a Bloom filter of at most ``2 ** BLOOM_BITS`` bits is
broadcast: texts are scanned once too, the windows that pass meet the benchmark's windows in one join on
hash and words, and the hits come back to their row by a key that is made once and stored with it.
Both ways give the same rows.

Defined cases: null or wordless texts have no words and are never hit; benchmark rows with a null id
or text are no items; repeated items count once; repeated rows and rows with a null id are judged each by
their own text; extra columns of any name pass through untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figmine.llm.common import bound_batches, fresh, stored, to_bytes
from figmine.llm.kernels import NON_WORD, Words, mix64, text_slices, window_hashes, window_rows

WINDOW = 10
MAX_WINDOWS = 400_000
_FILTER_BITS = 20
#: largest Bloom filter: 32 MB
BLOOM_BITS = 28
_SEGMENT = 1 << 16
_U = np.uint64


def _joined(words: Words, i: int, k: int) -> bytes:
    return b" ".join(words.data[s:e].tobytes() for s, e in zip(words.start[i : i + k], words.end[i : i + k], strict=True))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """One row per window of each item: ``item, k, hash, words``."""

    def run(batches):
        for batch in batches:
            items = batch.column(0).to_pylist()
            rows = [[], [], [], []]
            for first, n, data, offsets in text_slices(batch.column(1)):
                w = Words(data, offsets, NON_WORD, True)
                for r in range(n):
                    count = int(w.first[r + 1] - w.first[r])
                    k = min(window, count)
                    for i in range(w.first[r], w.first[r + 1] - k + 1) if k else ():
                        rows[0].append(items[first + r])
                        rows[1].append(k)
                        rows[2].append(int(window_hashes(w.hash[i : i + k], k).view(np.int64)[0]))
                        rows[3].append(_joined(w, i, k))
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.binary())], ["item", "k", "hash", "words"])

    known = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where("item is not null and text is not null")
    return known.mapInArrow(run, "item string, k int, hash long, words binary").distinct()


class WindowIndex:
    """Sorted window hashes by window length, with the items and the words of each window."""

    def __init__(self, rows):
        by: dict[int, dict[int, dict[bytes, set[str]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
        for item, k, h, words in rows:
            by[k][h][bytes(words)].add(item)
        self.lengths = {}
        for k, found in by.items():
            keys = np.array(list(found), np.int64).view(np.uint64)
            keys.sort()
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[keys >> np.uint64(64 - _FILTER_BITS)] = True
            texts = [{t: sorted(i) for t, i in found[int(h)].items()} for h in keys.view(np.int64)]
            self.lengths[k] = (keys, seen, texts)

    def hits(self, words: Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Mask of hit words, and the items found in each row."""
        mask = np.zeros(len(words.start), bool)
        items: dict[int, set[str]] = defaultdict(set)
        for k, (keys, seen, texts) in self.lengths.items():
            h = window_hashes(words.hash, k)
            at = np.flatnonzero(seen[h >> np.uint64(64 - _FILTER_BITS)] & window_rows(words, k)) if len(h) else ()
            if not len(at):
                continue
            j = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
            same = keys[j] == h[at]
            for i, j in zip(at[same].tolist(), j[same].tolist(), strict=True):
                if found := texts[j].get(_joined(words, i, k)):
                    mask[i : i + k] = True
                    items[int(words.row[i])].update(found)
        return mask, items


class Bloom:
    """Four probes a hash into a table of bits whose size follows the number of hashes, up to a bound."""

    def __init__(self, bits: int, table: np.ndarray | None = None):
        self.bits = bits
        self.table = np.zeros(1 << max(bits - 3, 0), np.uint8) if table is None else table

    def probes(self, h: np.ndarray):
        for salt in (0, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
            at = mix64(h ^ _U(salt)) >> _U(64 - self.bits)
            yield (at >> _U(3)).astype(np.int64), (_U(1) << (at & _U(7))).astype(np.uint8)

    def add(self, h: np.ndarray) -> None:
        for at, bit in self.probes(h):
            np.bitwise_or.at(self.table, at, bit)

    def find(self, h: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), bool)
        for at, bit in self.probes(h):
            ok &= self.table[at] & bit > 0
        return ok


def _bloom(windows: DataFrame, n: int) -> Bloom:
    """The filter of all windows: tasks fill tables, segments of which are joined before they are collected."""
    bits = min(BLOOM_BITS, max(16, math.ceil(math.log2(64 * max(n, 1)))))

    def fill(batches):
        own = Bloom(bits)
        for batch in batches:
            own.add(batch.column(0).to_numpy().view(_U))
        for i in range(0, len(own.table), _SEGMENT):
            if own.table[i : i + _SEGMENT].any():
                yield pa.RecordBatch.from_arrays([pa.array([i // _SEGMENT], pa.int32()), pa.array([own.table[i : i + _SEGMENT].tobytes()], pa.binary())], ["segment", "bits"])

    def join(key, table):
        both = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table["bits"].to_pylist()])
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([both.tobytes()], pa.binary())], names=["segment", "bits"])

    schema = "segment int, bits binary"
    out = Bloom(bits)
    for segment, raw in windows.select("hash").mapInArrow(fill, schema).groupBy("segment").applyInArrow(join, schema).collect():
        out.table[segment * _SEGMENT : (segment + 1) * _SEGMENT] = np.frombuffer(raw, np.uint8)
    return out


def _index(benchmark: DataFrame, window: int, max_windows: int):
    """``(index, windows)``: a broadcast index of a benchmark of at most ``max_windows`` windows, else None and
    the stored table of windows."""
    windows = stored(benchmark_windows(benchmark, window), "windows")
    if windows.limit(max_windows + 1).count() > max_windows:
        return None, windows
    return benchmark.sparkSession.sparkContext.broadcast(WindowIndex(windows.collect())), None


def _ids(items: set[str] | None) -> tuple[int, str]:
    return len(items or ()), hashlib.sha256(",".join(sorted(items or ())).encode()).hexdigest()


def _cut(words: Words, data: np.ndarray, offset: int, end: int, row: int, mask: np.ndarray) -> str:
    """The text of a row without its runs of hit words; what stands between runs is kept."""
    a, b = words.first[row], words.first[row + 1]
    hit = np.concatenate([[False], mask[a:b], [False]])
    starts, ends = np.flatnonzero(~hit[:-1] & hit[1:]), np.flatnonzero(hit[:-1] & ~hit[1:]) - 1
    parts, at = [], offset
    for s, e in zip(words.start[a:b][starts], words.end[a:b][ends], strict=True):
        parts.append(data[at:s].tobytes())
        at = e
    return (b"".join(parts) + data[at:end].tobytes()).decode()


def _report(docs: DataFrame, index) -> DataFrame:
    """Per document its counts and items, in one scan."""

    def run(batches):
        for batch in batches:
            ids, cols = batch.column(0), [[], [], [], []]
            for _, n, data, offsets in text_slices(batch.column(1)):
                w = Words(data, offsets, NON_WORD, True)
                mask, items = index.value.hits(w)
                cols[0] += w.counts.tolist()
                cols[1] += np.diff(np.concatenate([[0], np.cumsum(mask)])[w.first]).tolist()
                for r in range(n):
                    count, digest = _ids(items.get(r))
                    cols[2].append(count)
                    cols[3].append(digest)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string")


def _counted(docs: DataFrame) -> DataFrame:
    """``doc_id, row, n_words`` of keyed rows."""

    def run(batches):
        for batch in batches:
            counts = [Words(data, offsets, NON_WORD, True).counts for _, _, data, offsets in text_slices(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))], ["doc_id", "row", "n_words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "row", "text").mapInArrow(run, f"doc_id {kind}, row long, n_words bigint")


def _joined_hits(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """``row, n_hit, n_items, items_sha256, positions`` of hit rows (``row, text``), by a join."""
    spark = rows.sparkSession
    known = stored(windows.groupBy("k", "hash", "words").agg(F.collect_set("item").alias("items")), "window-items")
    bloom = spark.sparkContext.broadcast(_bloom(known, known.count()))
    lengths = sorted(r[0] for r in known.select("k").distinct().collect())  # at most the window's words

    def scan(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, _, data, offsets in text_slices(batch.column(1)):
                w = Words(data, offsets, NON_WORD, True)
                for k in lengths:
                    h = window_hashes(w.hash, k)
                    at = np.flatnonzero(window_rows(w, k))
                    at = at[bloom.value.find(h[at])]
                    for i in range(0, len(at), 50_000):
                        a = at[i : i + 50_000]
                        row = w.row[a]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[first + row]), pa.array(a - w.first[row]), pa.array(np.full(len(a), k, np.int32)), pa.array(h[a].view(np.int64)), pa.array([_joined(w, j, k) for j in a.tolist()], pa.binary())],
                            ["row", "place", "k", "hash", "words"])

    def merge(key, table):
        hit = np.unique(np.concatenate([np.arange(a, a + k) for a, k in zip(table["place"].to_pylist(), table["k"].to_pylist(), strict=True)]))
        count, digest = _ids(set().union(*table["items"].to_pylist()))
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([len(hit)], pa.int64()), pa.array([count], pa.int64()), pa.array([digest]), pa.array([to_bytes(hit.astype(np.int64))], pa.binary())], names=["row", "n_hit", "n_items", "items_sha256", "positions"])

    found = rows.select("row", "text").mapInArrow(scan, "row long, place long, k int, hash long, words binary").join(known, ["k", "hash", "words"]).select("row", "place", "k", "items")
    return found.groupBy("row").applyInArrow(merge, "row long, n_hit bigint, n_items bigint, items_sha256 string, positions binary")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated."""
    bound_batches(docs.sparkSession)
    index, windows = _index(benchmark, window, max_windows)
    if index is not None:
        out = _report(docs, index)
    else:
        rows = stored(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "rows")
        hits = _joined_hits(rows, windows).drop("positions").withColumnRenamed("row", "hit_row")
        out = _counted(rows).join(hits, F.col("row") == F.col("hit_row"), "left").select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items_sha256", F.lit(_ids(None)[1])).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def without_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The documents with every hit span removed from ``text``; other rows and columns stay as they are."""
    bound_batches(docs.sparkSession)
    index, windows = _index(benchmark, window, max_windows)
    position, names, joined = docs.columns.index("text"), docs.columns, docs
    if index is None:
        row, at = fresh(docs, "row"), fresh(docs, "at")
        keyed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        hits = _joined_hits(keyed.select(F.col(row).alias("row"), "text"), windows).select(F.col("row").alias(at + "_row"), F.col("positions").alias(at))
        joined = keyed.join(hits, F.col(row) == F.col(at + "_row"), "left").select(*names, at)

    def run(batches):
        for batch in batches:
            texts = batch.column(position).to_pylist()
            for first, n, data, offsets in text_slices(batch.column(position)):
                w = Words(data, offsets, NON_WORD, True)
                if index is not None:
                    mask, _ = index.value.hits(w)
                else:
                    mask = np.zeros(len(w.start), bool)
                    for r, raw in enumerate(batch.column(len(names)).slice(first, n).to_pylist()):
                        if raw:
                            mask[w.first[r] + np.frombuffer(raw, np.int64)] = True
                for r in np.unique(w.row[mask]).tolist():
                    texts[first + r] = _cut(w, data, offsets[r], offsets[r + 1], r, mask)
            columns = [pa.array(texts, batch.schema.field(position).type) if i == position else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, docs.schema)
