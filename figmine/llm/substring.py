"""Substring dedup: difference-cover anchors, extended to windows.

A window is ``WINDOW`` = 13 consecutive words.  Positions of a document are taken modulo 7, and the
7 words that start at a position in the difference cover {1, 2, 4} are an anchor.  For any two
positions i and j some shift d < 7 puts both i+d and j+d in the cover, so two equal windows always
share an anchor at the same shift, inside the window (6 + 7 = 13 words).

1. Every chunk of documents sends the hashes of its anchors, once each, to buckets.
2. A bucket answers each chunk with those of its anchors that some other document holds too.
3. Only windows that contain such an anchor are extended to 13 words and hashed, to 96 bits; a chunk
   sends each such hash once, with the smallest document that starts it and whether others do.
4. A bucket answers with the hashes that start in a smaller document, of this chunk or of another, and
   with that document.
5. The chunk removes the words covered by windows among the answers; nothing else removes a word.

Chunks hold a bounded number of bytes and pre-aggregate: a passage that a third of all documents hold
is one entry a chunk.  A task holds one bucket or one chunk at a time.  Texts cross the network once,
compressed; a lost piece is packed again from the input, which gives the same chunks, and an answer that
finds no chunk is an error.

Defined cases: null, empty and short texts have no windows and lose nothing; repeated rows of one
document never remove each other; rows with a null id lose nothing and remove nothing; ids are integers;
kept words are joined by one space.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figmine.llm.common import blobs, bound_batches, n_buckets, pack, read_small_ints, small_ints, to_bytes, unpack
from figmine.llm.kernels import BLANK, Words, covered, text_slices, window_hashes, window_rows

WINDOW = 13
PERIOD, COVER, ANCHOR = 7, (1, 2, 4), 7
CHUNK_BYTES = 4 << 20
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_U = np.uint64


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(n)) >> _U(32)


def _split(h: np.ndarray, n: int) -> np.ndarray:
    """Limits of the buckets in sorted hashes."""
    return np.searchsorted(_bucket(h, n), np.arange(n + 1, dtype=_U))


class _Chunk:
    """Words, anchors and windows of the documents of one chunk."""

    def __init__(self, payload: bytes):
        table = unpack(payload)
        self.column = table["doc_id"].combine_chunks()
        self.known = self.column.is_valid().to_numpy(zero_copy_only=False)
        self.ids = self.column.fill_null(0).to_numpy().astype(np.int64)
        self.parts = [(first, Words(data, offsets, BLANK, False)) for first, _, data, offsets in text_slices(table["text"])]

    def starts(self, first: int, w: Words, k: int) -> np.ndarray:
        """Positions at which k words of one document with an id begin."""
        at = np.flatnonzero(window_rows(w, k))
        return at[self.known[first + w.row[at]]]

    def anchors(self, first: int, w: Words) -> tuple[np.ndarray, np.ndarray]:
        at = self.starts(first, w, ANCHOR)
        at = at[_IN_COVER[(at - w.first[w.row[at]]) % PERIOD]]
        return at, window_hashes(w.hash, ANCHOR)[at]

    def owners(self, first: int, w: Words, at: np.ndarray) -> np.ndarray:
        return self.ids[first + w.row[at]]


def _windows(w: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of the windows that start at the given words."""
    return window_hashes(w.hash, WINDOW)[at], w.second(at, WINDOW)


def _lowest(h: np.ndarray, ids: np.ndarray, second: np.ndarray | None = None):
    """Sorted distinct hashes (pairs, with ``second``) with the smallest and largest document of each:
    ``h, second, low, high``."""
    second = np.zeros(len(h), np.uint32) if second is None else second
    order = np.argsort(h, kind="stable")
    if ((h[order][1:] == h[order][:-1]) & (second[order][1:] != second[order][:-1])).any():
        order = np.lexsort((second, h))
    h, second, ids = h[order], second[order], ids[order]
    cut = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (second[1:] != second[:-1]))) if len(h) else np.zeros(0, np.int64)
    if not len(cut):
        return h, second, ids, ids
    return h[cut], second[cut], np.minimum.reduceat(ids, cut), np.maximum.reduceat(ids, cut)


def _find(keys: np.ndarray, seconds: np.ndarray, h: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each pair among sorted distinct pairs, and whether it is there."""
    if not len(keys):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    j = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    while True:
        near = keys[j] == h
        hit = near & (seconds[j] == second)
        later = np.flatnonzero(near & ~hit & (j + 1 < len(keys)))
        later = later[keys[j[later] + 1] == h[later]]
        if not len(later):
            return j, hit
        j[later] += 1


def _joined(parts: list[tuple]) -> tuple:
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _stable(docs: pa.Table, answers: pa.Table) -> None:
    if answers.num_rows and not docs.num_rows:
        raise RuntimeError("the input gave other chunks when read again; write it to a table first")


_ASK = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("extra", pa.binary())])
_ASK_WINDOWS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("seconds", pa.binary()), ("lows", pa.binary()), ("many", pa.binary())])


def _asked(schema: pa.Schema, chunk: int, n: int, h: np.ndarray, *others) -> pa.RecordBatch:
    """One row a bucket: its part of the sorted hashes and of the other columns ``(values, to bytes)``."""
    cut = _split(h, n)
    full = np.flatnonzero(np.diff(cut))
    columns = [pa.array([make(x[cut[b] : cut[b + 1]]) for b in full], pa.binary()) for x, make in ((h, to_bytes), *others)]
    return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(np.full(len(full), chunk)), *columns], schema=schema)


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _read_bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8))[:n].astype(bool)


def _ask_anchors(n: int):
    """Sorted distinct anchors of the chunk (64 bits: a false share only lets a window be looked at);
    extra: whether two documents of the chunk hold it."""

    def run(batches):
        for batch in batches:
            for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                c = _Chunk(payload)
                found = [(h, c.owners(first, w, at)) for first, w in c.parts for at, h in [c.anchors(first, w)]]
                if found:
                    h, _, low, high = _lowest(*_joined(found))
                    yield _asked(_ASK, chunk, n, h, (low != high, _bits))

    return run


def _answer_anchors(key, table):
    hashes = [np.frombuffer(x, _U) for x in table["hashes"].to_pylist()]
    every = np.sort(np.concatenate(hashes))
    twice = every[1:][every[1:] == every[:-1]]
    out = []
    for h, many in zip(hashes, table["extra"].to_pylist(), strict=True):
        j = np.minimum(np.searchsorted(twice, h), max(len(twice) - 1, 0))
        out.append(to_bytes(h[_read_bits(many, len(h)) | (twice[j] == h if len(twice) else False)]))
    return pa.table([table["chunk"], pa.array(out, pa.binary())], names=["chunk", "shared"])


def _near(starts: np.ndarray, anchors: np.ndarray, n: int) -> np.ndarray:
    """Those window starts whose window contains one of the anchors."""
    reach = np.zeros(n + 1, np.int64)
    reach[anchors + 1] = 1
    reach = np.cumsum(reach)
    return starts[reach[starts + WINDOW - ANCHOR + 1] > reach[starts]]


def _ask_windows(n: int):
    def run(key, docs, answers):
        _stable(docs, answers)
        shared = np.sort(blobs(answers["shared"], _U))
        out = []
        for chunk, payload in zip(docs["chunk"].to_pylist(), docs["payload"].to_pylist(), strict=True):
            c = _Chunk(payload)
            found = []
            for first, w in c.parts if len(shared) else ():
                at, h = c.anchors(first, w)
                j = np.minimum(np.searchsorted(shared, h), len(shared) - 1)
                starts = _near(c.starts(first, w, WINDOW), at[shared[j] == h], len(w.start))
                if len(starts):
                    h, second = _windows(w, starts)
                    found.append((h, c.owners(first, w, starts), second))
            if found:
                h, second, low, high = _lowest(*_joined(found))
                out.append(_asked(_ASK_WINDOWS, chunk, n, h, (second, to_bytes), (low, small_ints), (low != high, _bits)))
        return pa.Table.from_batches(out, _ASK_WINDOWS) if out else _ASK_WINDOWS.empty_table()

    return run


def _answer_windows(key, table):
    """To each chunk: its windows that start in a smaller document, and the smallest one."""
    asked = [(np.frombuffer(h, _U), np.frombuffer(s, np.uint32), read_small_ints(low)) for h, s, low in zip(*(table[c].to_pylist() for c in ("hashes", "seconds", "lows")), strict=True)]
    h, second, low, _ = _lowest(*(np.concatenate([x[i] for x in asked]) for i in (0, 2, 1)))
    rows = []
    for chunk, (own, own2, mine), many in zip(table["chunk"].to_pylist(), asked, table["many"].to_pylist(), strict=True):
        j, _ = _find(h, second, own, own2)
        hit = (low[j] < mine) | _read_bits(many, len(own))
        if hit.any():
            rows.append((chunk, to_bytes(own[hit]), to_bytes(own2[hit]), small_ints(low[j][hit])))
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.table([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["chunk", "hashes", "seconds", "lows"])


def _removed(c: _Chunk, answers: pa.Table):
    """Per part of the chunk: its words and the mask of removed ones.  Only windows among the answers,
    which hold a shared anchor, can remove a word."""
    h, second = (blobs(answers[x], t) for x, t in (("hashes", _U), ("seconds", np.uint32)))
    low = np.concatenate([np.zeros(0, np.int64), *(read_small_ints(x) for x in answers["lows"].to_pylist())])
    order = np.lexsort((second, h))
    h, second, low = h[order], second[order], low[order]
    for first, w in c.parts:
        gone = np.zeros(len(w.start), bool)
        if len(h):
            at = c.starts(first, w, WINDOW)
            one = window_hashes(w.hash, WINDOW)[at]
            j = np.minimum(np.searchsorted(h, one), len(h) - 1)
            same = h[j] == one
            at, one = at[same], one[same]
            if len(at):
                j, hit = _find(h, second, one, w.second(at, WINDOW))
                gone = covered(at[hit & (low[j] < c.owners(first, w, at))], WINDOW, len(w.start))
        yield first, w, gone


def _answered(docs: DataFrame, chunk_bytes: int):
    spark = docs.sparkSession
    bound_batches(spark)
    n = n_buckets(spark)
    chunks = pack(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id", "text"], chunk_bytes)
    shared = chunks.mapInArrow(_ask_anchors(n), "bucket int, chunk long, hashes binary, extra binary").groupBy("bucket").applyInArrow(_answer_anchors, "chunk long, shared binary")
    asked = chunks.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_ask_windows(n), "bucket int, chunk long, hashes binary, seconds binary, lows binary, many binary")
    lower = asked.groupBy("bucket").applyInArrow(_answer_windows, "chunk long, hashes binary, seconds binary, lows binary")
    return chunks.groupBy("chunk").cogroup(lower.groupBy("chunk"))


def substring_dedup_report(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: n_words, n_removed, kept_sha256 of the kept words joined by one space."""

    def run(key, table, answers):
        _stable(table, answers)
        ids, cols = [pa.array([], pa.int64())], [[], [], []]
        for payload in table["payload"].to_pylist():
            c = _Chunk(payload)
            ids.append(c.column)
            for _, w, gone in _removed(c, answers):
                cols[0] += w.counts.tolist()
                cols[1] += np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first]).tolist()
                cols[2] += [hashlib.sha256(data).hexdigest() for data in _squeezed(w, gone)]
        return pa.table([pa.concat_arrays(ids), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _answered(docs, chunk_bytes).applyInArrow(run, schema)


def _squeezed(w: Words, gone: np.ndarray) -> list[bytes]:
    """For each row its kept words joined by one space."""
    length = w.end - w.start
    kept = ~gone
    start, size, row = w.start[kept], length[kept] + 1, w.row[kept]
    out = np.full(int(size.sum()), 0x20, np.uint8)
    place = np.cumsum(size) - size
    inner = np.arange(len(out)) - np.repeat(place, size)
    letters = inner < np.repeat(size - 1, size)
    out[letters] = w.data[(np.repeat(start, size) + inner)[letters]]
    first = np.searchsorted(row, np.arange(len(w.first)))
    edge = np.append(place, len(out))[first]
    raw = out.tobytes()
    return [raw[a : b - 1] if b > a else b"" for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def without_repeats(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, text``: each document's kept words joined by one space."""

    def run(key, table, answers):
        _stable(table, answers)
        ids, texts = [pa.array([], pa.int64())], []
        for payload in table["payload"].to_pylist():
            c = _Chunk(payload)
            ids.append(c.column)
            for _, w, gone in _removed(c, answers):
                texts += [data.decode() for data in _squeezed(w, gone)]
        return pa.table([pa.concat_arrays(ids), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return _answered(docs, chunk_bytes).applyInArrow(run, "doc_id long, text string")
