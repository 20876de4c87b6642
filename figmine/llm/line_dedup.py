"""Line dedup: lines are hashed, range-partitioned by (hash, document), sorted, and streamed.

The boundaries of the range partitioning are on the pair of hash and document, so a line that a third
of all documents hold is spread over many partitions instead of one.  Inside a partition the rows of
a hash come largest document first, then by the first position in it; they are streamed batch by batch,
and the first occurrence decides which document keeps the line.  What is held between batches is the
state of one hash, with its rows only while fewer than ``min_docs`` documents have been seen.
Only a partition's first and last hash can go on in its neighbours: their counts meet in a summary of
at most two hashes a partition, which is the one thing that is broadcast.  What returns to a document
is a compressed bitmap of the lines that it loses, never text.

Defined cases: a null or empty text is one empty line; lines shorter than ``min_chars`` always stay;
rows that repeat an id count as one document, each cut by its own text's lines; rows with a null id keep
all lines; ids are integers.  Extra columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figmine.llm.common import bound_batches, fresh, read_small_ints, small_ints, stored
from figmine.llm.kernels import _LOWER, BLANK, segment_hashes, text_slices

MIN_CHARS = 20
MIN_DOCS = 3


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (newline excluded) and row of each line of each text."""
    newline = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], newline + 1]), kind="stable")
    row = np.searchsorted(offsets[1:], newline, "right")
    rows = np.sort(np.concatenate([np.arange(len(offsets) - 1), row]), kind="stable")
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - (rows[1:] == rows[:-1])
    ends[-1:] = offsets[-1:]
    return starts, ends, rows


def line_keys(data, starts, ends, min_chars: int):
    """Indexes of the lines long enough to be keys, with their two hashes."""
    solid = ~BLANK[data]
    where = np.flatnonzero(solid)
    a, b = np.searchsorted(where, starts), np.searchsorted(where, ends)
    full = np.flatnonzero(b > a)
    s, e = where[a[full]], where[b[full] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    long = points[e] - points[s] >= min_chars
    h1, h2 = segment_hashes(_LOWER[data], s[long], e[long])
    return full[long], h1.view(np.int64), h2.view(np.int64)


def line_table(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1, h2, doc_id, print, first, at``: each key with its document (and the fingerprint of the text, which
    tells rows of one id apart), the first position and all positions, compressed."""

    def run(batches):
        for batch in batches:
            ids, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for first, _, data, offsets in text_slices(batch.column(2)):
                starts, ends, rows = line_bounds(data, offsets)
                at, h1, h2 = line_keys(data, starts, ends, min_chars)
                if not len(at):
                    continue
                row = rows[at]
                place = at - np.searchsorted(rows, row)
                order = np.lexsort((place, h2, h1, row))
                row, h1, h2, place = row[order], h1[order], h2[order], place[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                cut = np.flatnonzero(new)
                ends_ = np.append(cut[1:], len(row))
                of = first + row[cut]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (h1[cut], h2[cut], ids[of].astype(np.int64), prints[of].astype(np.int64), place[cut].astype(np.int64))), pa.array([small_ints(place[i:j]) for i, j in zip(cut, ends_, strict=True)], pa.binary())],
                    ["h1", "h2", "doc_id", "print", "first", "at"])

    bound_batches(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), "text").where("doc_id is not null")
    return known.mapInArrow(run, "h1 long, h2 long, doc_id long, print long, first long, at binary")


_DECISION = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("print", pa.int64()), ("at", pa.binary()), ("n", pa.int64())])


class _Stream:
    """Decisions over the sorted rows of one partition, batch by batch.

    A decided row comes out without its hash: its document loses the line.  Rows of the partition's first
    hash come out with it, and with the number of new documents in ``n``; the last hash leaves a summary
    (keeper and number of documents), and its rows where they are not decided."""

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.rest = None  # undecided rows of the last hash
        self.key, self.opening, self.keeper, self.docs, self.last = None, False, 0, 0, None

    @staticmethod
    def _row(h, doc, n):
        return pa.RecordBatch.from_arrays([pa.array([h[0]]), pa.array([h[1]]), pa.array([doc]), pa.array([0]), pa.array([b""], pa.binary()), pa.array([n])], schema=_DECISION)

    def _out(self, table, mask, n=None):
        """Masked rows: with hash and count where ``n`` is given, decided without."""
        part = table.filter(pa.array(mask))
        null = pa.nulls(part.num_rows, pa.int64())
        head = [null, null] if n is None else [part["h1"], part["h2"]]
        return pa.table([*head, part["doc_id"], part["print"], part["at"], null if n is None else pa.array(n[mask])], schema=_DECISION).to_batches()

    def take(self, batch: pa.RecordBatch):
        table = pa.Table.from_batches([batch] if self.rest is None else [*self.rest.to_batches(), batch]).combine_chunks()
        self.rest = None
        h1, h2, ids = (table[c].to_numpy() for c in ("h1", "h2", "doc_id"))
        new = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
        cut = np.flatnonzero(new)
        size = np.diff(np.append(cut, len(h1)))
        fresh = np.append(True, new[1:] | (ids[1:] != ids[:-1]))
        same = self.key == (h1[0], h2[0])  # the first group goes on from the batch before
        if same and self.last == ids[0]:
            fresh[0] = False
        docs = np.add.reduceat(fresh.astype(np.int64), cut)
        keeper = ids[cut].copy()  # the first occurrence: largest document first
        if same:
            docs[0] += self.docs
            keeper[0] = self.keeper
        opening = np.zeros(len(cut), bool)
        opening[0] = self.key is None or (same and self.opening)
        first = np.repeat(opening, size)
        yield from self._out(table, first, fresh.astype(np.int64))
        lost = np.repeat(~opening & (docs >= self.min_docs), size) & (ids != np.repeat(keeper, size))
        yield from self._out(table, lost)
        if not opening[-1] and docs[-1] < self.min_docs:
            self.rest = table.slice(int(cut[-1]))  # seen again with the next batch
            self.key, self.opening, self.docs, self.last = (0, 0, "none"), False, 0, None
        else:
            self.key, self.opening, self.keeper, self.docs, self.last = (h1[-1], h2[-1]), bool(opening[-1]), int(keeper[-1]), int(docs[-1]), ids[-1]

    def end(self):
        if self.rest is not None:
            ids = self.rest["doc_id"].to_numpy()
            yield from self._out(self.rest, np.ones(len(ids), bool), np.append(True, ids[1:] != ids[:-1]).astype(np.int64))
        elif self.key is not None and not self.opening:
            yield self._row(tuple(map(int, self.key)), self.keeper, self.docs)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, print, at``: compressed positions of lines that a row loses, one row for each key."""
    spark = docs.sparkSession
    lines = stored(line_table(docs, min_chars), "lines")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = lines.repartitionByRange(parts, "h1", "h2", F.desc("doc_id")).sortWithinPartitions("h1", "h2", F.desc("doc_id"), "first")

    def decide(batches):
        stream = _Stream(min_docs)
        for batch in batches:
            if batch.num_rows:
                yield from stream.take(batch)
        yield from stream.end()

    made = stored(ordered.mapInArrow(decide, "h1 long, h2 long, doc_id long, print long, at binary, n long"), "line-decisions")
    pending = made.where("h1 is not null")
    # at most two hashes a partition: those that the boundaries cut
    across = pending.groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("doc_id").alias("keeper")).where(F.col("docs") >= min_docs)
    late = pending.join(F.broadcast(across), ["h1", "h2"]).where("doc_id <> keeper")
    return made.where("h1 is null").select("doc_id", "print", "at").unionByName(late.select("doc_id", "print", "at"))


def lost_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, print, drops``: for each row that loses lines, a zlib-compressed bitmap of them."""

    def many(batches):
        """Groups of the partition, which is sorted by document; the last one is carried on."""
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            ids, prints = (table[c].to_numpy() for c in ("doc_id", "print"))
            cut = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1]))) if len(ids) else np.zeros(0, int)
            if len(cut) > 1:
                yield from _merge_sorted(table, cut)
            rest = table.slice(int(cut[-1])) if len(cut) else None
        if rest is not None and rest.num_rows:
            yield from _merge_sorted(rest, np.array([0, rest.num_rows]))

    def _merge_sorted(table, cut):
        at, ids, prints = table["at"].to_pylist(), table["doc_id"].to_numpy()[cut[:-1]], table["print"].to_numpy()[cut[:-1]]
        out = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            places = np.concatenate([read_small_ints(x) for x in at[a:b]])
            bits = np.zeros(int(places.max(initial=-1)) + 1, bool)
            bits[places] = True
            out.append(zlib.compress(np.packbits(bits).tobytes(), 1))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(prints), pa.array(out, pa.binary())], ["doc_id", "print", "drops"])

    by_doc = dropped_lines(docs, min_chars, min_docs).repartition(F.col("doc_id")).sortWithinPartitions("doc_id", "print")
    return by_doc.mapInArrow(many, "doc_id long, print long, drops binary")


def _bitmap(raw: bytes | None, n: int) -> np.ndarray:
    """Mask of the lines that stay."""
    keep = np.ones(n, bool)
    if raw:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(raw), np.uint8))[:n].astype(bool)
        keep[: len(bits)] = ~bits
    return keep


def _with_bitmaps(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``docs`` with the bitmap as one more, last column of a name that ``docs`` does not have."""
    own, mark, drops = (fresh(docs, c) for c in ("drop_id", "drop_print", "drops"))
    maps = lost_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs).toDF(own, mark, drops).hint("shuffle_hash")
    mine = (docs["doc_id"].cast("long") == maps[own]) & (F.xxhash64(docs["text"]) == maps[mark])
    return docs.join(maps, mine, "left").drop(own, mark)


def line_dedup_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: n_lines, n_dropped, kept_sha256."""

    def run(batches):
        for batch in batches:
            n_lines, n_dropped, digests = [], [], []
            for text, raw in zip(batch.column(1), batch.column(2), strict=True):
                text = (text.as_py() or "").encode()
                n = text.count(b"\n") + 1
                gone = 0
                if raw.is_valid:
                    keep = _bitmap(raw.as_py(), n)
                    gone = n - int(keep.sum())
                    if gone:
                        text = b"\n".join(x for x, k in zip(text.split(b"\n"), keep, strict=True) if k)
                n_lines.append(n)
                n_dropped.append(gone)
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digests)], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs).mapInArrow(run, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string")


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with the lines that they lose cut from ``text``."""
    names, position = docs.columns, docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(position).to_pylist()
            for i, raw in enumerate(batch.column(len(names)).to_pylist()):
                if raw:
                    lines = (texts[i] or "").split("\n")
                    texts[i] = "\n".join(x for x, k in zip(lines, _bitmap(raw, len(lines)), strict=True) if k)
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field(position).type) if i == position else batch.column(i) for i in range(len(names))], names)

    return _with_bitmaps(docs, min_chars, min_docs).mapInArrow(run, docs.schema)
