"""Alignment of the tokens of two tokenizers, as joins and windows.

``token_links`` is the core, relational throughout: the tokens of every unit of text are exploded with their byte lengths,
a window adds the lengths up to end offsets, and a full join of both sides on (unit, end) gives the ends where either
side has a token.  (It is written as a grouping of both sides by these keys, which keeps the rows of a unit together; a
full join would deal all of them out once more.)  An end that both have is a cut; the running count of cuts numbers the groups.  Between
two neighbouring ends lies exactly one token of each side, so every row of that join is one link: the last
known token at or after its end, of each side, by a window.  (A join of the tokens within a group would
compare all pairs of a long group to find the same rows.)

Texts repeat their words, so the unit of the corpus report is the segment, not the document.  A text is cut where
both tokenizers always end a token, whatever stands around: ``safe_cuts`` derives the byte pairs of such places
from the two vocabularies (none for tokenizers it cannot prove this for: then a unit is a whole text).
Documents go into chunks; a chunk is a list of distinct segments and its texts as places in it.  Each
segment of the corpus is tokenized and aligned once, pair counts weigh it with its occurrences, and one
join by segment brings the sums back to the chunks that hold it.

Defined cases: null and empty texts, texts that are not UTF-8, and those whose tokens of either side do not
join to the text, have no tokens and add nothing to any count; repeated rows count each; a null id stays null;
columns other than id and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from figmine.llm.common import bound_batches, groups, stored, to_bytes, unpack
from figmine.llm.kernels import text_slices

#: bytes of text of a chunk, about
CHUNK_BYTES = 16 << 20
#: pairs of ids that are broadcast, at most (24 bytes each)
BROADCAST_PAIRS = 1_000_000
#: segments tokenized at once
BATCH = 4096
#: a text in which a tokenizer that rewrites its input would show it
_PROBE = "  a  b\t\n\n c ﬁ ①é\0 　<s></s><unk><0x41><|endoftext|>\U0001f600 "


def _letter_bytes() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the
    others for those from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Tokenizer A (byte-level, a JSON file) and B (pieces, a model file) from the bytes of their files."""

    def __init__(self, a: bytes, b: bytes):
        self.files, self.loaded = (a, b), None

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Pair:
        with open(a_path, "rb") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())

    def __getstate__(self):
        return self.files

    def __setstate__(self, files):
        self.files, self.loaded = files, None

    def load(self) -> Pair:
        if self.loaded:
            return self
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_buffer(self.files[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.files[1])
        letter = _letter_bytes()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = {i: bytes(letter[c] for c in t) if all(c in letter for c in t) else t.encode() for t, i in vocabulary.items()}
        piece = self.b.id_to_piece
        self.b_bytes = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        setup = json.loads(self.files[0])
        split = setup.get("pre_tokenizer") or {}
        byte_level = setup.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        all_bytes = sum(self.b.is_byte(i) for i in range(len(self.b_bytes))) == 256 and all(c in vocabulary for c in letter)
        newline = [i for i, x in enumerate(self.b_bytes) if b"\n" in x]
        # only U+2581 is then lost on the way, and a new line is a token of its own
        self.plain = bool(byte_level and all_bytes and len(newline) == 1 and self.b_bytes[newline[0]] == b"\n" and self._whole([_PROBE])[0][2])
        self.lead = [self.b.piece_to_id("▁"), newline[0]] if self.plain else []
        self.cuts = self.safe_cuts() if self.plain else None
        self.loaded = True
        return self

    def safe_cuts(self) -> np.ndarray:
        """256 x 256: whether a text may be cut between a byte and the next.  The pieces of B must nowhere
        hold both side by side, and A's first step, which parts letters, digits, other signs and blanks, must
        part them: blanks after a sign, or two kinds of sign (an apostrophe may belong to the letters after it)."""
        beside = np.zeros((256, 256), bool)
        for i, x in enumerate(self.b_bytes):
            if not self.b.is_control(i) and not self.b.is_unknown(i):
                v = np.frombuffer(x, np.uint8)
                beside[v[:-1], v[1:]] = True
        sign = np.arange(0x21, 0x7F)
        kind = np.array([1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 3 for c in sign])
        out = np.zeros((256, 256), bool)
        out[np.ix_(sign, sign)] = (kind[:, None] != kind[None, :]) & ~((sign == 0x27)[:, None] & (kind == 1)[None, :])
        out[np.ix_(sign, [0x20, 0x0A])] = True
        # the second byte of a Latin letter; the first one, C3, tells that it is one (see ``places``)
        out[np.ix_([b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)], [*sign[kind != 1].tolist(), 0x20, 0x0A])] = True
        return out & ~beside

    def places(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions where segments start, and the end."""
        start = np.zeros(len(data) + 1, bool)
        if self.cuts is not None and len(data) > 1:
            start[1:-1] = self.cuts.ravel()[(data[:-1].astype(np.uint16) << 8) | data[1:]]
            high = np.flatnonzero(start[1:-1] & (data[:-1] >= 0x80)) + 1
            start[high[data[np.maximum(high - 2, 0)] != 0xC3]] = False
        start[offsets] = True
        return np.flatnonzero(start)

    def _whole(self, texts: Sequence[str]) -> list[tuple]:
        return self._checked(texts, self.b.encode(texts, num_threads=1), " ")

    def _checked(self, texts, b_ids, before: str) -> list[tuple]:
        out = []
        for text, a, b in zip(texts, self.a.encode_batch_fast([before + t for t in texts], add_special_tokens=False), b_ids, strict=True):
            raw, a = (before + text).encode(), a.ids
            x, y = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
            out.append((a, b, b"".join(x) == raw and b"".join(y) == raw, list(map(len, x)), list(map(len, y))))
        return out

    def encode(self, units: list[str]) -> list[tuple]:
        """``A ids, B ids, whether both join to the unit, lengths of A, of B`` of segments of space + text (whole ones
        where there are no safe cuts)."""
        if not self.plain:
            return self._whole([u[1:] for u in units])
        # a new line in front holds off the space that B puts before a text: both go
        b = self.b.encode(["\n" + u for u in units], num_threads=1)
        if any(x[:2] != self.lead for x in b):
            raise RuntimeError("the second tokenizer joined a new line with what follows")
        return self._checked(units, [x[2:] for x in b], "")

    def faithful(self, units: pa.Array) -> np.ndarray:
        """Whether the tokens of each unit join to it."""
        if self.plain:
            return ~pc.match_substring(units, "▁").to_numpy(zero_copy_only=False)
        return np.concatenate([np.zeros(0, bool), *(np.array([x[2] for x in self.encode(units.slice(i, BATCH).to_pylist())]) for i in range(0, len(units), BATCH))])


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers, compressed by byte planes: the high ones are nearly all zero."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + bytes(pa.compress(to_bytes(planes), codec="zstd", asbytes=True))


def _from_planes(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_CHUNK = "ids array<bigint>, lengths binary, places binary, segments array<string>, counts array<bigint>"


def _chunks(docs: DataFrame, pair: Pair) -> DataFrame:
    """``docs``: doc_id, text (with a space in front, null where there are no tokens).  A row a chunk: ids, segments of
    each document, their places in the list of distinct segments, that list, and how often each occurs."""
    shared = docs.sparkSession.sparkContext.broadcast(pair)

    def run(batches):
        pair, held, size = shared.value.load(), [], 0

        def out():
            ids = pa.chunked_array([h[0] for h in held]).combine_chunks()
            merged = pa.chunked_array([h[2] for h in held]).unify_dictionaries()
            segments = merged.chunk(0).dictionary
            where = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in merged.chunks]).astype(np.int64)
            lengths = np.concatenate([h[1] for h in held])
            bad = ~pair.faithful(segments)
            if bad.any():
                doc = np.repeat(np.arange(len(lengths)), lengths)
                out_of = np.bincount(doc, bad[where], len(lengths)) > 0
                where, lengths = where[~out_of[doc]], np.where(out_of, 0, lengths)
                used, where = np.unique(where, return_inverse=True)
                segments = segments.take(pa.array(used))
            counts = np.bincount(where, minlength=len(segments))
            order = np.argsort(-counts, kind="stable")  # frequent segments have small places
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            segments, counts, where = segments.take(pa.array(order)), counts[order], place[where]
            one = lambda kind, values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays([one(None, ids), pa.array([to_bytes(lengths)], pa.binary()), pa.array([_planes(where)], pa.binary()), one(None, segments), one(None, pa.array(counts))], ["ids", "lengths", "places", "segments", "counts"])

        for batch in batches:
            for first, n, data, offsets in text_slices(batch.column(1), CHUNK_BYTES):
                start = pair.places(data, offsets)
                parts = pa.StringArray.from_buffers(len(start) - 1, pa.py_buffer(to_bytes(start.astype(np.int32))), pa.py_buffer(to_bytes(data))) if len(data) else pa.array([], pa.string())
                lengths = np.diff(np.searchsorted(start, offsets)) if len(data) else np.zeros(n, np.int64)
                held.append((batch.column(0).slice(first, n), lengths.astype(np.int64), parts.dictionary_encode()))
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return docs.mapInArrow(run, _CHUNK)


_TOKENS = "unit long, n long, text string, a array<int>, a_len array<smallint>, b array<int>, b_len array<smallint>"


def _tokenized(units: DataFrame, pair: Pair) -> DataFrame:
    """``units``: unit, n, text.  Tokens of both sides with their byte lengths; no rows for texts that do not join."""
    shared = units.sparkSession.sparkContext.broadcast(pair)

    def run(batches):
        pair = shared.value.load()
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH):
                batch = whole.slice(i, BATCH)
                got = pair.encode(batch.column(2).to_pylist())
                kept = pa.array([g[2] for g in got], pa.bool_())
                lists = [pa.array([g[k] for g in got if g[2]], pa.list_(kind)) for k, kind in ((0, pa.int32()), (3, pa.int16()), (1, pa.int32()), (4, pa.int16()))]
                yield pa.RecordBatch.from_arrays([*(c.filter(kept) for c in batch.columns), *lists], ["unit", "n", "text", "a", "a_len", "b", "b_len"])

    return units.select("unit", "n", "text").mapInArrow(run, _TOKENS)


def token_links(tokens: DataFrame) -> DataFrame:
    """``unit, n, end`` (byte offset at which the link ends), ``a_pos, a, b_pos, b`` (the linked tokens: places and ids),
    ``a_ends, b_ends`` (which of them end there) and ``after``: cuts at or after the end, the same for all links
    of a group and one less for each group further on."""

    dealt = tokens.select("unit", "n", "a", "a_len", "b", "b_len").repartition("unit")

    def side(c: str) -> F.Column:
        is_a = F.lit(c == "a").alias("is_a")
        return F.transform(F.arrays_zip(F.col(c).alias("id"), F.col(f"{c}_len").alias("length")), lambda t: F.struct(is_a, t["id"].alias("id"), t["length"].alias("length")))

    both = F.concat(side("a"), side("b"))
    rows = dealt.select("unit", "n", F.size("a").alias("first_b"), F.posexplode(both).alias("pos", "t"))
    ends = F.sum(F.col("t.length").cast("long")).over(W.partitionBy("unit", "t.is_a").orderBy("pos"))
    rows = rows.select("unit", "n", ends.alias("end"), F.when(F.col("t.is_a"), F.col("pos")).alias("a_pos"), F.when(F.col("t.is_a"), F.col("t.id")).alias("a"), F.when(~F.col("t.is_a"), F.col("pos") - F.col("first_b")).alias("b_pos"), F.when(~F.col("t.is_a"), F.col("t.id")).alias("b"))
    # the full join of both sides on (unit, end): one row at most of either side
    met = rows.groupBy("unit", "end").agg(F.max("n").alias("n"), *(F.max(c).alias(c) for c in ("a_pos", "a", "b_pos", "b")))
    back = W.partitionBy("unit").orderBy(F.desc("end"))
    a_ends, b_ends = F.col("a").isNotNull(), F.col("b").isNotNull()
    known = [F.last(c, ignorenulls=True).over(back).alias(c) for c in ("a_pos", "a", "b_pos", "b")]
    return met.select("unit", "n", "end", *known, a_ends.alias("a_ends"), b_ends.alias("b_ends"), F.sum((a_ends & b_ends).cast("long")).over(back).alias("after"))


def _by_unit(links: DataFrame) -> DataFrame:
    """One row a unit: numbers of tokens and groups, the groups as a string, and the linked id pairs."""
    own = lambda c: F.filter("rows", lambda r: r[f"{c}_ends"])  # noqa: E731  the tokens of one side, each once
    ids = lambda c: F.array_join(F.transform(own(c), lambda r: r[c].cast("string")), ",")
    grouped = links.groupBy("unit", "after").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("end", "a", "b", "a_ends", "b_ends"))).alias("rows"))
    named = F.struct("after", F.concat(ids("a"), F.lit("|"), ids("b")).alias("text")).alias("group")
    one = grouped.select("unit", "n", named, F.transform("rows", lambda r: F.struct(r["a"].alias("a"), r["b"].alias("b"))).alias("pairs"), F.size(own("a")).alias("n_a"), F.size(own("b")).alias("n_b"))
    whole = one.groupBy("unit").agg(F.first("n").alias("n"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.count("*").alias("n_groups"), F.sort_array(F.collect_list("group"), asc=False).alias("groups"), F.flatten(F.collect_list("pairs")).alias("pairs"))
    return whole.select("unit", "n", "n_a", "n_b", "n_groups", F.array_join(F.col("groups.text"), ";").alias("groups"), "pairs")


def aligned_units(units: DataFrame, pair: Pair) -> DataFrame:
    """``units``: unit (distinct), n (how often it occurs), text (a segment of space + text, or all of it).  A row a unit:
    text, n_a, n_b, n_groups, n_links, groups, n_best and count_sum."""
    tokens = stored(_tokenized(units, pair), "tokens")
    each = stored(_by_unit(token_links(tokens)), "units")
    linked = each.select("unit", "n", F.explode("pairs").alias("p")).select("unit", "n", "p.a", "p.b")
    counts = linked.groupBy("a", "b").agg(F.sum("n").alias("count"))
    counts = stored(counts, "pairs")
    highest = counts.groupBy("b").agg(F.max("count").alias("most")).withColumnRenamed("b", "of")
    scored = counts.join(highest, F.col("b") == F.col("of")).select(F.col("a").alias("ka"), F.col("b").alias("kb"), "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    if counts.count() <= BROADCAST_PAIRS:
        scored = F.broadcast(scored)
    sums = linked.join(scored, (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb"))).groupBy("unit").agg(F.sum("best").alias("n_best"), F.sum("count").alias("count_sum")).withColumnRenamed("unit", "scored")
    out = each.select("unit", "n_a", "n_b", "n_groups", F.size("pairs").cast("long").alias("n_links"), "groups").join(sums, F.col("unit") == F.col("scored"))
    return tokens.select(F.col("unit").alias("of"), "text").join(out, F.col("of") == F.col("unit")).select("text", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_ANSWERS = pa.schema([("place", pa.int32()), *((c, pa.int64()) for c in _SUMS), ("groups", pa.string())])
#: bytes of answers that a task packs at once
PACK_BYTES = 32 << 20


def _packed(answers: DataFrame) -> DataFrame:
    """``chunk, answers``: the answers that a task has for a chunk, compressed in one value."""

    def run(batches):
        held, size = [], 0

        def out():
            table = pa.Table.from_batches(held).sort_by([("chunk", "ascending"), ("place", "ascending")])
            chunk = table["chunk"].to_numpy()
            cut = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
            packed = []
            for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(chunk)], strict=True):
                sink = io.BytesIO()
                part = table.slice(a, z - a).drop_columns(["chunk"]).combine_chunks()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_table(part)
                packed.append(sink.getvalue())
            return pa.RecordBatch.from_arrays([pa.array(chunk[cut]), pa.array(packed, pa.binary())], ["chunk", "answers"])

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= PACK_BYTES:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return answers.mapInArrow(run, "chunk long, answers binary")


def alignment_report(docs: DataFrame, pair: Pair) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    bound_batches(docs.sparkSession)
    text = F.col("text")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when((text != "") & F.is_valid_utf8(text), F.concat(F.lit(" "), text)).alias("text"))
    chunks = stored(_chunks(base, pair).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    asked = chunks.select("chunk", F.posexplode("segments").alias("place", "text"), "counts").select("chunk", "place", "text", F.element_at("counts", F.col("place") + 1).alias("n"))
    units = stored(asked.groupBy("text").agg(F.sum("n").alias("n")).withColumn("unit", F.monotonically_increasing_id()), "segments")
    known = aligned_units(units, pair).withColumnRenamed("text", "of")
    back = _packed(asked.select("chunk", "place", "text").join(known, F.col("text") == F.col("of")).select("chunk", "place", *_SUMS, "groups"))
    both = back.unionByName(chunks.select("chunk", "ids", "lengths", "places"), allowMissingColumns=True)

    def run(batches):
        for t in groups(batches, ["chunk"]):
            head = t.filter(t["answers"].is_null())
            rows = [unpack(x) for x in t["answers"].to_pylist() if x]
            rows = pa.concat_tables(rows).sort_by("place") if rows else _ANSWERS.empty_table()
            lengths, where = np.frombuffer(head["lengths"][0].as_py(), np.int64), _from_planes(head["places"][0].as_py())
            if head.num_rows != 1 or not np.array_equal(rows["place"].to_numpy(), np.arange(rows.num_rows)) or (len(where) and where.max() >= rows.num_rows):
                raise RuntimeError("a chunk lacks answers")
            first, full = np.cumsum(lengths) - lengths, lengths > 0
            columns = {}
            for c in _SUMS:
                total = np.zeros(len(lengths), np.int64)
                if full.any():
                    total[full] = np.add.reduceat(rows[c].to_numpy()[where], first[full])
                columns[c] = pa.array(total)
            names, digests, where = rows["groups"].to_pylist(), [], where.tolist()
            for a, n in zip(first.tolist(), lengths.tolist(), strict=True):
                digests.append(hashlib.sha256(";".join([names[i] for i in where[a : a + n]]).encode()).hexdigest() if n else "")
            yield pa.RecordBatch.from_arrays([head["ids"].combine_chunks().flatten(), *columns.values(), pa.array(digests, pa.string())], ["doc_id", *_SUMS, "groups_sha256"])

    ordered = both.select("chunk", "ids", "lengths", "places", "answers").repartition("chunk").sortWithinPartitions("chunk")
    return ordered.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in _SUMS) + ", groups_sha256 string")


def document_links(docs: DataFrame, pair: Pair) -> DataFrame:
    """The links themselves, a row for each: doc_id, end (byte offset in space + text), a_pos, a, b_pos, b and the number
    of the group, from 0.  ``doc_id`` tells the rows apart; a unit is a whole document."""
    whole = F.when((F.col("text") != "") & F.is_valid_utf8("text"), F.concat(F.lit(" "), F.col("text")))
    units = docs.select(F.col("doc_id").cast("long").alias("unit"), F.lit(1).cast("long").alias("n"), whole.alias("text")).where("text is not null and unit is not null")
    plain = Pair(*pair.files)
    tokens = stored(_tokenized(units, plain), "tokens")
    links = stored(token_links(tokens), "links")
    groups_ = links.groupBy("unit").agg(F.max("after").alias("all")).withColumnRenamed("unit", "of")
    return links.join(groups_, F.col("unit") == F.col("of")).select(F.col("unit").alias("doc_id"), "end", "a_pos", "a", "b_pos", "b", (F.col("all") - F.col("after")).alias("group"))
