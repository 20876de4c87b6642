"""Quality classifier: an interpolated modified Kneser-Ney model of byte 5-grams.

Training text are the documents that a label table trusts, outside fold 0.  Counts are kept in shards
chosen by the two bytes before the predicted one: a 5-gram, its suffixes down to three bytes and their
contexts then lie in one shard, and shorter orders are tables of at most 65,536 and 256 entries.

Scoring joins counts by shard: a chunk of documents sends each of its distinct 5-grams once to the
shard, which answers with log probabilities; the chunk sums them over all bytes of each text.  A shard's
counts are bounded by the alphabet (at most 2^24 grams for one pair of bytes), its requests are not: every
``REPLICA_DOCS`` documents there is one more replica of all shards, and a chunk asks one of them.
Perplexity is per byte.  A language's threshold is a quantile of the perplexity of trusted documents
in fold 0, which the model has not seen; languages with fewer than ``least`` of them use the quantile
over all.

Defined cases: null and empty texts have null perplexity and are not kept; a null language is a language
of its own; with no trusted text the model is uniform and everything with text is kept; repeated rows are
scored each; rows with a null id are scored and never trained on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figmine.llm.common import bound_batches, fold_column, n_buckets, pack, stored, to_bytes, unpack
from figmine.llm.kernels import Grams, gram_slices, mix64

ORDER = 5
QUANTILE = 0.99
LEAST = 30
CHUNK_BYTES = 6 << 20
#: bytes worked on at once: bounds the memory of a task
SLICE = 2 << 20
MAX_BROADCAST_IDS = 1_000_000
MAX_BROADCAST_LANGUAGES = 100_000
REPLICA_DOCS = 4_000_000
_U = np.uint64


def _shards(g: np.ndarray, n: int) -> np.ndarray:
    """Shard of each gram, by the two bytes before the last one."""
    table = ((mix64(np.arange(1 << 16, dtype=_U) + _U(1)) >> _U(32)) * _U(n)) >> _U(32)
    return table[(g >> _U(8)) & _U(0xFFFF)].astype(np.int64)


def _summed(g: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(g, kind="stable")
    g, c = g[order], c[order]
    cut = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, int)
    return g[cut], np.add.reduceat(c, cut) if len(cut) else c


def count_shards(trusted: DataFrame, shards: int) -> DataFrame:
    """``shard, grams, counts``: merged counts of all trusted texts, one row a shard."""

    def emit(batches):
        held_g, held_c, size = [], [], 0

        def out():
            g, c = _summed(np.concatenate(held_g), np.concatenate(held_c))
            shard = _shards(g, shards)
            order = np.argsort(shard, kind="stable")
            g, c = g[order], c[order]
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            full = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([to_bytes(g[cut[s] : cut[s + 1]]) for s in full], pa.binary()), pa.array([to_bytes(c[cut[s] : cut[s + 1]]) for s in full], pa.binary())], ["shard", "grams", "counts"])

        for batch in batches:
            for _, _, data, offsets, context in gram_slices(batch.column(0), SLICE):
                g = Grams(data, offsets, ORDER, inverse=False)
                counts = g.counts.astype(np.int64)
                if context:  # bytes repeated from the part before
                    again = Grams(data[:context], np.array([0, context]), ORDER, inverse=False)
                    counts[np.searchsorted(g.distinct, again.distinct)] -= again.counts
                held_g.append(g.distinct)
                held_c.append(counts)
                size += len(counts)
                if size > 1_500_000:
                    g, c = _summed(np.concatenate(held_g), np.concatenate(held_c))
                    held_g, held_c, size = [g], [c], len(g)
                    if size > 1_000_000:
                        yield out()
                        held_g, held_c, size = [], [], 0
        if size:
            yield out()

    def merge(key, table):
        g, c = _summed(*(np.frombuffer(b"".join(table[x].to_pylist()), t) for x, t in (("grams", _U), ("counts", np.int64))))
        g, c = g[c > 0], c[c > 0]
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([to_bytes(g)], pa.binary()), pa.array([to_bytes(c)], pa.binary())], names=["shard", "grams", "counts"])

    schema = "shard int, grams binary, counts binary"
    return trusted.select("text").mapInArrow(emit, schema).groupBy("shard").applyInArrow(merge, schema)


def _continuations(keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of k bytes of distinct longer grams, with the number of grams that end in each."""
    return np.unique(keys & _U((1 << 8 * k) - 1), return_counts=True)


def _orders(g: np.ndarray, c: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts by order: raw at the top, continuation counts below, as far as a shard knows them."""
    order = np.argsort(g)
    out = {5: (g[order], c[order])}
    for k in (4, 3):
        out[k] = _continuations(out[k + 1][0], k)
    return out


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from counts of counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3) <= 0:
        return np.array([0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, 0.05, [0.95, 1.95, 2.95])


class _Level:
    """Interpolation at one order: discounted probability and left-over weight by context."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, d: np.ndarray):
        self.keys = keys
        context, where = np.unique(keys >> _U(8), return_inverse=True)
        total = np.bincount(where, counts, len(context))
        off = d[np.minimum(counts, 3) - 1]
        self.context = context
        self.p = np.maximum(counts - off, 0) / total[where] if len(keys) else np.zeros(0)
        self.left = np.bincount(where, np.minimum(off, counts), len(context)) / np.maximum(total, 1e-300)

    def mix(self, g: np.ndarray, lower: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return lower
        j = np.minimum(np.searchsorted(self.context, g >> _U(8)), len(self.context) - 1)
        left = np.where(self.context[j] == g >> _U(8), self.left[j], 1.0)
        i = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
        return np.where(self.keys[i] == g, self.p[i], 0.0) + left * lower


class Common:
    """What all shards share: discounts by order and the dense tables of orders 1 and 2."""

    def __init__(self, counts_of_counts: dict[int, np.ndarray], pairs: np.ndarray):
        self.d = {k: discounts(v) for k, v in counts_of_counts.items()}
        two = _Level(np.flatnonzero(pairs).astype(_U), pairs[pairs > 0], discounts(np.array([(pairs == i).sum() for i in (1, 2, 3, 4)])))
        single = (pairs.reshape(256, 256) > 0).sum(axis=0)
        one = _Level(np.flatnonzero(single).astype(_U), single[single > 0], discounts(np.array([(single == i).sum() for i in (1, 2, 3, 4)])))
        p1 = one.mix(np.arange(256, dtype=_U), np.full(256, 1 / 256))
        self.p2 = two.mix(np.arange(1 << 16, dtype=_U), np.tile(p1, 256))


def common_tables(model: DataFrame) -> Common:
    """Sums over the shards: 65,536 pair counts and twelve counts of counts, whatever the corpus."""

    def run(batches):
        pairs, cc = np.zeros(1 << 16, np.int64), np.zeros((3, 4), np.int64)
        for batch in batches:
            for g, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                orders = _orders(np.frombuffer(g, _U), np.frombuffer(c, np.int64))
                for row, k in enumerate((5, 4, 3)):
                    cc[row] += [(orders[k][1] == i).sum() for i in (1, 2, 3, 4)]
                pairs += np.bincount((orders[3][0] & _U(0xFFFF)).astype(np.int64), minlength=1 << 16)
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, -1 - np.arange(12)])), pa.array(np.concatenate([pairs[at], cc.ravel()]))], ["key", "n"])

    rows = model.select("grams", "counts").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    pairs, cc = np.zeros(1 << 16, np.int64), np.zeros(12, np.int64)
    for key, n in rows:
        if key >= 0:
            pairs[key] = n
        else:
            cc[-1 - key] = n
    return Common(dict(zip((5, 4, 3), cc.reshape(3, 4), strict=True)), pairs)


def shard_probabilities(g: np.ndarray, c: np.ndarray, common: Common, asked: np.ndarray) -> np.ndarray:
    p = common.p2[(asked & _U(0xFFFF)).astype(np.int64)]
    if len(g):
        orders = _orders(g, c)
        for k in (3, 4, 5):
            p = _Level(*orders[k], common.d[k]).mix(asked & _U((1 << 8 * k) - 1), p)
    return p


def _requests(table: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a chunk in order of shard and gram, with the limits of the shards."""
    g = np.zeros(0, _U)
    for _, _, data, offsets, _ in gram_slices(table["text"], SLICE):
        g = np.union1d(g, Grams(data, offsets, ORDER, inverse=False).distinct)
    shard = _shards(g, shards)
    order = np.argsort(shard, kind="stable")
    return g[order], np.searchsorted(shard[order], np.arange(shards + 1))


def log_probabilities(docs: DataFrame, model: DataFrame, common: Common, shards: int, carry: list[str], replicas: int = 1) -> DataFrame:
    """``carry`` columns with ``n_bytes`` and ``log2_p`` of each text."""
    chunks = pack(docs, [*carry, "text"], CHUNK_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def ask(batches):
        for batch in batches:
            for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                g, cut = _requests(unpack(payload), shards)
                full = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(np.full(len(full), chunk, np.int64)), pa.array([to_bytes(g[cut[s] : cut[s + 1]].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]) for s in full], pa.binary())], ["shard", "chunk", "asked"])

    def answer(key, counts, asked):
        g = np.frombuffer(b"".join(counts["grams"].to_pylist()), _U)
        c = np.frombuffer(b"".join(counts["counts"].to_pylist()), np.int64)
        parts = [np.frombuffer(x, np.uint8).reshape(-1, 5) for x in asked["asked"].to_pylist()]
        if not parts:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.binary())], names=["chunk", "shard", "log2_p"])
        wide = np.zeros((sum(map(len, parts)), 8), np.uint8)
        wide[:, :5] = np.concatenate(parts)
        p = np.log2(shard_probabilities(g, c, shared.value, wide.view("<u8").ravel())).astype(np.float32)
        cut = np.cumsum([0, *map(len, parts)])
        return pa.table([asked["chunk"], asked["shard"], pa.array([to_bytes(p[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], names=["chunk", "shard", "log2_p"])

    asked = chunks.mapInArrow(ask, "shard int, chunk long, asked binary")
    copies = model.withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))))
    asked = asked.withColumn("replica", F.pmod("chunk", F.lit(replicas)).cast("int"))
    answers = copies.groupBy("shard", "replica").cogroup(asked.groupBy("shard", "replica")).applyInArrow(answer, "chunk long, shard int, log2_p binary")

    def add(key, docs_, got):
        out = []
        if got.num_rows and not docs_.num_rows:
            raise RuntimeError("the input gave other chunks when read again; write it to a table first")
        by = dict(zip(got["shard"].to_pylist(), got["log2_p"].to_pylist(), strict=True))
        for payload in docs_["payload"].to_pylist():
            table = unpack(payload)
            g, cut = _requests(table, shards)
            values = np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(by[int(s)], np.float32) for s in np.flatnonzero(np.diff(cut)))])
            order = np.argsort(g)
            g, values = g[order], values[order]
            n_bytes, total = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows)
            for first, _, data, offsets, context in gram_slices(table["text"], SLICE):
                if not len(data):
                    continue
                grams = Grams(data, offsets, ORDER)
                each = values[np.searchsorted(g, grams.distinct)].astype(np.float64)[grams.which]
                each[:context] = 0
                full = np.flatnonzero(np.diff(offsets))
                total[first + full] += np.add.reduceat(each, offsets[:-1][full])
                n_bytes[first : first + len(offsets) - 1] += np.diff(offsets)
                n_bytes[first] -= context
            out.append(table.drop_columns(["text"]).append_column("n_bytes", pa.array(n_bytes)).append_column("log2_p", pa.array(total)))
        return pa.concat_tables(out)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in carry) + ", n_bytes long, log2_p double"
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(add, schema)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of trusted documents; broadcast only where they are few enough."""
    ids = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("trusted_id")).distinct()
    return F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, least: int = LEAST) -> DataFrame:
    """Per document: lang, perplexity (per byte), threshold (its language's) and keep."""
    spark = docs.sparkSession
    bound_batches(spark)
    shards = n_buckets(spark)
    base = docs.select("doc_id", "lang", "text")
    replicas = -(-docs.count() // REPLICA_DOCS) or 1
    trusted = trusted_ids(labels)
    training = base.where(fold_column(F.col("doc_id")) != 0).join(trusted, F.col("doc_id") == F.col("trusted_id"), "left_semi")
    model = stored(count_shards(training, shards), "ngrams")
    scored = stored(log_probabilities(base, model, common_tables(model), shards, ["doc_id", "lang"], replicas), "scored")
    scored = scored.withColumn("perplexity", F.when(F.col("n_bytes") > 0, F.pow(F.lit(2.0), -F.col("log2_p") / F.col("n_bytes"))))
    unseen = scored.where((fold_column(F.col("doc_id")) == 0) & F.col("perplexity").isNotNull()).join(trusted, F.col("doc_id") == F.col("trusted_id"), "left_semi")
    limit = F.percentile_approx("perplexity", quantile, 10000)
    overall = unseen.agg(limit.alias("t")).first()["t"]
    by_lang = unseen.groupBy(F.col("lang").alias("of")).agg(limit.alias("own"), F.count("*").alias("n")).where(F.col("n") >= least)
    everyone = F.lit(float("inf") if overall is None else overall)
    by_lang = stored(by_lang, "languages")
    by_lang = F.broadcast(by_lang) if by_lang.count() <= MAX_BROADCAST_LANGUAGES else by_lang
    out = scored.join(by_lang, scored["lang"].eqNullSafe(by_lang["of"]), "left").withColumn("threshold", F.coalesce("own", everyone))
    return out.select("doc_id", "lang", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("keep"))
