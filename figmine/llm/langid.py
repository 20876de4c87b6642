"""Language ID by prediction with partial matching over byte context trees.

For every language, training text fills context trees up to order 4.  A symbol seen in a context costs
log2((n + d) / c) bits (n symbols, d distinct ones, c times this one); an unseen one costs the escape
log2((n + d) / d) and goes on in the next shorter context, down to 8 bits for a byte never seen.  A
context that was never seen costs nothing and is skipped.  Statistics are frozen after training, so the
code length of a whole text is an exact sum over its bytes, and each distinct 5-gram is costed once a
slice for all languages together.

The model is trained on a bounded sample of labelled rows: about ``train_docs`` documents a language, drawn
by a hash of the id, of the ``most_languages`` most frequent languages.  Texts are scored whole.

Defined cases: null texts and texts without letters are ``und`` with score 0; documents with a null id or
language are never learned from; with no training rows at all everything is ``und``; ties go to the
first language by name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figmine.llm.common import bound_batches, fold_column, in_sample, stored
from figmine.llm.kernels import Grams, gram_slices, text_slices

ORDER = 4
#: training documents of a language, about, and bytes of their texts
TRAIN_DOCS, TRAIN_BYTES = 300, 4 << 20
#: languages whose numbers of documents are broadcast, at most
MAX_BROADCAST_LANGUAGES = 100_000
#: languages of one dense table: more of them take more tables, none is left out
TABLE_LANGUAGES = 8
_U = np.uint64
_MASK = [_U((1 << 8 * k) - 1) for k in range(9)]
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True


def _find(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    j = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return j, keys[j] == values


class ContextTrees:
    """Frozen statistics of all languages: by order, the cost of each known gram, fully resolved
    through escapes, and the escape cost of each known context."""

    def __init__(self, languages: list[str], texts: list[pa.Array], order: int = ORDER):
        self.languages, self.order = languages, order
        found = []
        for column in texts:
            grams, counts = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
            for _, _, data, offsets, _ in gram_slices(column):
                g = Grams(data, offsets, order + 1, inverse=False)
                grams.append(g.distinct)
                counts.append(g.counts)
            found.append((np.concatenate(grams), np.concatenate(counts)))
        self.keys, self.cost, self.contexts, self.escape = [], [], [], []
        if not languages:
            return
        for k in range(order + 1):
            keys = np.unique(np.concatenate([g & _MASK[k + 1] for g, _ in found]))
            ctx = np.unique(keys >> _U(8))
            cost, escape = np.full((len(keys), len(languages)), np.nan), np.zeros((len(ctx), len(languages)))
            where = np.searchsorted(ctx, keys >> _U(8))
            for i, (g, c) in enumerate(found):
                count = np.bincount(np.searchsorted(keys, g & _MASK[k + 1]), c, len(keys))
                n = np.bincount(where, count, len(ctx))
                d = np.bincount(where, count > 0, len(ctx))
                with np.errstate(divide="ignore", invalid="ignore"):
                    cost[:, i] = np.where(count > 0, np.log2((n + d)[where] / count), np.nan)
                    escape[:, i] = np.where(n > 0, np.log2((n + d) / d), 0.0)
            unseen = np.isnan(cost)
            shorter = self._resolved(keys, k - 1)
            cost = np.where(unseen, escape[where] + shorter, cost)
            self.keys.append(keys)
            self.cost.append(cost)
            self.contexts.append(ctx)
            self.escape.append(escape)

    def _resolved(self, grams: np.ndarray, k: int) -> np.ndarray:
        """Bits of the last byte of each gram in every language, starting at order k."""
        out = np.zeros((len(grams), len(self.languages)))
        todo = np.arange(len(grams))
        while k >= 0 and len(todo):
            g = grams[todo] & _MASK[k + 1]
            j, hit = _find(self.keys[k], g)
            out[todo[hit]] += self.cost[k][j[hit]]
            todo, g = todo[~hit], g[~hit]
            j, known = _find(self.contexts[k], g >> _U(8))
            out[todo[known]] += self.escape[k][j[known]]
            k -= 1
        out[todo] += 8.0
        return out

    def bits(self, column) -> np.ndarray:
        """Code length of every text in every language."""
        out = np.zeros((len(column), len(self.languages)))
        for first, n, data, offsets, context in gram_slices(column):
            if not len(data):
                continue
            g = Grams(data, offsets, self.order + 1)
            cost = self._resolved(g.distinct, self.order)
            full = np.flatnonzero(np.diff(offsets))
            for i in range(len(self.languages)):
                each = cost[:, i][g.which]
                each[:context] = 0
                out[first + full, i] += np.add.reduceat(each, offsets[:-1][full])
        return out


def has_letters(column) -> np.ndarray:
    out = np.zeros(len(column), bool)
    for first, n, data, offsets in text_slices(column):
        ascii_, other = (np.diff(np.concatenate([[0], np.cumsum(m)])[offsets]) > 0 for m in (_ASCII_LETTER[data], data >= 0x80))
        out[first : first + n] = ascii_
        for r in np.flatnonzero(other & ~ascii_):
            out[first + r] = any(c.isalpha() for c in data[offsets[r] : offsets[r + 1]].tobytes().decode())
    return out


class Languages:
    """Context trees of any number of languages, in tables of a few languages each."""

    def __init__(self, languages: list[str], texts: list[pa.Array], order: int = ORDER, together: int = TABLE_LANGUAGES):
        self.languages = languages
        self.tables = [ContextTrees(languages[i : i + together], texts[i : i + together], order) for i in range(0, len(languages), together)]

    def bits(self, column) -> np.ndarray:
        return np.hstack([np.zeros((len(column), 0)), *(t.bits(column) for t in self.tables)])


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, order: int = ORDER, train_bytes: int = TRAIN_BYTES) -> Languages:
    """Context trees of every language that a document outside fold 0 has.  The sample of a language is the documents
    whose id hash lies below train_docs over its number of documents, or train_bytes over their bytes if that is
    less; a language whose sample is empty keeps the document with the least hash."""
    known = docs.select("doc_id", "text", "lang").where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_column(F.col("doc_id")) != 0))
    hashed = known.withColumn("h", F.xxhash64("doc_id"))
    counts = hashed.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min("h").alias("first"))
    counts = stored(counts, "languages")
    if counts.count() <= MAX_BROADCAST_LANGUAGES:
        counts = F.broadcast(counts)  # else texts would be dealt out by language
    share = F.least(F.lit(float(train_docs)) / F.col("n"), F.lit(float(train_bytes)) / F.greatest("bytes", F.lit(1)))
    drawn = hashed.join(counts, F.col("lang") == F.col("of")).where(in_sample(F.col("doc_id"), share) | (F.col("h") == F.col("first")))
    table = drawn.select("lang", "doc_id", "text").toArrow().sort_by([("lang", "ascending"), ("doc_id", "ascending")])
    languages = sorted(set(table["lang"].to_pylist()))
    by = [table.filter(pc.equal(table["lang"], x))["text"].combine_chunks() for x in languages]
    return Languages(languages, by, order)


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """Per document: lang_pred and score, the posterior of that language under equal priors."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            trees, column = shared.value, batch.column(1)
            valid = has_letters(column) & bool(trees.languages)
            if trees.languages:
                bits = trees.bits(column)
                best = bits.argmin(axis=1)
                gap = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)
                score = 1 / (2.0**-gap).sum(axis=1)
            else:
                best, score = np.zeros(len(column), int), np.zeros(len(column))
            names = [trees.languages[i] if v else "und" for i, v in zip(best, valid, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(np.where(valid, score, 0.0))], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def language_id(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Train on this table and predict all of it: doc_id, held_out, lang_pred, score."""
    out = identify(docs, train(docs, train_docs))
    return out.select("doc_id", F.coalesce(fold_column(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
