"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a given and of a learned lexicon, how many of their hits stand
near a second-person word, rates of capitals, punctuation and digits, and hits that appear only after
undoing letter substitutions (obfuscation).  Trees and calibration are fitted on a bounded sample of
about ``train_docs`` labelled rows outside fold 0: folds 1 to 3 give the learned lexicon and the trees,
fold 4 the isotonic map from margins to probabilities.

Defined cases: null and empty texts have all-zero features and get the score of those; rows whose label
or id is null are not learned from; without usable labels every score is 0; a repeated label row counts
as often as it stands there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figmine.llm.common import bound_batches, fold_column, fresh, in_sample
from figmine.llm.kernels import NON_WORD, Words, text_slices

TRAIN_DOCS = 8000
NEAR = 6
LEXICON = (
    "idiot idiots idiotic moron morons stupid dumb dumbass loser losers scum trash garbage worthless pathetic disgusting "
    "clown fool ugly hate kill die shut bitch bastard asshole fuck fucking shit crap damn jerk freak creep "
    "dumm idioten arschloch scheisse abschaum wertlos nutzlos hasse hurensohn trottel "
    "connard connasse salaud merde débile imbécile crétin ordure nul "
    "estúpido estúpida imbécil basura inútil mierda puta cabrón asqueroso gilipollas"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine euch ihr sie tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split()
_U = np.uint64
_LEET = np.arange(256, dtype=np.uint8)
for _a, _b in zip("013457@$!", "oieastasi", strict=True):
    _LEET[ord(_a)] = ord(_b)
FEATURES = (
    "words", "given", "given_rate", "learned", "learned_rate", "learned_weight", "learned_best", "near_you", "near_you_rate", "you_rate",
    "hidden", "hidden_rate", "upper_rate", "exclaim_rate", "question_rate", "symbol_rate", "digit_rate", "word_length",
)


def word_hashes(words) -> np.ndarray:
    """Hashes of single lower-case words."""
    raw = [w.encode() for w in words]
    offsets = np.cumsum([0, *map(len, raw)])
    w = Words(np.frombuffer(b"".join(raw), np.uint8), offsets, NON_WORD, True)
    return w.hash


class _Set:
    """Membership of word hashes, behind a bit table."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray | None = None):
        order = np.argsort(hashes)
        self.keys = hashes[order]
        self.weights = None if weights is None else weights[order]
        self.table = np.zeros(1 << 16, bool)
        self.table[self.keys >> _U(48)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.table[h >> _U(48)])
        if not len(self.keys):
            return at[:0], at[:0]
        j = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[j] == h[at]
        return at[ok], j[ok]


class Featurizer:
    def __init__(self, learned: dict[int, float]):
        self.given = _Set(np.unique(word_hashes(LEXICON)))
        self.you = _Set(np.unique(word_hashes(SECOND_PERSON)))
        keys = np.array(list(learned), np.int64).view(_U)
        self.learned = _Set(keys, np.array(list(learned.values()), float))
        self.all = _Set(np.unique(np.concatenate([self.given.keys, keys])))

    def rows(self, column) -> np.ndarray:
        out = np.zeros((len(column), len(FEATURES)))
        for first, n, data, offsets in text_slices(column):
            out[first : first + n] = self._slice(n, data, offsets)
        return out

    def _slice(self, n: int, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        w = Words(data, offsets, NON_WORD, True)
        count = w.counts.astype(float)
        per = np.maximum(count, 1)
        size = np.maximum(np.diff(offsets), 1).astype(float)
        by_row = lambda at, weights=None: np.bincount(w.row[at], weights, n).astype(float)
        in_row = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets]).astype(float)
        given, _ = self.given.find(w.hash)
        learned, which = self.learned.find(w.hash)
        weight = self.learned.weights[which] if len(which) else np.zeros(0)
        best = np.zeros(n)
        np.maximum.at(best, w.row[learned], weight)
        hit, _ = self.all.find(w.hash)
        you, _ = self.you.find(w.hash)
        near = np.zeros(len(w.hash) + 1, np.int64)
        for d in range(-NEAR, NEAR + 1):
            at = you + d
            ok = (at >= 0) & (at < len(w.hash))
            ok[ok] = w.row[at[ok]] == w.row[you[ok]]
            near[at[ok]] = 1
        close = hit[near[hit] > 0]
        plain = _LEET[w.data]
        hidden = np.zeros(n)
        if (plain != w.data).any():
            swapped = Words(plain, offsets, NON_WORD, False)
            found, _ = self.all.find(swapped.hash)
            changed = np.concatenate([[0], np.cumsum(plain != w.data)])
            found = found[changed[swapped.end[found]] > changed[swapped.start[found]]]
            hidden = np.bincount(swapped.row[found], minlength=n).astype(float)
        upper = in_row((data >= 0x41) & (data <= 0x5A))
        letters = np.maximum(upper + in_row((data >= 0x61) & (data <= 0x7A)), 1)
        symbols = in_row(np.isin(data, np.frombuffer(b"#$%&*@^~<>|{}[]_=+", np.uint8)))
        length = np.bincount(w.row, w.end - w.start, n)
        columns = (
            np.log1p(count), by_row(given), by_row(given) / per, by_row(learned), by_row(learned) / per, by_row(learned, weight) / per, best,
            by_row(close), by_row(close) / per, by_row(you) / per, hidden, hidden / per, upper / letters, in_row(data == 0x21) / size,
            in_row(data == 0x3F) / size, symbols / size, in_row((data >= 0x30) & (data <= 0x39)) / size, length / per,
        )
        return np.stack(columns, axis=1)


def learned_lexicon(texts, labels: np.ndarray, least: int = 4, lift: float = 3.0, most: int = 400) -> dict[int, float]:
    """Word hashes much more frequent, by documents, under label 1, with their smoothed log odds."""
    hashes, rows = [], []
    for first, _, data, offsets in text_slices(texts):
        w = Words(data, offsets, NON_WORD, True)
        hashes.append(w.hash)
        rows.append(w.row + first)
    h, r = np.concatenate([np.zeros(0, _U), *hashes]), np.concatenate([np.zeros(0, np.int64), *rows])
    if not len(h):
        return {}
    order = np.lexsort((r, h))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[new], r[new]
    cut = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    bad, all_ = np.add.reduceat(labels[r], cut), np.diff(np.append(cut, len(h)))
    n_bad, n_all = labels.sum(), len(labels)
    odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((all_ - bad + 0.5) / (n_all - n_bad + 1))
    good = np.flatnonzero((bad >= least) & (odds > np.log(lift)))
    good = good[np.lexsort((h[cut[good]], -(odds * np.sqrt(bad))[good]))][:most]
    return {int(h[cut[i]].view(np.int64)): float(odds[i]) for i in good}


@dataclass
class Trees:
    """Boosted depth-limited regression trees on binned features, logistic loss."""

    edges: list
    trees: list
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(value) + 1)) - 1):
                go = binned[np.arange(len(x)), feature[node]] > cut[node]
                node = 2 * node + 1 + go
            out += value[node]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, leaf: float = 8.0, l2: float = 2.0) -> Trees:
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    for j, e in enumerate(edges):  # a rare feature: zero against the quantiles of the rest
        some = x[:, j][x[:, j] > 0]
        if len(e) < 4 and len(some):
            edges[j] = np.unique(np.concatenate([e, [some.min() / 2], np.quantile(some, np.linspace(0, 1, 9)[:-1])]))
    binned = np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)], axis=1)
    width = max(len(e) for e in edges) + 1
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p0 / (1 - p0)))
    score, trees, n_nodes = np.full(len(y), base), [], 2 ** (depth + 1) - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, cut, value = np.zeros(n_nodes, np.int64), np.full(n_nodes, width, np.int64), np.zeros(n_nodes)
        node = np.zeros(len(y), np.int64)
        for level in range(depth + 1):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                mine = np.flatnonzero(node == k)
                if not len(mine):
                    continue
                sg, sh = g[mine].sum(), h[mine].sum()
                value[k] = rate * sg / (sh + l2)
                if level == depth:
                    continue
                best = (1e-6, 0, width)
                for j in range(x.shape[1]):
                    bg = np.cumsum(np.bincount(binned[mine, j], g[mine], width))[:-1]
                    bh = np.cumsum(np.bincount(binned[mine, j], h[mine], width))[:-1]
                    bn = np.cumsum(np.bincount(binned[mine, j], minlength=width))[:-1]
                    gain = bg**2 / (bh + l2) + (sg - bg) ** 2 / (sh - bh + l2) - sg**2 / (sh + l2)
                    gain[(bn < leaf) | (len(mine) - bn < leaf)] = -1
                    b = int(gain.argmax())
                    if gain[b] > best[0]:
                        best = (float(gain[b]), j, b)
                feature[k], cut[k] = best[1], best[2]
            if level < depth:
                node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
        score += value[node]
        trees.append((feature, cut, value))
    return Trees(edges, trees, base)


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (mean margin, mean label) of the increasing fit."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []
    for m, v in zip(margin[order], y[order], strict=True):
        blocks.append([float(m), float(v), 1.0])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            m2, v2, n2 = blocks.pop()
            m1, v1, n1 = blocks.pop()
            blocks.append([(m1 * n1 + m2 * n2) / (n1 + n2), (v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2])
    return np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])


@dataclass
class ToxicityModel:
    features: Featurizer
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None

    def score(self, column) -> np.ndarray:
        if self.trees is None:
            return np.zeros(len(column))
        m = self.trees.margin(self.features.rows(column))
        if self.knots is None or not len(self.knots[0]):
            return 1 / (1 + np.exp(-m))
        return np.clip(np.interp(m, *self.knots), 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> ToxicityModel:
    usable = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).where("label_id is not null and toxic in (0, 1)").where(fold_column(F.col("label_id")) != 0)
    n = usable.count()
    drawn = usable.where(in_sample(F.col("label_id"), F.lit(train_docs / max(n, 1))))  # about train_docs rows at most
    base = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("label_id"))
    table = base.select("doc_id", "text", "toxic", fold_column(F.col("doc_id")).alias("fold")).toArrow().sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
    y, fold = table["toxic"].to_numpy().astype(float), table["fold"].to_numpy()
    texts = table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string())
    fit, check = np.flatnonzero(fold != 4), np.flatnonzero(fold == 4)
    if len(fit) < 20 or len(set(y[fit])) < 2:
        return ToxicityModel(Featurizer({}), None, None)
    features = Featurizer(learned_lexicon(texts.take(pa.array(fit)), y[fit]))
    x = features.rows(texts)
    trees = boost(x[fit], y[fit])
    knots = isotonic(trees.margin(x[check]), y[check]) if len(check) >= 20 and len(set(y[check])) == 2 else None
    return ToxicityModel(features, trees, knots)


def score(docs: DataFrame, model: ToxicityModel, name: str = "toxicity") -> DataFrame:
    """``docs`` (any columns, with ``text``) with their score as ``name``; a column of that name is replaced."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(name)
    at = kept.columns.index("text")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(batch.column(at)), pa.float64())], [*batch.schema.names, name])

    schema = type(kept.schema)([*kept.schema.fields]).add(name, "double")
    return kept.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    out = score(docs.select("doc_id", "text"), train(docs, labels, train_docs))
    return out.select("doc_id", F.coalesce(fold_column(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The documents scored below 0.5, with their columns unchanged."""
    name = fresh(docs, "toxicity")
    return score(docs, train(docs, labels, train_docs), name).where(F.col(name) < 0.5).drop(name)
