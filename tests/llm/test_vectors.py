"""Hard negatives, near vectors and token alignment against brute force, and their hard cases."""

import hashlib
import math
import threading
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from figmine.llm import alignment, hard_negatives, near_vectors
from figmine.llm.common import documents, scratch, stored
from figmine.llm.queries import TOKENIZERS

ROWS = "vec_id long, embedding array<double>, label int"


def vectors(seed, n, dim, groups=4):
    """Clustered vectors, with copies and near copies."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim))
    v = centre[rng.integers(groups, size=n)] * 0.5 + rng.normal(size=(n, dim)) * 0.4
    v[n // 2 : n // 2 + n // 10] = v[0]
    v[n - n // 5 :] = v[1] + rng.normal(size=(n - (n - n // 5), dim)) * np.linspace(0, 0.15, n - (n - n // 5))[:, None]
    return [(i, [float(x) for x in v[i]], int(rng.integers(3))) for i in range(n)]


ODD = [
    (None, [1.0, 2.0], 1), (900, None, 1), (901, [1.0, None], 1), (902, [float("nan"), 1.0], 1), (903, [float("inf"), 1.0], 1), (904, [0.0, 0.0], 1),
    (905, [1.0, 2.0], None), (906, [], 1), (907, [1.0, 2.0, 3.0], 1), (908, [1.0, 2.0, 3.0], 1), (909, [1e200, 2e200, 3e200], 1), (910, [1e-200, 2e-200, 3e-200], 1),
]


def near_by_hand(rows, threshold):
    good = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]

    def cosine(a, b):
        a, b = (np.array(v) / max(map(abs, v)) for v in (a, b))
        return float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))

    links = defaultdict(set)
    for i, a in enumerate(good):
        for j in range(i):
            if a[2] == good[j][2] and len(a[1]) == len(good[j][1]) and cosine(a[1], good[j][1]) >= threshold:
                links[i].add(j), links[j].add(i)
    out, left = {}, set(range(len(good)))
    while left:
        todo, part = [left.pop()], set()
        while todo:
            i = todo.pop()
            part.add(i)
            todo += [j for j in links[i] if j not in part]
        left -= part
        for i in part:
            out[id(good[i])] = (len(links[i]), min(good[j][0] for j in part))
    return sorted(((r[0], *(c := out.get(id(r), (0, r[0]))), r[0] is not None and r[0] == c[1]) for r in rows), key=repr)


@pytest.mark.parametrize("threshold", [0.93, 0.5])
def test_near_vectors(spark, monkeypatch, threshold):
    monkeypatch.setattr(near_vectors, "LEAST_ROWS", 16)  # several blocks a label
    rows = vectors(1, 400, 12) + [r for r in ODD if r[1] is None or len(r[1]) != 2 or r[0] != 907] + [(907, [1.0, 2.0, 3.0], 1)]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, ROWS).repartition(5), threshold)
    assert sorted(map(tuple, got.collect()), key=repr) == near_by_hand(rows, threshold)


def test_near_vectors_bounds_hold():
    rng = np.random.default_rng(3)
    u = near_vectors.unit(rng.normal(size=(200, 1500)) ** 3)
    codes, scale, length, error = near_vectors.quantised(u)
    exact, near = u @ u.T, near_vectors._product(codes, codes) * scale[:, None] * scale
    bound = length[:, None] * error + error[:, None] * (length + error)
    assert (np.abs(exact - near) <= bound).all() and codes.dtype == np.int8


def test_near_vectors_repeats_and_empty(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [2.0, 0.0], 1), (3, [0.0, 3.0], 1)]
    got = sorted(map(tuple, near_vectors.near_vectors(spark.createDataFrame(rows, ROWS)).collect()))
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 1, False)]
    assert near_vectors.near_vectors(spark.createDataFrame([], ROWS)).collect() == []
    wide = spark.createDataFrame([(*r, "x", 5) for r in rows], ROWS + ", kept_id string, p int")
    kept = near_vectors.without_near_vectors(wide)
    assert kept.columns == wide.columns and sorted(r[0] for r in kept.collect()) == [1, 1, 1]


def negatives_by_hand(rows, anchor, low=80, high=100):
    good = {}
    for r in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0], r[2], r[1])):
        good.setdefault(r[0], (r[0], [math.floor(256 * x) for x in r[1]], r[2]))
    score = lambda a, b: max(1 - 2**63, min(2**63 - 1, sum(x * y for x, y in zip(a[1], b[1], strict=True))))
    out = []
    for a in good.values():
        if not anchor(a[0]):
            continue
        others = sorted(((-score(a, b), b[0], b[2] == a[2]) for b in good.values() if b[0] != a[0] and len(b[1]) == len(a[1])))
        for s, p, _ in [o for o in others if o[2]][:5]:
            hits = [o for o in others if not o[2] and low * -s <= 100 * -o[0] <= high * -s][:5]
            out += [(a[0], p, k + 1, o[1], -s, -o[0]) for k, o in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("tree_rows", [20, 10_000])
def test_hard_negatives(spark, monkeypatch, tree_rows):
    monkeypatch.setattr(hard_negatives, "ROOTS", 3)  # blocks of roots and of anchors
    monkeypatch.setattr(hard_negatives, "ASKED", 7)
    odd = [r for r in ODD if r[0] not in (909, 910)] + [(911, [1e12, 2.0, 3.0], 2), (912, [3e12, 2.0, 1.0], 2), (913, [2e12, 0.0, -1.0], 1)]
    rows = vectors(2, 300, 6) + odd + [(10, [0.1] * 6, 0), (10, [0.1] * 6, 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], ROWS + ", cell string").repartition(4)
    got = hard_negatives.hard_negatives(df, F.expr("vec_id % 10 = 0 or vec_id > 900"), tree_rows=tree_rows)
    assert sorted(map(tuple, got.collect())) == negatives_by_hand(rows, lambda i: i % 10 == 0 or i > 900)


def test_hard_negatives_empty(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], ROWS), F.lit(True)).collect() == []
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 2)], ROWS)
    assert hard_negatives.hard_negatives(alone, F.lit(True)).collect() == []


def test_ball_tree_prunes_and_keeps_ties():
    rng = np.random.default_rng(5)
    v = np.floor(np.concatenate([rng.normal(size=(2000, 8)) * 5 + c for c in (200, -200, 0)]))
    v[100:140] = v[100]
    labels = np.repeat([1, 2, 3], 2000)
    tree = hard_negatives.BallTree.unpacked(hard_negatives.BallTree(np.arange(6000), labels, v).packed())
    none = np.array([-(2**62)])
    q = hard_negatives.Queries(np.array([100]), np.array([1]), v[[100]], np.array([0]), none, -none, none, 5, True)
    computed = tree.search(q)
    s = (v @ v[100]).astype(int)
    best = sorted((-s[i], i) for i in range(2000) if i != 100)[:5]
    assert computed < 2000 and list(zip((-q.score[0]).tolist(), q.found[0].tolist(), strict=True)) == best


# ---- alignment


TEXTS = [
    "the cat sat", "", None, " ", "  two  spaces \n\n and\nlines\t\ttabs \r\n", "don't we'll IT'S 'quoted' a'b", "x▁y", "é à ñandú ß÷×", "日本語 テキスト 🙂🙃 　  x  y", "<s></s><0x41><|endoftext|>",
    "a1b22c333, 1,234.56%! (foo)[bar]{baz}", "=" * 300, "abc" * 200, "\0\x01 nul", "\n", "trailing space ", "\n\nlead", "the cat sat", "U+2581 ▁", "́combining é", "﻿bom", "ends with é \nand é\n\u0085z",
]


def aligned_by_hand(rows):
    """(reports, links) by walking both token lists of every whole text."""
    import sentencepiece
    import tokenizers

    a_tok = tokenizers.Tokenizer.from_file(TOKENIZERS[0])
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=TOKENIZERS[1])
    pair = alignment.Pair.of(*TOKENIZERS).load()
    counts, made = Counter(), []
    for d, text in rows:
        raw = (" " + (text or "")).encode()
        a, b = (a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)) if text else ([], [])
        x, y = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
        if not text or b"".join(x) != raw or b"".join(y) != raw:
            made.append((d, [], [], [], []))
            continue
        ends = [np.cumsum([len(t) for t in side]).tolist() for side in (x, y)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([i for i, e in zip(a, ends[0], strict=True) if lo < e <= hi], [i for i, e in zip(b, ends[1], strict=True) if lo < e <= hi]) for lo, hi in zip([0, *cuts], cuts, strict=False)]
        spans = [list(zip([0, *e], e, strict=False)) for e in ends]
        links = [(i, a[i], j, b[j]) for i, (p, q) in enumerate(spans[0]) for j, (r, s) in enumerate(spans[1]) if p < s and r < q]
        counts.update((k[1], k[3]) for k in links)
        made.append((d, a, b, groups, links))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for d, a, b, groups, links in made:
        of = [counts[k[1], k[3]] for k in links]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sum(n == top[k[3]] for n, k in zip(of, links, strict=True)), sum(of), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=repr), sorted(((m[0], *k) for m in made for k in m[4]), key=repr)


def test_alignment_of_odd_texts(spark, monkeypatch):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (0, "the cat sat")]
    pair = alignment.Pair.of(*TOKENIZERS)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, chunk string").repartition(3)
    want, links = aligned_by_hand(rows)
    assert sorted(map(tuple, alignment.alignment_report(df, pair).collect()), key=repr) == want
    one = [r for i, r in enumerate(rows) if r[0] is not None and i < len(TEXTS)]
    got = alignment.document_links(spark.createDataFrame(one, "doc_id long, text string"), pair)
    assert sorted(((r.doc_id, r.a_pos, r.a, r.b_pos, r.b) for r in got.collect()), key=repr) == aligned_by_hand(one)[1]
    # without safe cuts a unit is a whole text: the same rows
    load = alignment.Pair.load

    def uncut(self):
        load(self)
        self.plain, self.cuts = False, None
        return self

    monkeypatch.setattr(alignment.Pair, "load", uncut)
    held = alignment.Pair(*pair.files)
    units = spark.createDataFrame([(i, 1, " " + t) for i, t in one if t], "unit long, n long, text string")
    whole = [g for b in [uncut(held).encode([r.text for r in units.collect()])] for g in b]
    assert [len(g[0]) for g in whole if g[2]] == [r[1] for r in sorted(aligned_by_hand(one)[0], key=lambda r: r[0]) if r[1]]


def test_alignment_of_documents(spark, sf):
    df = documents(spark, sf)
    want, _ = aligned_by_hand([tuple(r) for r in df.select("doc_id", "text").limit(60).collect()])
    part = df.where(F.col("doc_id").isin([r[0] for r in want]))
    assert sorted(map(tuple, alignment.alignment_report(part, alignment.Pair.of(*TOKENIZERS)).collect()), key=repr) == want


def test_alignment_of_nothing(spark):
    assert alignment.alignment_report(spark.createDataFrame([], "doc_id long, text string"), alignment.Pair.of(*TOKENIZERS)).collect() == []


def test_long_text_without_cuts(spark):
    rows = [(1, "ab" * 100_000), (2, "x " * 100_000)]
    got = alignment.alignment_report(spark.createDataFrame(rows, "doc_id long, text string"), alignment.Pair.of(*TOKENIZERS)).collect()
    assert {r.doc_id: r.n_links - r.n_a - r.n_b + r.n_groups for r in got} == {1: 0, 2: 0} and all(r.n_a > 1000 for r in got)


# ---- runs


def test_two_runs_at_once(spark):
    """Each run deletes its own tables, in its own thread, also after a failure."""
    outside = stored(spark.range(3), "kept")
    with scratch(spark):
        inside, seen = stored(spark.range(4), "gone"), []

        def other():
            with scratch(spark):
                seen.append(stored(spark.range(5), "other").count())

        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert inside.count() == 4 and seen == [5]
        path = inside.inputFiles()[0]
    assert outside.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()
    with pytest.raises(ValueError), scratch(spark):
        path = stored(spark.range(2), "lost").inputFiles()[0]
        raise ValueError
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()
