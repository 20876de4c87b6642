"""Hard cases of the corpus operators: hashes, very long texts, rows that share an id, nulls, stages of the pipeline."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from figmine.llm import decontaminate, jaccard, langid, line_dedup, media, mixing, quality, substring, toxicity
from figmine.llm import common
from figmine.llm.kernels import BLANK, Words, segment_hashes, text_slices
from figmine.llm.queries import ORACLE_SQL
from tests.llm.test_llm import BLANK_WORD, LOW, SCHEMA, TEXT_WORD, brute_components, brute_hits, brute_lines, by_id, sha


def thue_morse(n):
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


PAIRS = [thue_morse(n) for n in (1024, 2048, 4096)]


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA)


def rows_of(texts):
    return [(i, t) for i, t in enumerate(texts)]


def brute_substring(rows):
    words = [(i, BLANK_WORD.findall(t or "")) for i, t, *_ in rows]
    low = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - 12):
                x = tuple(w[k : k + 13])
                low[x] = min(low.get(x, i), i)
    out = []
    for i, w in words:
        gone = {p for k in range(len(w) - 12) if i is not None and low[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return out


def plain(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# hashes that decide


def test_words_and_lines_of_opposite_letters_differ():
    for a, b in PAIRS:
        for _, _, data, offsets in text_slices(pa.array([f"{a} {b}"])):
            w = Words(data, offsets, BLANK, False)
            assert w.hash[0] != w.hash[1] and w.second(np.array([0]), 1)[0] != w.second(np.array([1]), 1)[0]
            for h in segment_hashes(data, w.start, w.end):
                assert h[0] != h[1]


def test_opposite_words_are_not_equal(spark):
    """Documents of Thue-Morse words and their complements have no shingle, window or line in common."""
    texts = []
    for a, b in PAIRS:
        texts += [" ".join([a] * 15), " ".join([b] * 15)]
    docs, rows = table(spark, texts), rows_of(texts)
    assert plain(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id") == sorted((i, n, c) for i, (n, c) in brute_components(rows, 3, 90).items())
    assert plain(substring.substring_dedup_report(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute_substring(rows), key=repr)
    lines = table(spark, [f"{x}\nown {i}" for i, x in enumerate(x for pair in PAIRS for x in pair)])
    assert {r["n_dropped"] for r in line_dedup.line_dedup_report(lines, min_docs=2).collect()} == {0}


def test_anchors_alone_remove(spark, monkeypatch):
    """Without answers from the anchors nothing is removed, in one chunk or in many; a false share removes nothing."""
    r = random.Random(3)
    say = lambda n: " ".join(f"w{r.randint(0, 10**6)}" for _ in range(n))
    passage = say(60)
    texts = [f"{say(20)} {passage} {say(9)}" for _ in range(12)] + [say(300)]
    docs = table(spark, texts)
    for size in (1 << 22, 500):
        chunks = [x[1] for x in common.pack(docs, ["doc_id", "text"], size).collect()]
        nothing = pa.table({c: pa.array([], pa.binary()) for c in ("hashes", "seconds", "lows")})
        for payload in chunks:
            assert not any(gone.any() for _, _, gone in substring._removed(substring._Chunk(payload), nothing))
        assert plain(substring.substring_dedup_report(docs, size), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute_substring(rows_of(texts)), key=repr)


def test_windows_with_equal_first_hashes():
    """Second hashes tell windows apart whose first ones are equal."""
    h, s = np.array([5, 5, 5, 9], np.uint64), np.array([1, 2, 7, 1], np.uint32)
    j, hit = substring._find(h, s, np.array([5, 5, 5, 9, 8], np.uint64), np.array([7, 1, 3, 1, 1], np.uint32))
    assert hit.tolist() == [True, True, False, True, False] and j[hit].tolist() == [2, 0, 3]
    first, second, low, high = substring._lowest(np.array([5, 9, 5, 5], np.uint64), np.array([3, 4, 1, 2]), np.array([1, 1, 2, 1], np.uint32))
    assert [x.tolist() for x in (first, second, low, high)] == [[5, 5, 9], [1, 2, 1], [2, 1, 4], [3, 1, 4]]


@pytest.mark.parametrize("name", ["op5_ngram_jaccard", "op6_substring_dedup"])
def test_matches_sql_in_many_chunks(spark, name):
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    df = substring.substring_dedup_report(docs, 20_000) if name.startswith("op6") else jaccard.jaccard_components(docs, block_rows=2)
    assert plain(df, *names) == sorted(cursor.fetchall(), key=repr)


# n-gram join


def test_very_long_text_in_one_partition(spark):
    """1.4 million words, with one shuffle partition: more blocks than 16 bits count."""
    text = " ".join(f"w{i}" for i in range(1_400_000))
    near = text.replace(" w77 ", " x77 ")
    docs = table(spark, [text, "short one here", near])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert plain(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id") == [(0, 1_399_998, 0), (1, 1, 1), (2, 1_399_998, 0)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sets_with_equal_keys(spark):
    """With keys of five bits nearly all sets clash; the second key tells them apart."""
    r = random.Random(4)
    texts = [" ".join(r.choice("abcdef") for _ in range(r.randint(0, 40))) for _ in range(120)]
    texts += texts[:20]
    got = jaccard.jaccard_components(table(spark, texts), 3, 80, bits=5)
    assert plain(got, "doc_id", "n_shingles", "component_id") == sorted(((i, n, c) for i, (n, c) in brute_components(rows_of(texts), 3, 80).items()), key=repr)


def test_sparse_overlaps(monkeypatch):
    r = np.random.default_rng(0)
    for trial in range(60):
        monkeypatch.setattr(jaccard, "COLUMN_BLOCK", int(r.integers(3, 300)))
        monkeypatch.setattr(jaccard, "_PIECE", int(r.integers(1, 80)))
        pool, share = int(r.integers(5, 300)), r.uniform(0.05, 1)
        rows = lambda k: [np.sort(r.choice(pool, max(1, int(pool * r.uniform(0.5, 1) * share)), replace=False)).astype(np.uint64) for _ in range(k)]  # noqa: E731, B023
        left, right = rows(r.integers(1, 9)), rows(r.integers(1, 9))
        count, alive = jaccard.overlaps(left, right, 80)
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                both = len(np.intersect1d(a, b))
                linked = 100 * both >= 80 * (len(a) + len(b) - both)
                assert alive[i, j] == linked and (not linked or count[i, j] == both)


# decontamination


@pytest.mark.parametrize("most", [400_000, 2])
def test_rows_that_share_an_id(spark, most):
    """Repeated ids with different texts and null ids: every row by its own text, in one block or by the join."""
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    texts = [(1, f"x {item} y"), (1, "no hit in here"), (None, "two words"), (None, f"{item}"), (2, None), (2, ""), (1, f"x {item} y")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(texts)], "doc_id long, text string, `__row` long")
    items = [(7, item), (8, "TWO words"), (9, "never seen")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, t in texts:
        w, hit, ids = brute_hits(t, items)
        want.append((i, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    got = decontaminate.contamination(docs, bench, max_windows=most)
    assert plain(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(want, key=repr)
    kept = decontaminate.without_contamination(docs, bench, max_windows=most)
    assert kept.columns == docs.columns
    cut = {r["__row"]: r for r in kept.collect()}
    for k, (i, t) in enumerate(texts):
        w, hit, _ = brute_hits(t, items)
        assert cut[k]["doc_id"] == i and TEXT_WORD.findall((cut[k]["text"] or "").translate(LOW)) == [x for p, x in enumerate(w) if p not in hit]
        if not hit:
            assert cut[k]["text"] == t
    assert decontaminate.contamination(docs, bench.limit(0), max_windows=most).where("contaminated").count() == 0


def test_bloom_has_no_false_negative():
    h = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    b = decontaminate.Bloom(16)
    b.add(h[:2000])
    assert b.find(h[:2000]).all() and b.find(h[2000:]).mean() < 0.2


# line dedup


def test_lines_of_rows_that_share_an_id(spark):
    line, other = "a line of more than twenty letters", "another line of more than twenty letters"
    data = [(1, f"{line}\nkeep me\n{other}"), (1, f"own text\n{line}"), (2, f"{line}\n{line}"), (3, f"x\n{line}"), (None, line), (None, line), (4, None), (5, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = plain(line_dedup.line_dedup_report(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    want = [(1, 3, 1, sha(f"keep me\n{other}")), (1, 2, 1, sha("own text")), (2, 2, 2, sha("")), (3, 2, 0, sha(f"x\n{line}")), (None, 1, 0, sha(line)), (None, 1, 0, sha(line)), (4, 1, 0, sha("")), (5, 1, 0, sha(""))]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("batch", [1, 2, 3, 7, 1000])
def test_stream_in_batches_of_any_size(batch):
    """The stream over cut partitions gives what a look at all rows gives."""
    r = random.Random(batch)
    rows = sorted({(r.randint(0, 6), r.randint(0, 1), -r.randint(0, 9)) for _ in range(150)})
    rows = [(a, b, -c) for a, b, c in rows]
    cuts = sorted(r.sample(range(len(rows) + 1), 4))
    out = []
    for part in (rows[i:j] for i, j in zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        stream = line_dedup._Stream(3)
        for k in range(0, len(part), batch):
            h1, h2, ids = zip(*part[k : k + batch], strict=True)
            out += [x for b in stream.take(pa.record_batch({"h1": pa.array(h1), "h2": pa.array(h2), "doc_id": pa.array(ids), "print": pa.array([0] * len(ids)), "first": pa.array([0] * len(ids)), "at": pa.array([common.small_ints(np.array([i * 100 + 10 * a + b])) for a, b, i in part[k : k + batch]], pa.binary())})) for x in b.to_pylist()]
        out += [x for b in stream.end() for x in b.to_pylist()]
    lost = {int(x) for r_ in out if r_["h1"] is None for x in common.read_small_ints(r_["at"])}
    across = defaultdict(lambda: [0, -1])
    for x in out:
        if x["h1"] is not None:
            across[x["h1"], x["h2"]][0] += x["n"]
            across[x["h1"], x["h2"]][1] = max(across[x["h1"], x["h2"]][1], x["doc_id"])
    for x in out:
        if x["h1"] is not None and across[x["h1"], x["h2"]][0] >= 3 and x["doc_id"] != across[x["h1"], x["h2"]][1]:
            lost |= {int(p) for p in common.read_small_ints(x["at"])}
    held = defaultdict(set)
    for a, b, i in rows:
        held[a, b].add(i)
    assert lost == {i * 100 + 10 * a + b for (a, b), ids in held.items() if len(ids) >= 3 for i in ids - {max(ids)}}


# substring dedup


def test_substring_keeps_rows_with_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    data = [(None, text), (None, text), (3, text), (1, text), (3, text), (4, None)]
    got = substring.substring_dedup_report(spark.createDataFrame(data, "doc_id long, text string"))
    assert plain(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute_substring(data), key=repr)
    assert substring.without_repeats(spark.createDataFrame(data, "doc_id long, text string")).count() == 6


# mixing


def test_taken_comes_near_the_target(spark):
    r = random.Random(6)
    data = [(i, "w " * r.choice([1, 5, 60, r.randint(1, 400)]), "en", r.choice(["a", "a", "a", "b", "c", None]), 0) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(data, SCHEMA), group_docs=64).collect()
    taken, target, size, docs, most = Counter(), {}, {}, Counter(), Counter()
    source = {i: s for i, _, _, s, _ in data}
    for x in got:
        s = source[x["doc_id"]]
        taken[s] += x["taken"]
        target[s], size[s] = x["target"], x["source_size"]
        most[s] = max(most[s], x["size"])
        docs[s] += x["taken"] // x["size"]
    n = Counter(source.values())
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.01 * target[s]
        assert abs(docs[s] - n[s] * target[s] / size[s]) <= 20  # documents are balanced too


def test_mixed_rows(spark):
    data = [(1, "a b c", "s"), (1, "a b c", "s"), (1, "other words of one id", "s"), (None, "x y", None), (None, "z", "t"), (2, None, "s"), (3, "", "t")]
    docs = spark.createDataFrame([(i, t, s, k, "extra") for k, (i, t, s) in enumerate(data)], "doc_id long, text string, source string, place long, Size string")
    got = {r["place"]: r for r in mixing.mixed(docs).collect()}
    assert sorted(got) == list(range(7)) and mixing.mixed(docs).columns == ["doc_id", "text", "source", "place", "size", "source_size", "target", "taken"]
    for k, (i, t, _) in enumerate(data):
        assert (got[k]["doc_id"], got[k]["text"], got[k]["size"]) == (i, t, len((t or "").split())) and got[k]["taken"] <= 2 * got[k]["size"]


# media


def test_broken_samples():
    for broken in (b"P2\n1 1\n255\n99999999999999999999999", b"P1\n1 1\n9", b"P2\n1 1\n255\n300", b"P2\n1 1\n255\n-5", b"P5\n1 1\n100\n\xff", b"P2\n1 1\n255\nx", b"P6\n99999 99999\n255\n", b"P4\n9 1\n\x00", b"P2\n1 1\n255"):
        with pytest.raises(ValueError):
            media.decode(broken)


def test_strips_give_the_same_means(monkeypatch):
    r = np.random.default_rng(2)
    for shape in ((1, 1), (50, 3), (3, 50), (40, 33, 3)):
        a = r.integers(0, 256, shape, dtype=np.uint8)
        whole = media.area_resize(a, 7, 5)
        integral = np.zeros((a.shape[0] + 1, a.shape[1] + 1, *a.shape[2:]))
        integral[1:, 1:] = a.cumsum(axis=0, dtype=float).cumsum(axis=1)
        monkeypatch.setattr(media, "STRIP", 16)
        assert np.allclose(media.area_resize(a, 7, 5), whole)
        monkeypatch.setattr(media, "STRIP", 1 << 18)
        y, x = a.shape[0] / 7, a.shape[1] / 5
        for i in range(7):  # means over exact areas, cell by cell
            for j in range(5):
                wy = np.clip(np.minimum(np.arange(a.shape[0]) + 1, (i + 1) * y) - np.maximum(np.arange(a.shape[0]), i * y), 0, None)
                wx = np.clip(np.minimum(np.arange(a.shape[1]) + 1, (j + 1) * x) - np.maximum(np.arange(a.shape[1]), j * x), 0, None)
                assert np.allclose(np.tensordot(wx, np.tensordot(wy, a.astype(float), (0, 0)), (0, 0)) / (x * y), whole[i, j])


def test_media_report_columns(spark):
    texts = ["short", None, "", "long " * 500, "Straße 漢字"]
    for x in media.media_report(table(spark, texts)).collect():
        raw = (texts[x["doc_id"]] or "").encode()
        full = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        held = b"P5\n24 %d\n255\n" % (len(full) // 24) + full
        assert (x["media_bytes"], x["media_sha256"]) == (len(held), hashlib.sha256(held).hexdigest())
        a = np.frombuffer(full, np.uint8).reshape(-1, 24)
        small = np.round(media.area_resize(a, 8, 9), 6)
        assert x["feature"].split(":")[0] == np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


# models against brute force


def brute_kneser_ney(train, order=5):
    """Probability of the last byte of a gram, by the textbook: dictionaries, one gram at a time."""
    grams = {k: Counter() for k in range(1, order + 1)}
    for t in train:
        raw = b"\0" * (order - 1) + t
        for i in range(order - 1, len(raw)):
            grams[order][raw[i - order + 1 : i + 1]] += 1
    for k in range(order - 1, 0, -1):  # continuation counts
        for g in grams[k + 1]:
            grams[k][g[1:]] += 1
    off = {k: quality.discounts(np.array([sum(c == i for c in grams[k].values()) for i in (1, 2, 3, 4)])) for k in grams}
    total, spare = {}, {}
    for k, found in grams.items():
        for g, c in found.items():
            total[k, g[:-1]] = total.get((k, g[:-1]), 0) + c
            spare[k, g[:-1]] = spare.get((k, g[:-1]), 0.0) + min(off[k][min(c, 3) - 1], c)

    def p(g):
        if not g:
            return 1 / 256
        k, context, lower = len(g), g[:-1], p(g[1:])
        if (k, context) not in total:
            return lower
        c = grams[k].get(g, 0)
        own = max(c - off[k][min(c, 3) - 1], 0) / total[k, context] if c else 0.0
        return own + spare[k, context] / total[k, context] * lower

    return p


def test_quality_against_brute_force(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice(["the", "cat", "sat", "on", "mats", "éh", "42"]) for _ in range(r.randint(0, 30))) for _ in range(80)] + ["zq xv jk", None, "", "漢字"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    labels = spark.createDataFrame([(i, 1 if i < 60 else 0, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    fold = {x["doc_id"]: x["fold"] for x in docs.select("doc_id", common.fold_column(docs["doc_id"]).alias("fold")).collect()}
    p = brute_kneser_ney([texts[i].encode() for i in range(60) if fold[i] != 0])
    for x in quality.quality(docs, labels).collect():
        raw = (texts[x["doc_id"]] or "").encode()
        if not raw:
            assert x["perplexity"] is None and not x["keep"]
            continue
        padded = b"\0" * 4 + raw
        bits = -sum(math.log2(p(padded[i : i + 5])) for i in range(len(raw)))
        assert x["perplexity"] == pytest.approx(2 ** (bits / len(raw)), rel=1e-4)
        assert x["keep"] == (x["perplexity"] <= x["threshold"])


def test_replicas_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    one = plain(quality.quality(docs, labels), "doc_id", "perplexity", "keep")
    monkeypatch.setattr(quality, "REPLICA_DOCS", 60)
    assert plain(quality.quality(docs, labels), "doc_id", "perplexity", "keep") == one


def brute_ppm(train, order=4):
    seen = defaultdict(Counter)
    for t in train:
        raw = b"\0" * order + t
        for i in range(order, len(raw)):
            for k in range(order + 1):
                seen[raw[i - k : i]][raw[i]] += 1

    def bits(t):
        raw, out = b"\0" * order + t, 0.0
        for i in range(order, len(raw)):
            for k in range(order, -1, -1):
                found = seen.get(raw[i - k : i])
                if not found:
                    continue
                n, d = sum(found.values()), len(found)
                if raw[i] in found:
                    out += math.log2((n + d) / found[raw[i]])
                    break
                out += math.log2((n + d) / d)
            else:
                out += 8
        return out

    return bits


def test_code_lengths_against_brute_force():
    train = {"de": ["der hund und die katze", "das ist ein haus"], "en": ["the dog and the cat", "this is a house", "a"]}
    trees = langid.ContextTrees(sorted(train), [pa.array(train[x]) for x in sorted(train)])
    asked = ["the house", "die katze ist", "", "zz", "the dog and the cat", "漢字"]
    got = trees.bits(pa.array(asked))
    for i, name in enumerate(sorted(train)):
        cost = brute_ppm([t.encode() for t in train[name]])
        assert np.allclose(got[:, i], [cost(t.encode()) for t in asked])


def test_toxicity_features():
    f = toxicity.Featurizer({})
    x = dict(zip(toxicity.FEATURES, f.rows(pa.array(["You IDIOT! you st0pid 1diot, are far far far far far far scum?"]))[0], strict=True))
    words = 13
    assert x["words"] == pytest.approx(math.log1p(words)) and x["given"] == 2  # idiot, scum
    assert x["near_you"] == 1 and x["you_rate"] == pytest.approx(2 / words) and x["hidden"] == 1  # 1diot
    assert x["exclaim_rate"] == pytest.approx(1 / 62) and x["question_rate"] == pytest.approx(1 / 62)
    empty = f.rows(pa.array([None, ""]))
    assert (empty == 0).all()


def test_one_tree_is_the_best_split():
    """A tree of depth 1 takes the cut with the largest gain, and its leaves are the Newton steps."""
    r = np.random.default_rng(9)
    x = r.integers(0, 12, (400, 3)).astype(float)
    y = (x[:, 1] + r.normal(0, 2, 400) > 6).astype(float)
    t = toxicity.boost(x, y, rounds=1, depth=1, rate=1.0, leaf=1, l2=2.0)
    base, best = y.mean(), (0, None)
    g, h = y - base, np.full(400, base * (1 - base))
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 2.0)
    for j in range(3):
        for v in t.edges[j]:
            m = x[:, j] >= v
            if m.any() and (~m).any():
                best = max(best, (score(m) + score(~m) - score(np.ones(400, bool)), (j, v)))
    j, v = best[1]
    m = x[:, j] >= v
    want = np.where(m, g[m].sum() / (h[m].sum() + 2.0), g[~m].sum() / (h[~m].sum() + 2.0)) + math.log(base / (1 - base))
    assert np.allclose(t.margin(x), want)


def test_isotonic_against_brute_force():
    """The fit at each point is the largest minimum, over starts, of means up to any end."""
    r = np.random.default_rng(10)
    x, y = np.arange(40.0), r.integers(0, 2, 40).astype(float)
    knots = toxicity.isotonic(x, y)
    want = [max(min(y[a : b + 1].mean() for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    blocks = {round(v, 9) for v in want}
    assert {round(v, 9) for v in knots[1]} == blocks and (np.diff(knots[1]) > 0).all()


def test_sample_share(spark):
    ids = spark.range(4000)
    for share in (0.0, 0.25, 1.0, 3.0):
        n = ids.where(common.in_sample(ids["id"], common.F.lit(share))).count()
        assert abs(n - 4000 * min(share, 1)) < 150 and (share < 1 or n == 4000)


# pipeline


ODD = [(1, "dup text of one id " * 6, "en", "a"), (1, "another text under the same id " * 5, "en", "a"), (None, None, None, None), (None, "null id with words", "en", None), (2, "", "de", "a"), (3, "  \n\n ", "en", "b"),
       (4, "shared line that is long enough\nown four", "en", "b"), (5, "shared line that is long enough\nown five", "en", "b"), (6, "shared line that is long enough\nown six", "en", "c"), (6, "shared line that is long enough\nown six", "en", "c"),
       (7, "dup text of one id " * 6, "en", "c")]


def odd_documents(spark):
    data = [(i, t, lang, s, None if t is None else len(t), 1.5, "clash", k) for k, (i, t, lang, s) in enumerate(ODD)]
    return spark.createDataFrame(data, SCHEMA + ", taken double, toxicity string, place long")


def test_stages_on_odd_rows(spark, sf):
    """Nulls, repeated rows and clashing names in every stage; every stage says what it keeps."""
    docs = odd_documents(spark)
    keeps = {"toxicity": set(range(11)), "line_dedup": set(range(11)), "decontaminate": set(range(11)), "ngram_jaccard": set(range(10))}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert {r["place"] for r in out.collect()} == keeps[name], name
        assert sorted(r["place"] for r in out.collect()) == sorted(keeps[name]), name
    lines = {r["place"]: r["text"] for r in corpus_pipeline.drop_repeated_lines(spark, docs, sf).collect()}
    assert [lines[k] for k in (6, 7, 8, 9, 2)] == ["own four", "own five", ODD[8][1], ODD[9][1], None]
    mixed = corpus_pipeline.mix_sources(spark, docs, sf).collect()
    places = [r["place"] for r in mixed]
    assert len(places) == len(set(places)) and not {2, 4, 5} & set(places)
    for r in mixed:
        assert (r["doc_id"], r["text"]) == ODD[r["place"]][:2] and r["taken"] in (r["size"], 2 * r["size"])


def test_stages_on_empty_tables(spark, sf):
    docs = odd_documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0, name


def test_toxic_and_mix_stages(spark):
    """The stages against their operators' own scores and targets."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    assert {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, sf).collect()} == {i for i, s in scores.items() if s < 0.5}
    mixed = {r["doc_id"]: r for r in corpus_pipeline.mix_sources(spark, docs, sf).collect()}
    report = {r["doc_id"]: r for r in mixing.mix(docs).where("taken > 0").collect()}
    assert set(mixed) == set(report) and all(mixed[i]["taken"] == report[i]["taken"] for i in report)


def test_intermediates_go(spark, tmp_path, sf, monkeypatch):
    monkeypatch.setattr("figmine.sinks.shared.shared_root", lambda _: f"file://{tmp_path}")
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0
    left = [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")]
    assert len(left) == 1 and left[0].startswith("pipeline-mix_sources")
