"""The corpus operators against brute force, on small tables with every odd case."""

import hashlib
import io
import random
import re
import struct
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from figmine.llm import components as C
from figmine.llm import decontaminate, jaccard, langid, line_dedup, media, mixing, quality, substring, toxicity, url_filter
from figmine.llm.queries import ORACLE_SQL, QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK_WORD = re.compile("[^\x20\x09-\x0d]+")
TEXT_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi".split()


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and blank texts, near and exact copies, shared lines and passages, a very long text, ties."""
    r = random.Random(11)
    say = lambda n: " ".join(r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(n))
    passage, line, base = say(60), "Shared LINE of more than twenty characters", say(120)
    texts = [None, "", "  \n\t ", "one", "two words", "Two words", "x" * 50, base, base, base]
    for i in range(12):
        words = base.split()
        words[i * 7] = f"changed{i}"
        texts.append(" ".join(words))
    texts += [f"{say(30)} {passage} {say(20)}" for _ in range(4)]
    texts += [f"{say(9)}\n{line}\n{say(5)}\n  {line.upper()} " for _ in range(4)]
    texts += ["\n\n", "a\x0bb\x0cc \x85 d e", "ÀÉ ß 漢字 漢字", "Ends.\n", say(4000) + " " + passage, passage[:200], say(12), say(13)]
    out = [(i, t, "en" if i % 3 else None, None if i % 5 == 0 else f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    return out + [out[7], out[0]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(repr(tuple(r[c] for c in names)) for r in df.collect()) == sorted(map(repr, cursor.fetchall()))


# decontamination


def brute_hits(text, items):
    w = TEXT_WORD.findall((text or "").translate(LOW))
    hit, ids = set(), set()
    for item, t in items:
        b = TEXT_WORD.findall(t.translate(LOW))
        k = min(10, len(b))
        wins = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if k else set()
        for i in range(len(w) - k + 1) if k else ():
            if tuple(w[i : i + k]) in wins:
                hit.update(range(i, i + k))
                ids.add(str(item))
    return w, hit, ids


@pytest.mark.parametrize("most", [400_000, 7])
def test_decontaminate(spark, docs, rows, most):
    items = [(1, rows[22][1]), (2, "two WORDS"), (10, "漢字 漢字"), (2, "two WORDS")]
    bench = spark.createDataFrame([*items, (3, None), (None, "one"), (4, "")], "item_id long, text string")
    got = by_id(decontaminate.contamination(docs.withColumnRenamed("n_chars", "n_words"), bench, max_windows=most))
    for i, text, *_ in rows:
        w, hit, ids = brute_hits(text, items)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["contaminated"]) == (len(w), len(hit), len(ids), bool(hit))
        assert got[i]["items_sha256"] == sha(",".join(sorted(ids)))
    kept = by_id(decontaminate.without_contamination(docs, bench, max_windows=most))
    for i, text, *_ in rows:
        w, hit, _ = brute_hits(text, items)
        assert TEXT_WORD.findall((kept[i]["text"] or "").translate(LOW)) == [x for k, x in enumerate(w) if k not in hit]
        if not hit:
            assert kept[i]["text"] == text


# line dedup


def brute_lines(rows, least=3):
    held = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            key = line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOW)
            if len(key) >= 20:
                held.setdefault(key, set()).add(i)
    out = {}
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        keep = []
        for line in lines:
            ids = held.get(line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOW), ())
            if not (len(ids) >= least and max(ids) != i):
                keep.append(line)
        out[i] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


def test_line_dedup(docs, rows):
    want = brute_lines(rows)
    got = by_id(line_dedup.line_dedup_report(docs))
    assert {i: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for i, r in got.items()} == {i: (a, b, sha(c)) for i, (a, b, c) in want.items()}
    kept = by_id(line_dedup.without_repeated_lines(docs.withColumnRenamed("n_chars", "drops")))
    assert all(kept[i]["text"] == (c if b else rows[i][1]) for i, (_, b, c) in want.items())


def test_line_on_partition_bounds(spark):
    """A line that most documents hold is cut by the range bounds and still counts as one."""
    data = [(i, "the very same line in every document\n" + f"own line number {i} of this document", "en", "s", 0) for i in range(300)]
    got = by_id(line_dedup.line_dedup_report(spark.createDataFrame(data, SCHEMA)))
    assert sum(r["n_dropped"] for r in got.values()) == 299 and got[299]["n_dropped"] == 0


# mixing


def test_mixing(spark, docs, rows):
    got = mixing.mix(docs, group_docs=8).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    assert got == mixing.mix(docs, group_docs=8).collect() or sorted(got) == sorted(mixing.mix(docs, group_docs=8).collect())
    size = {i: len(BLANK_WORD.findall(t or "")) for i, t, *_ in rows}
    for r in got:
        assert r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    source = {i: s for i, _, _, s, _ in rows}
    total = {}
    for i, *_ in rows:
        total[source[i]] = total.get(source[i], 0) + size[i]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    fixed = set()
    while True:
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in fixed)) / sum(weight[s] for s in order if s not in fixed)
        over = {s for s in order if s not in fixed and weight[s] * level > 2 * total[s]}
        if not over:
            break
        fixed |= over
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == total[s] and r["target"] == pytest.approx(2 * total[s] if s in fixed else weight[s] * level)


def test_flight_balances():
    r = np.random.default_rng(5)
    size, p = r.integers(1, 200, 500), np.full(500, 0.37)
    out = mixing.land(mixing.flight(p, size, r), size)
    assert set(out) <= {0.0, 1.0}
    assert abs(out.sum() - p.sum()) <= 2 and abs((out * size).sum() - (p * size).sum()) <= 200


# n-gram join


def brute_components(rows, n, percent):
    sets = {}
    for i, t, *_ in rows:
        w = BLANK_WORD.findall((t or "").translate(LOW))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("n,percent,block", [(3, 90, 384), (5, 80, 384), (3, 70, 3)])
def test_jaccard(docs, rows, n, percent, block):
    got = by_id(jaccard.jaccard_components(docs, n, percent, block))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_components(rows, n, percent)


def test_one_of_each(docs, rows):
    want = brute_components(rows, 5, 80)
    kept = {r["doc_id"] for r in jaccard.one_of_each(docs, 5, 80).collect()}
    assert kept == {i for i, (_, c) in want.items() if c == i}


@pytest.mark.parametrize("one_task", [0, 1000])
def test_components(spark, one_task):
    r = random.Random(2)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {x["node"]: x["root"] for x in C.components(spark.createDataFrame(edges, "a long, b long"), one_task=one_task).collect()}
    assert got == {i: find(i) for i in root}


# substring dedup


def test_substring(docs, rows):
    words = {i: BLANK_WORD.findall(t or "") for i, t, *_ in rows}
    low = {}
    for i, w in words.items():
        for k in range(len(w) - 12):
            x = tuple(w[k : k + 13])
            low[x] = min(low.get(x, i), i)
    for chunk in (1 << 22, 2000):
        got = by_id(substring.substring_dedup_report(docs, chunk))
        for i, w in words.items():
            gone = {p for k in range(len(w) - 12) if low[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
            kept = " ".join(x for p, x in enumerate(w) if p not in gone)
            assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), len(gone), sha(kept))


# URL filter


def test_url_filter(spark):
    from datetime import date

    entries = [("domain", "bad.org", "add", date(2024, 1, 10)), ("domain", "bad.org", "remove", date(2024, 2, 1)), ("path", "ok.com/x", "add", date(2024, 1, 5)),
               ("domain", "tie.net", "add", date(2024, 1, 1)), ("domain", "tie.net", "remove", date(2024, 1, 1)), ("domain", None, "add", date(2024, 1, 1))]
    pages = [(1, "http://www.BAD.org/a", date(2024, 1, 10)), (2, "http://bad.org/", date(2024, 2, 1)), (3, "http://bad.org/", date(2024, 1, 9)), (4, "https://ok.com/x/y?q=1", date(2024, 3, 1)),
             (5, "https://ok.com/xy", date(2024, 3, 1)), (6, "http://tie.net", date(2024, 3, 1)), (7, None, date(2024, 3, 1)), (8, "http://notbad.org", date(2024, 1, 15)), (9, "http://bad.org", None)]
    p, e = spark.createDataFrame(pages, "page_id long, url string, fetched_at date"), spark.createDataFrame(entries, "kind string, pattern string, action string, dated date")
    for most in (1000, 0):
        df = url_filter.url_filter(p, e, most)
        assert {r["page_id"] for r in df.collect() if r["blocked"]} == {1, 4} and df.count() == 9
        assert "Python" not in df._jdf.queryExecution().toString()


# media


def test_media_formats():
    r = np.random.default_rng(1)
    a, rgb = r.integers(0, 256, (5, 7), dtype=np.uint8), r.integers(0, 256, (4, 3, 3), dtype=np.uint8)
    assert (media.decode_netpbm(media.encode_pgm(a)) == a).all()
    assert (media.decode(b"P6 # c\n3 4\n255\n" + rgb.tobytes()) == rgb).all()
    assert (media.decode(b"P2\n2 2\n15\n1 2 3 15\n") == [[1, 2], [3, 15]]).all()
    assert (media.decode(b"P1\n3 1\n101\n") == [[0, 255, 0]]).all()
    assert (media.decode(b"P4\n3 1\n\xa0") == [[0, 255, 0]]).all()
    assert media.decode(b"P5\n1 1\n65535\n\x01\x02")[0, 0] == 258
    body = b"".join(rgb[y, :, ::-1].tobytes().ljust(12, b"\0") for y in range(3, -1, -1))
    bmp = b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 3, 4, 1, 24, 0, len(body), 0, 0, 0, 0) + body
    assert (media.decode(bmp) == rgb).all()
    for broken in (b"", b"P5\n2 2\n255\nx", b"BM", bmp[:60], b"P9\n1 1\n1\n1"):
        with pytest.raises(ValueError):
            media.decode(broken)


def test_area_resize():
    a = np.arange(48.0).reshape(6, 8)
    assert np.allclose(media.area_resize(a, 3, 4), a.reshape(3, 2, 4, 2).mean(axis=(1, 3)))
    assert np.allclose(media.area_resize(a, 5, 3).mean(), a.mean())
    assert np.load(io.BytesIO(media.npy_tile(a.astype(np.uint8)))).shape == (32, 32)


def test_media_report(docs, rows):
    got = by_id(media.media_report(docs))
    for i, t, *_ in rows:
        raw = (t or "").encode()
        full = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))


def test_media_columns(spark):
    df = spark.createDataFrame([(1, bytearray(media.encode_pgm(np.zeros((4, 4), np.uint8))), "x"), (2, None, "y"), (3, bytearray(b"junk"), "z")], "id long, content binary, media_hash string")
    r = {x["id"]: x for x in media.media_columns(df).collect()}
    assert r[1]["media_height"] == 4 and r[2]["media_hash"] is None and r[3]["media_tile"] is None


# models


def test_language_id(spark, sf, docs):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.language_id(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in out) >= 0.97 * len(out)
    odd = by_id(langid.language_id(docs))
    assert [odd[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and odd[0]["score"] == 0 and odd[7]["lang_pred"] == "en"
    none = langid.language_id(docs.where("lang is null")).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_code_lengths():
    """Costs in one context by hand: 'aab' is a->a, a->b; method C."""
    import pyarrow as pa

    t = langid.ContextTrees(["x"], [pa.array(["ab"])], order=0)
    # n = 2, d = 2: a seen symbol costs log2(4 / 1), a new one log2(4 / 2) + 8
    assert t.bits(pa.array(["a", "z", "", None])).ravel().tolist() == [2.0, 9.0, 0.0, 0.0]


def test_toxicity(spark, docs):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(d, lab, 3000).join(lab, "doc_id").where("held_out").collect()
    bad, good = ([r["predicted"] for r in out if r["toxic"] == k] for k in (1, 0))
    assert np.mean(bad) > 0.8 and np.mean(good) < 0.02
    none = toxicity.toxicity(docs, lab.limit(0)).collect()
    assert len(none) == docs.count() and all(r["score"] == 0 and r["predicted"] == 0 for r in none)
    assert toxicity.without_toxic(docs.withColumnRenamed("source", "toxicity"), lab.limit(0)).columns[3] == "toxicity"


def test_isotonic():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert (np.diff(y) >= 0).all() and y.tolist() == [0.0, 0.5, 1.0]


def test_quality(spark, docs):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality.quality(d, lab).join(lab, "doc_id").collect()
    good, bad = ([r["keep"] for r in out if r["quality"] == k] for k in (1, 0))
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.3
    odd = by_id(quality.quality(docs, lab.limit(0)))
    assert odd[0]["perplexity"] is None and not odd[0]["keep"] and odd[7]["keep"]


def test_kneser_ney_sums_to_one():
    """In any context, seen or not, the 256 next bytes have total probability 1."""
    import pyarrow as pa

    from figmine.llm.kernels import Grams, gram_slices

    grams = [Grams(d, o, 5, False) for _, _, d, o, _ in gram_slices(pa.array(["banana bandana band", "abracadabra banana"]))]
    g, c = quality._summed(np.concatenate([x.distinct for x in grams]), np.concatenate([x.counts for x in grams]).astype(np.int64))
    orders = quality._orders(g, c)
    pairs = np.bincount((orders[3][0] & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)
    common = quality.Common({k: np.array([(orders[k][1] == i).sum() for i in (1, 2, 3, 4)]) for k in (5, 4, 3)}, pairs)
    for context in (b"bana", b"anan", b"zzzz", b"zzan"):
        base = int.from_bytes(context, "big") << 8
        asked = np.arange(256, dtype=np.uint64) + np.uint64(base)
        assert quality.shard_probabilities(g, c, common, asked).sum() == pytest.approx(1.0)


# empty tables and the pipeline


def test_empty_tables(spark, docs, sf):
    empty, lab, bench = docs.limit(0), spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    for df in (decontaminate.contamination(empty, bench.limit(0)), decontaminate.contamination(empty, bench), line_dedup.line_dedup_report(empty), mixing.mix(empty), jaccard.jaccard_components(empty),
               substring.substring_dedup_report(empty), media.media_report(empty), langid.language_id(empty), toxicity.toxicity(empty, lab), quality.quality(empty, lab)):
        assert df.count() == 0


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        rows = [tuple(r) for r in out.collect()]
        before = [tuple(r) for r in docs.collect()]
        if k < 4:
            assert out.columns == names, name
        if name == "line_dedup":
            want = brute_lines(before)
            assert {r[0]: r[1] for r in rows} == {i: c for i, (_, _, c) in want.items()}
        if name == "ngram_jaccard":
            assert {r[0] for r in rows} == {i for i, (_, c) in brute_components(before, 5, 80).items() if c == i}
        if name == "decontaminate":
            bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            for i, text, *_ in rows:
                w, hit, _ = brute_hits({b[0]: b[1] for b in before}[i], bench)
                assert len(TEXT_WORD.findall((text or "").translate(LOW))) == len(w) - len(hit)
        docs = spark.createDataFrame(rows, out.schema)
    assert corpus_pipeline.run(spark, sf).count() == len(rows)
