"""Files, encoders, topics, neighbours and pixels against derived cases."""

import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from figmine import vocab
from figmine.functions import boxes as B
from figmine.functions import text as T
from figmine.operators import classify as K
from figmine.operators import encoders as E
from figmine.operators import topics as P
from figmine.settings import Settings
from figmine.sinks import shared
from figmine.sinks.images import save_images
from figmine.sources import documents as D
from figmine.vision import backend, png
from figmine.vision import rules as R


def flood(mask):
    """Boxes and areas of 8-connected regions, pixel by pixel."""
    seen, out = np.zeros(mask.shape, bool), []
    for y, x in zip(*np.nonzero(mask), strict=True):
        if seen[y, x]:
            continue
        seen[y, x], todo, found = True, [(y, x)], []
        while todo:
            a, b = todo.pop()
            found.append((a, b))
            for u in range(max(0, a - 1), min(mask.shape[0], a + 2)):
                for v in range(max(0, b - 1), min(mask.shape[1], b + 2)):
                    if mask[u, v] and not seen[u, v]:
                        seen[u, v] = True
                        todo.append((u, v))
        p = np.array(found)
        out.append((int(p[:, 1].min()), int(p[:, 0].min()), int(np.ptp(p[:, 1])) + 1, int(np.ptp(p[:, 0])) + 1, len(p)))
    return sorted(out)


def test_components_against_flood_fill():
    r = np.random.default_rng(0)
    for _ in range(60):
        mask = r.random((r.integers(1, 25), r.integers(1, 25))) < r.uniform(0.05, 0.8)
        assert sorted(map(tuple, backend.components(mask).tolist())) == flood(mask)


def test_gate_regions_of_a_drawn_page():
    boxes = np.array([[10, 10, 50, 45], [100, 10, 110, 20], [100, 60, 160, 100]], float)
    assert backend.all_gate_regions(backend.draw(boxes)).tolist() == [[10, 10, 50, 45], [100, 60, 160, 100]]


def test_gate_regions_of_pages_together(monkeypatch):
    """Pages of few boxes, of noise and of nothing give what each gives alone, by few labellings for all."""
    r = np.random.default_rng(5)
    pages = [backend.draw(np.column_stack([c, c + r.integers(1, 90, (len(c), 2))]).astype(float)) for c in (r.integers(0, 200, (n, 2)) for n in r.integers(0, 9, 200))]
    pages += [np.where(r.random((60, 70)) < 0.4, 160, 255).astype(np.uint8), np.zeros((0, 5), np.uint8), np.zeros((40, 40), np.uint8)]
    calls, whole = [], backend.runs
    monkeypatch.setattr(backend, "runs", lambda mask: calls.append(1) or whole(mask))
    got = backend.gate_regions_of(pages)
    assert len(calls) <= 4 and len(got) == len(pages)
    for page, found in zip(pages, got, strict=True):
        want = set()
        for t in (150, 200):
            b = flood(page < t)
            want |= {(x, y, x + w, y + h) for x, y, w, h, _ in b if 0.3 < w / h < 4 and 400 < w * h < 50000 and w > 20 and h > 20}
        assert list(map(tuple, found.astype(int).tolist())) == sorted(want)
    monkeypatch.setattr(backend, "TOGETHER", 500)
    assert all(np.array_equal(a, b) for a, b in zip(got, backend.gate_regions_of(pages), strict=True))


def test_numbers_of_variants_without_whole_images(monkeypatch):
    """The range after equalisation and the share of black pixels are those of the whole images, made for few of the drawn pages."""
    r = np.random.default_rng(6)
    drawn = [backend.draw(np.column_stack([c, c + r.integers(1, 200, (len(c), 2))]).astype(float)) for c in (r.integers(0, 300, (n, 2)) for n in r.integers(1, 8, 100))]
    other = [np.repeat(r.integers(0, 256, (r.integers(1, 30), 2), dtype=np.uint8), r.integers(1, 30), axis=1) for _ in range(100)]
    whole, calls = backend.equalized, []
    monkeypatch.setattr(backend, "equalized", lambda *a: calls.append(1) or whole(*a))
    for pages in (drawn, other):
        calls.clear()
        for gray in pages:
            even = whole(gray)
            assert backend.equalized_range(gray) == (even.min(), even.max())
            assert backend.black_share(gray) == (backend.adaptive_threshold(gray) == 0).mean()
        assert pages is other or len(calls) <= 10


def test_png():
    r = np.random.default_rng(1)
    for shape in ((1, 1), (7, 9), (5, 4, 3)):
        a = r.integers(0, 256, shape, dtype=np.uint8)
        assert (png.decode(png.encode(a)) == a).all()
    import struct
    import zlib

    rows = r.integers(0, 256, (5, 6), dtype=np.uint8)  # every filter, two pixels of three bytes a row
    raw, above = b"", [0] * 6
    for kind, row in enumerate(rows.tolist()):
        left = lambda i, row=row: row[i - 3] if i >= 3 else 0
        corner = lambda i, above=above: above[i - 3] if i >= 3 else 0

        def paeth(i, row=row, above=above, left=left, corner=corner):
            p = left(i) + above[i] - corner(i)
            return min((left(i), above[i], corner(i)), key=lambda v: abs(p - v))

        guess = (lambda i: 0, left, lambda i, above=above: above[i], lambda i, above=above, left=left: (left(i) + above[i]) // 2, paeth)[kind]
        raw += bytes([kind]) + bytes((v - guess(i)) % 256 for i, v in enumerate(row))
        above = row
    head = struct.pack(">IIBBBBB", 2, 5, 8, 2, 0, 0, 0)
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + b"\0\0\0\0"
    image = png._MAGIC + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw))
    assert (png.decode(image) == rows.reshape(5, 2, 3)).all()
    for broken in (b"", b"junk", image[:40], png.encode(np.zeros((3, 3), np.uint8))[:50]):
        with pytest.raises(ValueError):
            png.decode(broken)


def test_adaptive_threshold():
    a = np.random.default_rng(2).integers(0, 256, (20, 17), dtype=np.uint8)
    k = np.exp(-(np.arange(-5, 6) ** 2) / (2 * 2.0**2))
    k = np.outer(k, k) / k.sum() ** 2
    padded = np.pad(a.astype(float), 5, mode="edge")
    got = backend.adaptive_threshold(a)
    for y in range(20):
        for x in range(17):
            mean = (padded[y : y + 11, x : x + 11] * k).sum()
            assert got[y, x] == (255 if a[y, x] > np.floor(mean + 0.5) - 2 else 0)


def test_equalized_spreads_gray():
    flat = np.full((64, 64), 100, np.uint8)
    flat[::2] = 110
    even = backend.equalized(flat)
    assert int(even.max()) - int(even.min()) > 10 and even.shape == flat.shape
    assert backend.equalized(np.zeros((3, 2), np.uint8)).shape == (3, 2)


def test_read_region_takes_the_best_variant():
    gray = np.full((60, 80), 255, np.uint8)
    gray[20:40, 20:50] = 90
    seen = []

    def read(part):
        seen.append(part.shape)
        return [(f"v{len(seen)}", (0.5, 0.9, 0.9)[len(seen) - 1])]

    assert backend.read_region(gray, (20, 20, 30, 20), read) == ("v2", 0.9)
    assert seen == [(40, 50)] * 3
    assert backend.read_region(gray, (500, 500, 3, 3), read) == ("", 0.0)


def test_matrix_on_pixels(spark):
    """A bracketed grid of marks is a matrix; long wires with boxes are not."""
    grid = np.full((120, 160), 255, np.uint8)
    grid[10:110, 4:7] = grid[10:110, 153:156] = 0
    for y in range(20, 110, 30):
        for x in range(30, 140, 30):
            grid[y : y + 8, x : x + 8] = 0
    wires = np.full((120, 160), 255, np.uint8)
    for y in (10, 17, 60, 112):
        wires[y : y + 2, 30:130] = 0
    df = spark.createDataFrame([(i, a.shape[1], a.shape[0], bytearray(a.tobytes())) for i, a in enumerate((grid, wires))], "image_id long, width int, height int, pixels binary")
    s = backend.with_statistics(df)
    got = {r["image_id"]: (r["left"], r["right"], r["m"]) for r in s.withColumn("m", R.matrix({c: s[c] for c in s.columns})).collect()}
    assert got == {0: (True, True, True), 1: (False, False, False)}


# greedy box steps, in full, against the plainest form


def brute_overlap(a, b):
    return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))


def random_boxes(r, n):
    xy = r.integers(0, 60, (n, 2))
    return np.concatenate([xy, xy + r.integers(1, 40, (n, 2))], axis=1).astype(float)


def test_merge_near_against_brute_force():
    r = np.random.default_rng(4)
    for _ in range(40):
        boxes = random_boxes(r, int(r.integers(1, 9)))
        left = [tuple(b) for b in boxes]
        while True:
            pair = next(((i, j) for i in range(len(left)) for j in range(i + 1, len(left)) if all(max(left[i][k], left[j][k]) - min(left[i][k + 2], left[j][k + 2]) <= 5 for k in (0, 1))), None)
            if pair is None:
                break
            b, a = left.pop(pair[1]), left.pop(pair[0])
            left.append((min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])))
        assert sorted(map(tuple, B.merge_near(boxes, 5.0).tolist())) == sorted(left)


def test_drop_overlapped_against_brute_force():
    r = np.random.default_rng(5)
    for _ in range(40):
        boxes = random_boxes(r, int(r.integers(1, 12)))
        kept = []
        for b in sorted(boxes.tolist(), key=lambda b: -(b[2] - b[0]) * (b[3] - b[1])):
            if all(brute_overlap(b, k) <= 0.5 * (b[2] - b[0]) * (b[3] - b[1]) for k in kept):
                kept.append(b)
        mask = B.drop_overlapped(np.column_stack([boxes[:, :2], boxes[:, 2:] - boxes[:, :2]]))
        assert sorted(boxes[mask].tolist()) == sorted(kept)


# neighbours


@pytest.mark.parametrize("block", [3, 1000])
def test_knn_with_ties(spark, block):
    r = np.random.default_rng(6)
    x = r.integers(0, 3, (60, 4)).astype(float)  # many equal distances
    rows = [(i, [float(v) for v in x[i]], int(i % 2)) for i in range(60)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {}
    for n in K.knn(v.where("vec_id % 7 = 0"), v, 5, block).collect():
        got.setdefault(n["vec_id"], []).append((n["rank"], n["ref_id"]))
    for i, found in got.items():
        want = sorted(range(60), key=lambda j: (round(float(((x[i] - x[j]) ** 2).sum()), 9), j))[:5]
        assert [j for _, j in sorted(found)] == want


def test_index_reaches_nine_in_ten(spark):
    r = np.random.default_rng(7)
    centres = r.normal(0, 4, (12, 16))
    x = centres[r.integers(0, 12, 600)] + r.normal(0, 1, (600, 16))
    v = spark.createDataFrame([(i, x[i].tolist(), 0) for i in range(600)], "vec_id long, embedding array<double>, label int")
    q = v.where("vec_id % 50 = 0")
    found, exact = K.knn_indexed(q, v, block=40), K.knn(q, v)
    assert K.recall(found, exact).first()["recall"] >= 0.9
    assert found.groupBy("vec_id").count().where("count <> 10").count() == 0
    whole = K.knn_indexed(q, v, cells=10, probes=10, block=40)
    assert K.recall(whole, exact).first()["recall"] == 1.0
    assert K.knn_indexed(q, v.limit(0)).count() == 0


# topics and encoders


def test_phrase_lists_of_any_length_give_the_same(spark):
    """First topic, first phrase: with a short list, a long one, and one with empty phrases in it."""
    texts = ["Grover  Search and QAOA", "qaoa then grover", "nothing", None, "", "Surface Code", "the vqe, a variational quantum eigensolver", "subqaoas", "a surface codex", "xsurface code"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "id long, text string, t string")
    short = P.match_phrases(df, "text").collect()
    many = (("None", ("", " ")), *vocab.TOPIC_PHRASES, ("Rest", ("", *(f"phrase number {i}" for i in range(700)))))
    assert sorted(short) == sorted(P.match_phrases(df, "text", many).collect())
    chain = df.select("id", T.phrase_topic(F.col("text")).alias("x")).collect()
    assert {r["id"]: (r["category"], r["phrase"]) for r in short} == {r["id"]: tuple(r["x"]) for r in chain}
    assert {r["id"]: r["phrase"] for r in short}[9] == "surface code" and {r["t"] for r in short} == {"c"}
    assert {r["category"] for r in P.match_phrases(df, "text", (("A", ("",)),)).collect()} == {"Unknown"}
    assert {r["category"] for r in P.match_phrases(df, "text", ()).collect()} == {"Unknown"}


def test_phrases_against_brute_force(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choices("abc", k=r.randint(1, 4)))
    texts = [" ".join(word() for _ in range(r.randint(0, 12))) for _ in range(200)]
    phrases = list(dict.fromkeys(" ".join(word() for _ in range(r.randint(1, 3))) for _ in range(60)))
    got = P.match_phrases(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "text", [(f"t{i}", [p]) for i, p in enumerate(phrases)])
    want = {i: next((p for p in phrases if p in t), None) for i, t in enumerate(texts)}
    assert {x["id"]: x["phrase"] for x in got.collect()} == want


def test_phrases_with_spaces_leave_a_rank_a_text(spark, monkeypatch):
    """Cut, spaced and very long phrases of equal and of repeated order, in one and in several broadcasts; no list of phrases is gathered."""
    r = random.Random(8)
    word = lambda: "".join(r.choices("abé𝒳", k=r.choice((1, 2, 3, 4, 18, 30))))
    texts = [" ".join(word() for _ in range(r.randint(0, 14))) for _ in range(150)] + ["", " "]
    cuts = [t[i : i + n] for t in texts[::2] if t for i, n in [(r.randrange(len(t)), r.randint(1, 40))]]
    phrases = [*cuts, "a  b", " ", "  ", "", " a", "b ", *cuts[:5]]
    rows = [(i // 2, f"t{i % 3}", p) for i, p in enumerate(phrases)]
    table = spark.createDataFrame(rows, "ord long, category string, phrase string")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    want = {i: min([x for x in rows if x[2].strip(" ") and x[2] in " ".join(t.split())], default=(0, "Unknown", None))[1:] for i, t in enumerate(texts)}
    for head, most in ((P.HEAD, P.AT_ONCE), (20, P.AT_ONCE), (1, 20)):
        monkeypatch.setattr(P, "HEAD", head)
        monkeypatch.setattr(P, "AT_ONCE", most)
        got = P.match_phrases(df, "text", table, "id")
        assert {x["id"]: (x["category"], x["phrase"]) for x in got.collect()} == want
        assert "collect_list" not in got._jdf.queryExecution().toString()


def test_text_vectors_against_brute_force(spark):
    texts = ["One two, TWO; three3 é", "", None, "漢字 !", "a " * 3000]
    got = {r["id"]: r["v"] for r in E.bucket_vectors(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text", "v").collect()}
    for i, t in enumerate(texts):
        want = [0.0] * 64
        for w in re.findall("[a-z0-9]+", (t or "").lower()):
            want[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64] += 1
        assert got[i] == want


def test_cascade_takes_up_only_new_texts(spark):
    rows = [(1, "uses qaoa", "grover", "shor"), (2, "none", "none", "shor here"), (3, "none", "a transmon", None), (4, None, None, None), (5, "zz", "", "grover")]
    got = P.cascade(spark.createDataFrame(rows, "id long, a string, b string, c string"), "id", ["a", "b", "c"]).collect()
    assert sorted((r["id"], r["category"], r["step"]) for r in got) == [(1, "QAOA", 1), (2, "Shor_Algorithm", 3), (3, "Hardware_Architecture", 2), (4, "Unknown", 1), (5, "Grover_Algorithm", 3)]


def test_read_topics(spark, tmp_path):
    (tmp_path / "topics.json").write_text(json.dumps({"A": ["One Phrase", "two"], "B": []}))
    assert P.read_topics(spark, f"file://{tmp_path}/topics.json") == (("A", ("one phrase", "two")), ("B", ()))
    (tmp_path / "bad.json").write_text(json.dumps({"A": "one"}))
    with pytest.raises(ValueError):
        P.read_topics(spark, f"file://{tmp_path}/bad.json")


def test_two_stages(spark):
    texts = ["uses qaoa here", "code: surface", "trapped, ion", "unrelated words only", "  ", None, "漢字"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: (r["category"], r["method"]) for r in P.classify(df, "id", "text").collect()}
    assert got[0] == ("QAOA", "explicit_match") and got[4] == got[5] == ("Unknown", "no_text")
    assert got[3][0] == got[6][0] == "Unknown" and got[3][1] == "embedding_similarity"


def test_encoders(spark):
    class broken_encoder:
        size = 1

        def __call__(self):
            raise ImportError("no such library")

    files = [bytearray(png.encode(np.full((9, 5), 7, np.uint8))), bytearray(b"junk"), None]
    df = spark.createDataFrame(list(enumerate(files)), "id long, content binary")
    got = {r["id"]: r["embedding"] for r in E.encode(df, "content", E.image_encoder()).collect()}
    assert got[1] is None and got[2] is None and len(got[0]) == 64 and np.linalg.norm(got[0]) == pytest.approx(1, abs=1e-6)
    assert all(r["embedding"] is None for r in E.encode(df, "content", broken_encoder()).collect())
    assert E.held(broken_encoder()) is None and E.held(broken_encoder()) is None


# files


def test_documents_from_files(spark, tmp_path):
    page = [{"text": "Figure 1: a", "box": [0, 0, 10, 5]}, {"kind": "image", "box": [0, 5, 10, 20]}]
    (tmp_path / "quant-ph_1.pdf").write_text(json.dumps({"pages": [page, []]}))
    (tmp_path / "2.pdf").write_text("")
    (tmp_path / "3.pdf").write_text("{")
    (tmp_path / "4.txt").write_text("other")
    files = D.read_files(spark, f"file://{tmp_path}")
    got = {r["path"].rsplit("/", 1)[1]: r for r in D.extract(files).collect()}
    assert {k: (r["success"], r["error"]) for k, r in got.items()} == {"quant-ph_1.pdf": (True, None), "2.pdf": (False, "empty file"), "3.pdf": (False, "JSONDecodeError")}
    docs = D.extract(files)
    assert [r["text"] for r in D.blocks_of(docs).collect()] == ["Figure 1: a"] and D.blocks_of(docs, "image").count() == 1
    papers = spark.createDataFrame([("quant-ph/1",), ("2",), ("9",)], "arxiv_id string")
    assert sorted(r[0] for r in D.to_fetch(papers, files).collect()) == ["2", "9"]
    assert D.read_files(spark, f"file://{tmp_path}/none").count() == 0


def test_save_images(spark, tmp_path):
    df = spark.createDataFrame([("a.png", bytearray(b"one")), ("b.png", None), ("no/folder/c.png", bytearray(b"three"))], "filename string, content binary")
    got = sorted((r["filename"], r["n_bytes"]) for r in save_images(df, f"file://{tmp_path}/out").collect())
    assert got == [("", 0), ("", 0), ("a.png", 3)]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.png"]


def test_settings_from_a_store(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"output": {"most": 7}}')
    s = Settings.load(f"file://{tmp_path}/s.json", spark)
    assert s.get("output.most") == 7 and s.get("detection.minWidth") == 200 and s.get("a.b", 1) == 1


def test_shared_folder_is_named_on_a_cluster(spark):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        shared.shared_root(Session)


# texts


def test_unicode_blanks(spark):
    texts = ["a  b　", " x\x1cy ", "Fig. 7: z", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    from pyspark.sql import functions as F

    got = [tuple(r) for r in df.orderBy("id").select(T.normalize_text(F.col("t")), T.strip(F.col("t")), T.figure_number(F.col("t")), F.col("t").rlike(T.FIGURE_START)).collect()]
    assert got == [("a b", "a  b", None, False), ("x y", "x\x1cy", None, False), ("fig. 7: z", "Fig. 7: z", 7, True), (None, None, None, None)]


def test_caption_patterns_of_any_form(spark):
    """Plain words, an optional space, and a pattern that is no plain text."""
    from pyspark.sql import functions as F

    texts = ["a Flow chart", "a flowchart here", "overflow charts", "x 12 y", None, "plot of it and QUANTUM CIRCUIT"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    r = T.caption_filter(F.col("t"), (r"\bquantum circuit\b",), (r"\bflow ?chart\b", r"\b\d+\b", r"\bplot of\b"))
    got = [(x["r"]["decision"], x["r"]["matched"]) for x in df.orderBy("id").select(r.alias("r")).collect()]
    assert got == [("REJECT", ["flow chart"]), ("REJECT", ["flowchart"]), ("PASS", []), ("REJECT", ["12"]), ("PASS", []), ("REJECT", ["plot of"])]
