"""Labelled images, settings, drawn regions, descriptions and runs without papers."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from figmine.catalog import QUERIES
from figmine.functions import text as T
from figmine.plans.fixtures import BOXES, made
from figmine.settings import Settings
from figmine.sinks import outputs as O
from figmine.sources.images import read_labeled_images
from figmine.streaming import incremental
from figmine.vision import backend
from figmine.vision import rules as R


def test_labeled_images(spark, tmp_path):
    with pytest.raises(ValueError):
        read_labeled_images(spark, str(tmp_path))
    for folder, names in (("circuits", ("a.png", "b.JPG", "c.txt")), ("non_circuits", ("d.txt",))):
        (tmp_path / folder).mkdir()
        for n in names:
            (tmp_path / folder / n).write_bytes(n.encode())
    with pytest.raises(ValueError):
        read_labeled_images(spark, str(tmp_path))
    (tmp_path / "non_circuits" / "e.jpeg").write_bytes(b"e.jpeg")
    rows = read_labeled_images(spark, str(tmp_path)).collect()
    assert sorted((bytes(r["content"]).decode(), r["is_target"]) for r in rows) == [("a.png", 1), ("b.JPG", 1), ("e.jpeg", 0)]


def test_settings(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"detection": {"minWidth": 9}, "more": 1}))
    s = Settings.load(str(tmp_path / "s.json"))
    assert (s.get("detection.minWidth"), s.get("detection.minHeight"), s.get("more"), s.get("more.deep", 5), s.get("none")) == (9, 150, 1, 5, None)
    assert Settings().get("detection.minWidth") == 200


def flooded(mask):
    """Boxes of 8-connected regions, by flood fill."""
    left, out = set(zip(*np.nonzero(mask), strict=True)), []
    while left:
        todo, seen = [left.pop()], []
        while todo:
            y, x = todo.pop()
            seen.append((y, x))
            near = {(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
            left -= near
            todo += near
        ys, xs = zip(*seen, strict=True)
        out.append((min(xs), min(ys), max(xs) + 1, max(ys) + 1))
    return out


def test_image_folders_are_not_listed_by_the_driver(spark, tmp_path):
    """No file index in the plan; names with blanks and signs, other endings, hidden files and folders within."""
    names = {"circuits": ["a b.png", "100%25 #1?.JPG", "é.jpeg"], "non_circuits": [f"{i}.png" for i in range(450)]}
    for folder, found in names.items():
        (tmp_path / folder / "within.png").mkdir(parents=True)
        for n in [*found, ".hidden.png", "_also.png", "notes.txt", "within.png/x.png"]:
            (tmp_path / folder / n).write_bytes(n.encode())
    for base in (str(tmp_path), f"file://{tmp_path}"):
        df = read_labeled_images(spark, base)
        assert "binaryFile" not in df._jdf.queryExecution().toString()
        got = [(r["is_target"], r["path"].rsplit("/", 1)[1], bytes(r["content"]).decode()) for r in df.collect()]
        assert sorted(got) == sorted((int(f == "circuits"), n, n) for f, ns in names.items() for n in ns)


def test_drawn_regions_are_found(spark, sf):
    pages, want = {}, set()
    for r in made(spark, sf, BOXES).where("page_key < 40").collect():
        pages.setdefault(r["page_key"], []).append([r[c] for c in ("x0", "y0", "x1", "y1")])
    for page, boxes in pages.items():
        for x0, y0, x1, y1 in flooded(backend.draw(np.array(boxes)) < 150):
            w, h = x1 - x0, y1 - y0
            if 0.3 < w / h < 4 and 400 < w * h < 50000 and w > 20 and h > 20:
                want.add((page, x0, y0, x1, y1))
    got = QUERIES["find_gate_regions"](spark, sf).where("page_key < 40").collect()
    assert {tuple(map(int, r)) for r in got} == want and len(got) == len(want) > 0


def test_vector_regions_have_the_size_of_their_clip(spark, sf):
    rows = QUERIES["vector_region_scan"](spark, sf).collect()
    assert rows and all(abs(r["width"] - (r["x1"] - r["x0"]) * 300 / 72) <= 0.5 and abs(r["height"] - (r["y1"] - r["y0"]) * 300 / 72) <= 0.5 for r in rows)


def test_descriptions(spark):
    df = spark.createDataFrame([(" a b ", "c", "x a b c"), ("c", "c", "no"), (None, "", None)], "cap string, sur string, whole string")
    ref = F.array(F.struct(F.lit("c").alias("text"), F.lit(7).alias("start"), F.lit(8).alias("end")))
    out = [[tuple(d) for d in r[0]] for r in df.select(T.descriptions(F.col("cap"), F.col("sur"), ref, F.col("whole"))).collect()]
    assert out == [[("a b", 2, 5), ("c", 6, 7)], [("c", 0, 0)], [("c", 7, 8)]]


def test_spacing_edges(spark):
    df = spark.createDataFrame([([],), ([1, 1, 1, 1],), ([0, 10, 20, 30],), ([0, 100, 101, 300],)], "p array<int>")
    rows = df.select(R.grid_score(F.col("p")).alias("g"), R.spacing_score(F.col("p"), F.col("p")).alias("s")).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]


def test_runs_without_papers_and_with_one(spark, tmp_path):
    papers = spark.range(1).select(F.col("id").alias("paper_idx"))
    detect = lambda p: p.withColumn("image_index", F.lit(0))
    assert incremental.run(papers.limit(0), detect, f"{tmp_path}/none").count() == 0
    assert incremental.run(papers, detect, f"{tmp_path}/one").count() == 1
    O.clear_state(spark, f"{tmp_path}/one/state")
    O.clear_state(spark, f"{tmp_path}/nowhere")
    assert incremental.run(papers, detect, f"{tmp_path}/one").count() == 1
