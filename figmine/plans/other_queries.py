"""Queries over vectors, boxes, symbols, decisions and outputs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from figmine import vocab
from figmine.functions import boxes as B
from figmine.functions import text as T
from figmine.functions import vectors as V
from figmine.operators import classify as K
from figmine.operators import stored_index as S
from figmine.operators.boxes import SIDES, by_page
from figmine.operators.spatial import overlapping_pairs, without_nested
from figmine.plans.fixtures import BOXES, CAPTIONS, FIGURES, GATES, VECTORS, in_sql, made
from figmine.plans.registry import query
from figmine.plans.text_queries import FILTERED, _topic_sql, NORM
from figmine.sinks import outputs as O
from figmine.sinks.shared import shared_path
from figmine.sources.paper_list import indexed

VEC, BOX, GATE, FIG = (in_sql(x) for x in (VECTORS, BOXES, GATES, FIGURES))
_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"

# vectors -----------------------------------------------------------------------------------------

DOT = "list_dot_product({0}::DOUBLE[], {1}::DOUBLE[])"
CENT = f"""v AS ({VEC}), pos AS (SELECT is_target, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM v),
c AS (SELECT is_target, list(m ORDER BY i) AS centroid FROM (SELECT is_target, i, avg(x::DOUBLE) AS m FROM pos GROUP BY 1, 2) GROUP BY 1)"""
CSCORE = "cs AS (SELECT vec_id, list_distance(embedding::DOUBLE[], (SELECT centroid FROM c WHERE is_target = 1)) AS d1, list_distance(embedding::DOUBLE[], (SELECT centroid FROM c WHERE is_target = 0)) AS d0 FROM v WHERE is_query)"
KNN = """kn AS (SELECT * FROM (SELECT q.vec_id, r.vec_id AS ref_id, r.is_target AS label, list_distance(q.embedding::DOUBLE[], r.embedding::DOUBLE[]) AS distance,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY round(pow(list_distance(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 2), 9), r.vec_id) AS rank FROM v q, v r WHERE q.is_query) WHERE rank <= 10),
ks AS (SELECT vec_id, count(*) FILTER (WHERE label = 1) AS n_target, count(*) AS n FROM kn GROUP BY 1)"""


def _split(spark, sf):
    """Every row whose id is divisible by 50 asks; all rows answer."""
    v = made(spark, sf, VECTORS)
    return v.where("is_query"), v


def _neighbours(spark, sf):
    q, r = _split(spark, sf)
    return K.knn(q, r.select("vec_id", "embedding", F.col("is_target").alias("label")))


@query(f"SELECT vec_id, round(sqrt({DOT.format('embedding', 'embedding')}), 4) AS norm, round(embedding[1]::DOUBLE / sqrt({DOT.format('embedding', 'embedding')}), 4) AS first FROM embeddings")
def normalize_vector(spark, sf):
    v = made(spark, sf, VECTORS)
    return v.select("vec_id", F.round(V.norm(F.col("embedding")), 4).alias("norm"), F.round(V.normalize(F.col("embedding"))[0], 4).alias("first"))


@query(f"WITH {CENT} SELECT is_target, len(centroid) AS dim, round(centroid[1], 6) AS first, round(centroid[len(centroid)], 6) AS last FROM c")
def class_centroids(spark, sf):
    c = K.class_centroids(_split(spark, sf)[1])
    return c.select("is_target", F.size("centroid").cast("long").alias("dim"), F.round(F.col("centroid")[0], 6).alias("first"), F.round(F.element_at("centroid", -1), 6).alias("last"))


@query(f"WITH {CENT}, {CSCORE} SELECT vec_id, round(CASE WHEN d0 + d1 > 0 THEN d0 / (d0 + d1) ELSE 0.5 END, 4) AS score FROM cs")
def centroid_join(spark, sf):
    q, r = _split(spark, sf)
    return K.centroid_scores(q, K.class_centroids(r)).select("vec_id", F.round("centroid_score", 4).alias("score"))


@query(f"WITH v AS ({VEC}), {KNN} SELECT vec_id, ref_id, label, round(distance, 4) AS distance, CAST(rank AS INT) AS rank FROM kn")
def knn_join(spark, sf):
    return _neighbours(spark, sf).withColumn("distance", F.round("distance", 4))


@query(f"SELECT count(*) AS n_queries, count(*) * 10 AS n, true AS reached FROM ({VEC}) WHERE is_query")
def knn_index_recall(spark, sf):
    """The inverted file against brute force: every fiftieth row asks all rows; at least nine in ten found."""
    q, r = _split(spark, sf)
    r = r.select("vec_id", "embedding", F.col("is_target").alias("label"))
    share = K.recall(K.knn_indexed(q, r), K.knn(q, r))
    return share.crossJoin(q.agg(F.count("*").alias("n_queries"))).select("n_queries", "n", (F.col("recall") >= 0.9).alias("reached"))


@query(f"WITH v AS ({VEC}), {KNN} SELECT vec_id, ref_id, label, round(distance, 4) AS distance FROM kn WHERE rank = 1")
def stored_index_search(spark, sf):
    """An index that was written and opened again: the nearest vector of every fiftieth row lies in the first cell it asks."""
    q, r = _split(spark, sf)
    path = shared_path(spark, "cells")
    S.write_index(r.select("vec_id", "embedding", F.col("is_target").alias("label")), path)
    near = S.search(S.open_index(spark, path), q).where("rank = 1")
    return near.select("vec_id", "ref_id", "label", F.round("distance", 4).alias("distance"))


@query(f"WITH v AS ({VEC}), {KNN} SELECT vec_id, n_target, n FROM ks")
def knn_label_counts(spark, sf):
    return K.knn_scores(_neighbours(spark, sf)).select("vec_id", "n_target", "n")


@query(f"""WITH {CENT}, {CSCORE}, {KNN}, j AS (SELECT vec_id, round(0.6E0 * CASE WHEN d0 + d1 > 0 THEN d0 / (d0 + d1) ELSE 0.5E0 END + 0.4E0 * n_target / n, 4) AS score FROM cs JOIN ks USING (vec_id))
SELECT vec_id, score, score >= 0.70 AS is_target, CASE WHEN score >= 0.80 THEN 'HIGH' WHEN score >= 0.60 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM j""")
def embedding_detect(spark, sf):
    q, r = _split(spark, sf)
    both = K.centroid_scores(q, K.class_centroids(r)).join(K.knn_scores(_neighbours(spark, sf)), "vec_id")
    score = F.round(0.6 * F.col("centroid_score") + 0.4 * F.col("n_target") / F.col("n"), 4)
    return both.select("vec_id", score.alias("score"), (score >= 0.70).alias("is_target"), K.confidence(score).alias("confidence"))


@query(f"SELECT CASE WHEN label < 5 THEN 1 ELSE 0 END AS is_target, count(*) AS n, max(len(embedding)) AS dim FROM embeddings GROUP BY 1")
def index_metadata(spark, sf):
    return made(spark, sf, VECTORS).groupBy("is_target").agg(F.count("*").alias("n"), F.max(F.size("embedding")).cast("long").alias("dim"))


@query(f"SELECT vec_id, is_target, len(embedding) AS dim FROM ({VEC})")
def reference_index_load(spark, sf):
    """An index written before is read back, with the label beside each vector."""
    path, v = shared_path(spark, "index"), made(spark, sf, VECTORS)
    O.write_reference_index(v.select("vec_id", "embedding", "is_target"), K.class_centroids(v), path)
    return O.load_reference_index(spark, path)[0].select("vec_id", F.col("is_target").cast("int").alias("is_target"), F.size("embedding").cast("long").alias("dim"))


@query(f"SELECT is_target, vec_id FROM ({VEC}) WHERE is_target = 1 UNION ALL SELECT is_target, vec_id FROM ({VEC}) WHERE is_target = 0")
def index_stack(spark, sf):
    v = made(spark, sf, VECTORS).select("is_target", "vec_id")
    return v.where("is_target = 1").unionByName(v.where("is_target = 0"))


TOPICS = f"""refs AS (SELECT row_number() OVER (ORDER BY label, parity) - 1 AS ord, 'T' || label || '_' || parity AS category, ref FROM (SELECT label, vec_id % 2 AS parity, arg_min(embedding, vec_id) AS ref FROM embeddings WHERE label < 6 GROUP BY 1, 2)),
sim AS (SELECT e.vec_id, category, ord, round(list_cosine_similarity(e.embedding::DOUBLE[], ref::DOUBLE[]), 6) AS s FROM embeddings e, refs),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, ord) AS r FROM sim),
tp AS (SELECT vec_id, max(category) FILTER (WHERE r = 1) AS category, max(s) FILTER (WHERE r = 1) AS score, round(max(s) FILTER (WHERE r = 1) - max(s) FILTER (WHERE r = 2), 6) AS margin, string_agg(category, ',' ORDER BY r) FILTER (WHERE r <= 3) AS top3 FROM rk GROUP BY 1)"""


def _topic(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    refs = v.where("label < 6").groupBy("label", (F.col("vec_id") % 2).alias("parity")).agg(F.min_by("embedding", "vec_id").alias("ref"))
    refs = refs.select((F.col("label") * 2 + F.col("parity")).alias("ord"), F.concat(F.lit("T"), F.col("label").cast("string"), F.lit("_"), F.col("parity").cast("string")).alias("category"), "ref")
    return K.topic_similarity(v.select("vec_id", "embedding"), refs)


@query(f"WITH {TOPICS} SELECT vec_id, CASE WHEN score >= 0.65 AND margin >= 0.10 THEN category ELSE 'Unknown' END AS category, CASE WHEN NOT (score >= 0.65 AND margin >= 0.10) THEN 'LOW' WHEN score >= 0.80 THEN 'HIGH' WHEN score >= 0.70 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM tp")
def reference_text_similarity(spark, sf):
    return _topic(spark, sf).select("vec_id", "category", "confidence")


@query(f"WITH {TOPICS} SELECT vec_id, score, margin FROM tp")
def top2_margin(spark, sf):
    return _topic(spark, sf).select("vec_id", "score", "margin")


@query(f"WITH {TOPICS} SELECT vec_id, top3 FROM tp")
def top3_categories(spark, sf):
    return _topic(spark, sf).select("vec_id", "top3")


@query("SELECT vec_id, round_even(sqrt(abs(embedding[1]::DOUBLE)), 4) AS s4 FROM embeddings")
def round_scores(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.bround(F.sqrt(F.abs(F.col("embedding")[0].cast("double"))), 4).alias("s4"))


# boxes -------------------------------------------------------------------------------------------

PAIRS = f"bx AS ({BOX}), pr AS (SELECT a.page_key, a.x0 AS ax, a.y0 AS ay, a.x1 AS ax1, a.y1 AS ay1, b.x0 AS bx0, b.y0 AS by0, b.x1 AS bx1, b.y1 AS by1, greatest(0.0E0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) AS w, greatest(0.0E0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS h FROM bx a JOIN bx b ON a.page_key = b.page_key AND (a.x0, a.y0, a.x1, a.y1) < (b.x0, b.y0, b.x1, b.y1))"


@query(f"WITH {PAIRS} SELECT page_key, ax, ay, bx0, by0, round(CASE WHEN w * h > 0 THEN w * h / ((ax1 - ax) * (ay1 - ay) + (bx1 - bx0) * (by1 - by0) - w * h) ELSE 0.0E0 END, 6) AS iou FROM pr WHERE w * h > 0")
def iou(spark, sf):
    p = overlapping_pairs(made(spark, sf, BOXES), ["page_key"])
    a, b = F.col("a"), F.col("b")
    value = B.iou({k: a[k] for k in SIDES}, {k: b[k] for k in SIDES})
    return p.select("page_key", a["x0"].alias("ax"), a["y0"].alias("ay"), b["x0"].alias("bx0"), b["y0"].alias("by0"), F.round(value, 6).alias("iou"))


@query(f"WITH bx AS ({BOX}) SELECT page_key, x0, y0, x1, y1 FROM bx a WHERE NOT EXISTS (SELECT 1 FROM bx b WHERE a.page_key = b.page_key AND b.x0 < a.x0 AND b.y0 < a.y0 AND b.x1 > a.x1 AND b.y1 > a.y1)")
def remove_nested(spark, sf):
    return without_nested(made(spark, sf, BOXES), ["page_key"])


@query(f"SELECT page_key, x0, y0, x1, y1, row_number() OVER (PARTITION BY page_key ORDER BY floor(y0 / 30), x0, y0, x1, y1) AS place FROM ({BOX})")
def reading_order_sort(spark, sf):
    return made(spark, sf, BOXES).withColumn("place", F.row_number().over(W.partitionBy("page_key").orderBy(F.floor(F.col("y0") / 30), "x0", "y0", "x1", "y1")).cast("long"))


@query(f"SELECT page_key, x0 * 72 / 300 AS x0, y1 * 72 / 300 AS y1 FROM ({BOX})")
def px_to_pt(spark, sf):
    return made(spark, sf, BOXES).select("page_key", B.px_to_pt(F.col("x0")).alias("x0"), B.px_to_pt(F.col("y1")).alias("y1"))


def _greedy(clash: str) -> str:
    """Boxes largest first, each kept unless it clashes with a kept one: a recursion over ranks, page by page."""
    return f"""WITH RECURSIVE o AS (SELECT page_key, struct_pack(x0 := x0, y0 := y0, x1 := x1, y1 := y1) AS b, row_number() OVER (PARTITION BY page_key ORDER BY (x1 - x0) * (y1 - y0) DESC, x0, y0, x1, y1) AS r FROM ({BOX})),
k AS (SELECT page_key, r, [b] AS kept FROM o WHERE r = 1 UNION ALL SELECT o.page_key, o.r, CASE WHEN len(list_filter(kept, lambda a: {clash})) > 0 THEN kept ELSE list_append(kept, b) END FROM k JOIN o ON o.page_key = k.page_key AND o.r = k.r + 1),
e AS (SELECT page_key, unnest(arg_max(kept, r)) AS b FROM k GROUP BY 1) SELECT page_key, b.x0 AS x0, b.y0 AS y0, b.x1 AS x1, b.y1 AS y1 FROM e"""


_BOTH = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
_AREA = "({0}.x1 - {0}.x0) * ({0}.y1 - {0}.y0)"
_UNION = f"({_AREA.format('a')} + {_AREA.format('b')} - {_BOTH})"


def _merged(boxes: str) -> str:
    """CTEs with ``done`` (page_key, bs): of each page, two boxes within 50 become one until none are left."""
    at = "flatten(list_transform(range(1, len(bs) + 1), lambda i: list_transform(range(i + 1, len(bs) + 1), lambda j: [i, j])))"
    near = "greatest(bs[p[1]].x0, bs[p[2]].x0) - least(bs[p[1]].x1, bs[p[2]].x1) <= 50 AND greatest(bs[p[1]].y0, bs[p[2]].y0) - least(bs[p[1]].y1, bs[p[2]].y1) <= 50"
    pair = f"list_filter({at}, lambda p: {near})[1]"
    both = "{'x0': least(bs[p[1]].x0, bs[p[2]].x0), 'y0': least(bs[p[1]].y0, bs[p[2]].y0), 'x1': greatest(bs[p[1]].x1, bs[p[2]].x1), 'y1': greatest(bs[p[1]].y1, bs[p[2]].y1)}"
    return f"""m AS (SELECT page_key, bs, {pair} AS p FROM (SELECT page_key, list(struct_pack(x0 := x0, y0 := y0, x1 := x1, y1 := y1) ORDER BY x0, y0, x1, y1) AS bs FROM ({boxes}) GROUP BY 1)
UNION ALL SELECT page_key, bs, {pair} AS p FROM (SELECT page_key, list_append(list_filter(bs, lambda x, i: i <> p[1] AND i <> p[2]), {both}) AS bs FROM m WHERE p IS NOT NULL)),
done AS (SELECT page_key, b.x0 AS x0, b.y0 AS y0, b.x1 AS x1, b.y1 AS y1 FROM (SELECT page_key, unnest(bs) AS b FROM m WHERE p IS NULL))"""


_GROUPED = f"""WITH RECURSIVE {_merged(f"SELECT * FROM ({BOX}) WHERE x1 - x0 > 5 AND y1 - y0 > 5")},
grouped AS (SELECT * FROM done WHERE x1 - x0 >= 20 AND y1 - y0 >= 10 AND (x1 - x0) * (y1 - y0) > 200 AND (x1 - x0) / (y1 - y0) BETWEEN 0.2 AND 5.0 AND y1 - y0 <= x1 - x0 AND x1 - x0 < 612 * 0.95 AND y1 - y0 < 792 * 0.8)"""


@query(_greedy(f"{_BOTH} > 0 AND {_BOTH} > 0.4E0 * {_UNION}"))
def dedup_figures(spark, sf):
    return by_page(made(spark, sf, BOXES), lambda b: b[B.suppress(np.column_stack([b, b[:, 2] - b[:, 0], b[:, 3] - b[:, 1]]))])


@query(f"WITH RECURSIVE {_merged(BOX)} SELECT * FROM done")
def merge_boxes(spark, sf):
    return by_page(made(spark, sf, BOXES), lambda b: B.merge_near(b, 50.0))


@query(f"{_GROUPED} SELECT * FROM grouped")
def group_drawings(spark, sf):
    """Drawings larger than 5 on both sides, merged within 50, then filtered by size and shape."""
    big = made(spark, sf, BOXES).where("x1 - x0 > 5 and y1 - y0 > 5")
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return by_page(big, lambda b: B.merge_near(b, 50.0)).where((w >= 20) & (h >= 10) & (w * h > 200) & (w / h).between(0.2, 5.0) & (h <= w) & (w < 612 * 0.95) & (h < 792 * 0.8))


@query(_greedy(f"{_BOTH} > 0.5E0 * {_AREA.format('b')}"))
def remove_duplicate_boxes(spark, sf):
    return by_page(made(spark, sf, BOXES), lambda b: b[B.drop_overlapped(np.column_stack([b[:, :2], b[:, 2] - b[:, 0], b[:, 3] - b[:, 1]]))])


SIZED = f"(SELECT *, x1 - x0 AS w, y1 - y0 AS h FROM ({BOX}))"


def _sized(spark, sf):
    return made(spark, sf, BOXES).withColumn("w", F.col("x1") - F.col("x0")).withColumn("h", F.col("y1") - F.col("y0"))


for _name, _cond in {
    "size_filter": "w >= 100 AND h >= 30",
    "aspect_filter": "h > 0 AND w / h BETWEEN 0.2 AND 5.0",
    "portrait_filter": "h <= w",
    "region_size_filter": "w >= 50 AND h >= 30 AND w * h > 1500 AND w / h BETWEEN 0.2 AND 5.0 AND h <= w AND w < 581.4 AND h < 633.6",
    "contour_size_filter": "w >= 100 AND h >= 30 AND w < 0.9 * 400 AND h < 0.7 * 100 AND w * h > 4000",
    "gate_region_filter": "w / h > 0.3 AND w / h < 4 AND w * h > 400 AND w * h < 50000 AND w > 20 AND h > 20",
}.items():
    query(f"SELECT page_key, x0, y0, x1, y1 FROM {SIZED} WHERE {_cond}", _name)(lambda spark, sf, c=_cond: _sized(spark, sf).where(c).drop("w", "h"))


@query(f"SELECT page_key, [x0, y0, x1, y1] AS box, true AS same FROM ({BOX})")
def bbox_codec(spark, sf):
    """A box as a map of names to numbers, and back."""
    b = made(spark, sf, BOXES).withColumn("m", F.create_map(*(x for c in ("x0", "y0", "x1", "y1") for x in (F.lit(c), F.col(c)))))
    back = [F.col("m")[c] for c in ("x0", "y0", "x1", "y1")]
    same = F.struct(*(x.alias(f"c{i}") for i, x in enumerate(back))) == F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(("x0", "y0", "x1", "y1"))))
    return b.select("page_key", F.array(*back).alias("box"), same.alias("same"))


#: rects of the first place of an image on its page; every fifth box is an image without one
RECTS = "SELECT l_orderkey AS page_key, l_linenumber AS image_no, CASE WHEN l_linenumber % 5 = 0 THEN {empty} ELSE {box} END AS rects FROM lineitem"
_RECT = "CAST(l_partkey % 400 AS DOUBLE), CAST(l_suppkey % 97 AS DOUBLE), CAST(l_partkey % 400 + l_quantity * 4 AS DOUBLE), CAST(l_suppkey % 97 + 10 * l_linenumber AS DOUBLE)"


def first_rect(rects):
    """The first rect of an image on its page, as ``[x0, y0, x1, y1]``; null where the page has none."""
    return F.try_element_at(rects, F.lit(1))


@query(f"SELECT page_key, image_no, rects[1][1] AS x0, rects[1][2] AS y0, rects[1][3] AS x1, rects[1][4] AS y1 FROM ({RECTS.format(empty='CAST([] AS DOUBLE[][])', box=f'[[{_RECT}], [0.0E0, 0.0E0, 1.0E0, 1.0E0]]')})")
def embedded_bbox(spark, sf):
    rows = spark.sql(RECTS.replace("FROM lineitem", "FROM {lineitem}").format(empty="CAST(array() AS array<array<double>>)", box=f"array(array({_RECT}), array(0.0D, 0.0D, 1.0D, 1.0D))", lineitem="{lineitem}"), lineitem=spark.read.parquet(f"{sf}/lineitem.parquet"))
    return rows.select("page_key", "image_no", *(first_rect(F.col("rects"))[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))))


METHODS = [("embedded", 0), ("vector", 1), ("rendered", 2)]


@query(" UNION ALL ".join(f"SELECT page_key, '{m}' AS method, count(*) AS n FROM ({BOX}) WHERE CAST(x0 AS INT) % 3 = {k} GROUP BY 1" for m, k in METHODS))
def union_extraction_methods(spark, sf):
    b = made(spark, sf, BOXES)
    parts = [b.where(F.col("x0").cast("int") % 3 == k).groupBy("page_key").agg(F.count("*").alias("n")).select("page_key", F.lit(m).alias("method"), "n") for m, k in METHODS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"SELECT page_key, x0, y0, 150 AS threshold FROM ({BOX}) WHERE x1 - x0 > 150 UNION ALL SELECT page_key, x0, y0, 200 AS threshold FROM ({BOX}) WHERE x1 - x0 > 190")
def union_thresholds(spark, sf):
    b = made(spark, sf, BOXES)
    part = lambda t, least: b.where(F.col("x1") - F.col("x0") > least).select("page_key", "x0", "y0", F.lit(t).alias("threshold"))
    return part(150, 150).unionByName(part(200, 190))


@query(f"SELECT page_key, round(var_pop(y0), 4) AS y_var, round(avg((x1 - x0) * (y1 - y0)), 4) AS mean_area FROM ({BOX}) GROUP BY 1")
def variance_stats(spark, sf):
    return made(spark, sf, BOXES).groupBy("page_key").agg(F.round(F.var_pop("y0"), 4).alias("y_var"), F.round(F.avg((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))), 4).alias("mean_area"))


# symbols -----------------------------------------------------------------------------------------

OCR = r"replace(translate(regexp_replace(replace(replace(replace(upper(trim(raw_text)), '†', 'DG'), '√', 'SQRT'), 'DAG', 'DG'), '\([^)]+\)', '', 'g'), '01', 'OI'), ' ', '')"
EVERY = tuple(dict.fromkeys([*vocab.HIGH_GATES, *vocab.MEDIUM_GATES, *vocab.LOW_GATES]))
FOUND = f"n AS (SELECT *, {OCR} AS gate FROM ({GATE})), k AS (SELECT * FROM n WHERE gate <> '' AND length(gate) <= 20 AND list_contains({_list(EVERY)}, gate))"
LISTS = f"{FOUND}, gl AS (SELECT image_id, list(gate ORDER BY gate, event_id) AS gates FROM k WHERE list_contains({_list(vocab.OUTPUT_GATES)}, gate) GROUP BY 1)"


def _found(spark, sf):
    g = made(spark, sf, GATES).withColumn("gate", T.normalize_gate_ocr(F.col("raw_text")))
    return g.where((F.col("gate") != "") & (F.length("gate") <= 20) & F.col("gate").isin(*EVERY))


def _lists(spark, sf):
    return _found(spark, sf).where(F.col("gate").isin(*vocab.OUTPUT_GATES)).groupBy("image_id").agg(F.sort_array(F.collect_list("gate")).alias("gates"))


@query(f"SELECT event_id, {OCR} AS gate FROM ({GATE})")
def normalize_gate_ocr(spark, sf):
    return made(spark, sf, GATES).select("event_id", T.normalize_gate_ocr(F.col("raw_text")).alias("gate"))


def _std(x):
    return "CASE lower({0}) ".format(x) + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.GATE_NAMES.items()) + f" ELSE CASE upper({x}) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.GATE_ALIASES.items()) + f" ELSE upper({x}) END END"


@query(f"SELECT image_id, list_sort(list_distinct(list({_std('raw_text')}))) AS gates FROM ({GATE}) GROUP BY 1")
def normalize_gates(spark, sf):
    g = made(spark, sf, GATES).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "raw_text"))).alias("s"))
    return g.select("image_id", F.sort_array(T.normalize_gates(F.transform("s", lambda x: x["raw_text"]))).alias("gates"))


@query(f"WITH {FOUND} SELECT event_id, gate, list_contains({_list(vocab.OUTPUT_GATES)}, gate) AS in_output FROM k")
def gate_vocabulary_filter(spark, sf):
    return _found(spark, sf).select("event_id", "gate", F.col("gate").isin(*vocab.OUTPUT_GATES).alias("in_output"))


@query(f"WITH {FOUND} SELECT image_id, gate, count(*) AS n, CASE WHEN list_contains({_list(vocab.HIGH_GATES)}, gate) THEN 'high' WHEN list_contains({_list(vocab.MEDIUM_GATES)}, gate) THEN 'medium' ELSE 'low' END AS tier FROM k GROUP BY 1, 2")
def gate_counts(spark, sf):
    return _found(spark, sf).groupBy("image_id", "gate").agg(F.count("*").alias("n")).withColumn("tier", T.gate_tier(F.col("gate")))


@query(f"WITH {LISTS} SELECT image_id, gates FROM gl")
def sort_gates(spark, sf):
    return _lists(spark, sf)


@query(f"""WITH {LISTS}, c AS (SELECT image_id, gates, len(list_intersect(gates, {_list(vocab.CONTROL_GATES)})) > 0 AS ctl, len(list_distinct(gates)) AS u FROM gl)
SELECT image_id, round(least(1.0E0, 0.6E0 + CASE WHEN ctl THEN 0.2E0 ELSE 0 END + CASE WHEN u >= 3 THEN 0.1E0 ELSE 0 END + CASE WHEN len(gates) >= 4 THEN 0.1E0 ELSE 0 END), 6) AS confidence,
  CASE WHEN ctl AND u >= 3 THEN 'valid_multi_qubit_circuit' WHEN u >= 2 THEN 'valid_quantum_circuit' ELSE 'borderline_circuit' END AS reason FROM c""")
def gate_set_validation(spark, sf):
    return _lists(spark, sf).select("image_id", T.gate_validation(F.col("gates")).alias("r")).select("image_id", "r.confidence", "r.reason")


@query(f"WITH {LISTS} SELECT image_id, list_sort(list_distinct(list_concat(gates, ['CNOT', 'M']))) AS gates FROM gl")
def gate_set_union(spark, sf):
    return _lists(spark, sf).select("image_id", F.array_sort(F.array_union("gates", F.array(F.lit("CNOT"), F.lit("M")))).alias("gates"))


@query(f"SELECT unnest(list_sort(list_distinct({_list(EVERY)}))) AS gate")
def vocabulary_union(spark, sf):
    lists = [F.array(*map(F.lit, v)) for v in (vocab.HIGH_GATES, vocab.MEDIUM_GATES, vocab.LOW_GATES)]
    return spark.range(1).select(F.explode(F.array_union(F.array_union(lists[0], lists[1]), lists[2])).alias("gate"))


@query(f"SELECT image_id, arg_max(raw_text, (conf, -event_id)) AS best FROM ({GATE}) GROUP BY 1")
def ocr_region(spark, sf):
    return made(spark, sf, GATES).groupBy("image_id").agg(F.max_by("raw_text", F.struct("conf", -F.col("event_id"))).alias("best"))


# decisions and outputs ---------------------------------------------------------------------------

DECIDED = f"""{FILTERED}, fg AS ({FIG}), j AS (SELECT fg.*, decision, caption AS cap, {_topic_sql(NORM.format('caption'))} AS category FROM fg JOIN r USING (doc_id)),
d AS (SELECT *, CASE WHEN NOT readable THEN 'error' WHEN w < 100 OR h < 100 THEN 'too_small' WHEN decision = 'ACCEPT' AND NOT has_gates THEN 'caption_whitelist_no_gates' WHEN decision = 'ACCEPT' THEN 'caption_whitelist'
  WHEN decision = 'REJECT' THEN 'caption_blacklist' WHEN score >= 0.70E0 AND NOT has_gates THEN 'dinov2_high_no_gates' WHEN score >= 0.70E0 THEN 'dinov2_high' WHEN score >= 0.50E0 THEN 'dinov2_medium_rejected' ELSE 'dinov2_low_rejected' END AS tier FROM j),
dd AS (SELECT *, tier IN ('caption_whitelist', 'dinov2_high') AS is_target, round(CASE tier WHEN 'error' THEN 0.0E0 WHEN 'too_small' THEN 0.0E0 WHEN 'caption_whitelist_no_gates' THEN 0.8E0 WHEN 'caption_whitelist' THEN 0.95E0 WHEN 'caption_blacklist' THEN 0.95E0 WHEN 'dinov2_high' THEN score ELSE 1 - score END, 6) AS confidence FROM d)"""


def decided(spark, sf, papers=None):
    """Cheap tests first: size and caption decide natively; only undecided rows look at the score.  Where
    ``papers`` (paper_idx) are given, only their figures meet captions, and only those are decided."""
    figures, col = made(spark, sf, FIGURES), F.col
    if papers is not None:
        figures = figures.join(F.broadcast(papers), col("paper") == col("paper_idx"), "left_semi")
    rows = figures.join(made(spark, sf, CAPTIONS).select("doc_id", "caption"), "doc_id")
    rows = rows.withColumn("decision", T.caption_decision(col("caption"))).withColumn("category", T.phrase_topic(col("caption"))["category"])
    return rows.withColumn("r", K.decide(col("w"), col("h"), col("readable"), col("decision"), col("has_gates"), col("score"))).select("*", "r.*").drop("r")


@query(f"WITH {DECIDED} SELECT doc_id, tier, is_target, confidence FROM dd")
def orchestrate_detect(spark, sf):
    return decided(spark, sf).select("doc_id", "tier", "is_target", F.round("confidence", 6).alias("confidence"))


@query(f"WITH {DECIDED} SELECT paper, count(*) FILTER (WHERE is_target) AS n FROM dd GROUP BY 1")
def circuits_per_paper(spark, sf):
    return decided(spark, sf).groupBy("paper").agg(F.count_if("is_target").alias("n"))


@query(f"WITH {DECIDED} SELECT count(*) AS images, count(DISTINCT paper) AS papers, count(*) FILTER (WHERE is_target) AS found, count(*) FILTER (WHERE tier = 'error') AS failed, count(*) FILTER (WHERE tier = 'too_small') AS skipped FROM dd")
def run_summary(spark, sf):
    return decided(spark, sf).agg(F.count("*").alias("images"), F.count_distinct("paper").alias("papers"), F.count_if("is_target").alias("found"), F.count_if(F.col("tier") == "error").alias("failed"), F.count_if(F.col("tier") == "too_small").alias("skipped"))


@query(f"WITH {DECIDED} SELECT paper, doc_id FROM dd WHERE is_target ORDER BY paper, doc_id LIMIT 25")
def running_total_cap(spark, sf):
    return decided(spark, sf).where("is_target").select("paper", "doc_id").orderBy("paper", "doc_id").limit(25)


@query(f"WITH {DECIDED} SELECT paper, doc_id FROM dd WHERE is_target ORDER BY paper, doc_id LIMIT 7")
def max_circuits_limit(spark, sf):
    return decided(spark, sf).where("is_target").select("paper", "doc_id").orderBy("paper", "doc_id").limit(7)


SEQ = "row_number() OVER (PARTITION BY paper ORDER BY doc_id)"


def _numbered(spark, sf):
    return decided(spark, sf).where("is_target").withColumn("n", F.row_number().over(W.partitionBy("paper").orderBy("doc_id")))


@query(f"WITH {DECIDED} SELECT paper, doc_id, {SEQ} AS n FROM dd WHERE is_target")
def per_paper_sequence(spark, sf):
    return _numbered(spark, sf).select("paper", "doc_id", F.col("n").cast("long").alias("n"))


@query(f"SELECT doc_id, paper, row_number() OVER (PARTITION BY paper ORDER BY w * h DESC, doc_id) - 1 AS image_index FROM ({FIG})")
def image_index(spark, sf):
    w = W.partitionBy("paper").orderBy(F.desc(F.col("w") * F.col("h")), "doc_id")
    return made(spark, sf, FIGURES).select("doc_id", "paper", (F.row_number().over(w) - 1).cast("long").alias("image_index"))


@query(f"""WITH {DECIDED} SELECT 'p' || paper || '_' || {SEQ} || '.png' AS filename, 'p' || paper AS arxiv_number, w % 9 + 1 AS page_number, CASE WHEN h % 5 > 0 THEN h % 5 END AS figure_number,
  CASE WHEN has_gates THEN ['CNOT', 'H'] ELSE [] END AS quantum_gates, category AS quantum_problem, [md5(cap)] AS descriptions, [[w, w + h]] AS text_positions FROM dd WHERE is_target""")
def output_record_projection(spark, sf):
    """Records under the names of the dataset; positions become pairs."""
    c = F.col
    d = _numbered(spark, sf).withColumn("positions", F.array(F.struct(c("w").alias("start"), (c("w") + c("h")).alias("end"))))
    gates = F.when(c("has_gates"), F.array(F.lit("CNOT"), F.lit("H"))).otherwise(F.array().cast("array<string>"))
    paper = F.concat(F.lit("p"), c("paper").cast("string"))
    return O.output_records(d.select(
        F.concat(paper, F.lit("_"), c("n").cast("string"), F.lit(".png")).alias("filename"), paper.alias("arxivNumber"), (c("w") % 9 + 1).alias("pageNumber"), F.when(c("h") % 5 > 0, c("h") % 5).alias("figureNumber"),
        gates.alias("quantumGates"), c("category").alias("quantumProblem"), F.array(F.md5("caption")).alias("descriptions"), c("positions").alias("textPositions")))


UPD = "SELECT event_id AS seq, user_id AS id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id % 13 END AS n FROM events"


def _updates(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("seq"), F.col("user_id").alias("id"), F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 13).alias("n"))


def _counts(spark, sf):
    return _updates(spark, sf).groupBy("id").agg(F.max(F.struct("seq", "n")).alias("last"), F.min("seq").alias("first_seq")).select("id", F.col("last.n").alias("n"), "first_seq")


CNT = f"cn AS (SELECT id, n, first_seq FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS r, min(seq) OVER (PARTITION BY id) AS first_seq FROM ({UPD})) WHERE r = 1)"


@query(f"WITH {CNT} SELECT id, n, first_seq FROM cn")
def update_counts(spark, sf):
    return _counts(spark, sf)


@query(f"WITH {CNT} SELECT id, n FROM cn UNION ALL SELECT doc_id AS id, NULL AS n FROM documents WHERE doc_id NOT IN (SELECT id FROM cn)")
def mark_remaining_blank(spark, sf):
    known = _counts(spark, sf).select("id", "n")
    d = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"))
    return known.unionByName(d.join(known, "id", "left_anti").withColumn("n", F.lit(None).cast("long")))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT user_id FROM events)")
def resume_anti_join(spark, sf):
    d, e = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "events"))
    return d.join(e, d["doc_id"] == e["user_id"], "left_anti").select("doc_id")


@query(f"SELECT doc_id, paper, 5 AS found FROM ({FIG}) WHERE paper > 17")
def resume_point(spark, sf):
    """What is left after a saved state: papers after its last one, with the figures found so far."""
    path = shared_path(spark, "state")
    O.save_state(spark, path, last_paper_index=17, last_paper_id="p17", total_found=5, processed=18, skipped=0, failed=0, timestamp="now", version="1.0")
    start, found = O.resume_point(O.load_state(spark, path))
    return made(spark, sf, FIGURES).where(F.col("paper") >= start).select("doc_id", "paper", F.lit(found).alias("found"))


@query(f"WITH {CNT} SELECT count(*) AS n_rows, count(n) AS n_counted, sum(n) AS total FROM cn")
def sink_accessors(spark, sf):
    return _counts(spark, sf).agg(F.count("*").alias("n_rows"), F.count("n").alias("n_counted"), F.sum("n").alias("total"))


@query("SELECT doc_id, CASE WHEN place <= 35 THEN 'first' ELSE 'second' END AS part FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS place FROM documents) WHERE place <= 55")
def random_sample_split(spark, sf):
    """A sample of 55 in hash order, split 35 and 20: the limit is the feature."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("h"))
    top = indexed(d.orderBy("h", "doc_id").limit(55), "h", "place")
    return top.select("doc_id", F.when(F.col("place") < 35, "first").otherwise("second").alias("part"))
