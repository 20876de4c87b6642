"""Queries over page layout: blocks, figures, and the text around them."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from figmine.functions import text as T
from figmine.operators import layout as L
from figmine.plans.fixtures import LAYOUT_SQL, layout
from figmine.plans.registry import query
from figmine.plans.text_queries import _dot

OFFSETS = "o AS (SELECT *, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start FROM g)"
UNI = r"regexp_replace({}, '[^\x00-\x7F]', '0', 'g')"
CLEAN = r"""(CASE WHEN length(u) <= 500 THEN u WHEN {dot} > 100 THEN left(u, {dot} + 1) ELSE left(u, 500) || '...' END)""".format(dot=_dot("left(u, 500)"))
CAPTIONS = rf"""near AS (SELECT f.doc_id, f.page, f.fig_no, g.block_no, y0 - fy1 AS gap, regexp_extract(text, '(?is)(\bFig(?:ure|\.)?\s+.*)$', 1) AS t FROM f JOIN g ON f.doc_id = g.doc_id AND f.page = g.page
  AND y0 >= fy1 AND y0 - fy1 <= 200 AND greatest(0.0E0, least(x1, fx1) - greatest(x0, fx0)) >= (fx1 - fx0) * 0.3E0 WHERE regexp_matches(text, '(?i)\bFig(?:ure|\.)?\s+')),
cut AS (SELECT *, CASE WHEN length(t) > 50 AND regexp_extract(substr(t, 51), '(?s)^(.*?\.)\s+[A-Z]', 1) <> '' THEN left(t, 50) || regexp_extract(substr(t, 51), '(?s)^(.*?\.)\s+[A-Z]', 1) ELSE t END AS u FROM near),
cap0 AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({CLEAN}, '\s+\([a-z]\)\s*$', ''), '\s+\(a\)\s*\(b\)\s*\(c\)\s*$', ''), '\s*=\s*=\s*$', ''), '\s*=\s*\([a-z]\)\s*\([a-z]\)\s*=\s*$', ''), '\s+', ' ', 'g')) AS caption FROM cut),
cap AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, fig_no ORDER BY gap, block_no) AS r FROM cap0 WHERE NOT {{matrix}}) WHERE r = 1)"""


def _matrix(x):
    u = UNI.format(x)
    return (rf"coalesce(length({x}) >= 10 AND length(replace({x}, ' ', '')) > 0 AND (length({x}) - length(regexp_replace({x}, '[-−]?\d+', '', 'g')) > length(replace({x}, ' ', '')) * 0.4E0"
            rf" OR (len(regexp_extract_all({x}, '[-−]?\d+')) > 10 AND len(regexp_extract_all({u}, '\b[a-zA-Z]{{3,}}\b')) < 5) OR (len(regexp_extract_all({x}, '[=+\-−×÷√∑∏∫]')) > 5 AND len(regexp_extract_all({u}, '\b[a-zA-Z]{{3,}}\b')) < 3) OR regexp_matches({x}, '(\d+\s+){{4,}}')), false)")


CAPTIONS = CAPTIONS.replace("{matrix}", _matrix("caption"))


def _with_offsets(spark, sf):
    blocks, figures = layout(spark, sf)
    return L.running_offsets(blocks, ["doc_id"], "block_no"), figures


@query(f"WITH {LAYOUT_SQL} SELECT doc_id, page, block_no, text FROM g")
def text_block_scan(spark, sf):
    return layout(spark, sf)[0].select("doc_id", "page", "block_no", "text")


@query(f"WITH {LAYOUT_SQL}, {OFFSETS} SELECT doc_id, block_no, char_start, char_start + length(text) AS char_end FROM o")
def running_char_offset(spark, sf):
    return _with_offsets(spark, sf)[0].select("doc_id", "block_no", "char_start", (F.col("char_start") + F.length("text")).alias("char_end"))


PAGES = """p AS (SELECT doc_id, page, string_agg(text, chr(10) ORDER BY block_no) AS page_text FROM g GROUP BY 1, 2),
s AS (SELECT *, CAST(coalesce(sum(length(page_text) + 1) OVER (PARTITION BY doc_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS page_start FROM p)"""


def _pages(spark, sf):
    blocks, _ = layout(spark, sf)
    p = blocks.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "text"))), lambda s: s["text"]), "\n").alias("page_text"))
    return L.running_offsets(p, ["doc_id"], "page", "page_text").withColumnRenamed("char_start", "page_start")


@query(f"WITH {LAYOUT_SQL}, {PAGES} SELECT doc_id, page, page_start, page_start + length(page_text) AS page_end, md5(page_text) AS digest FROM s")
def pdf_document_scan(spark, sf):
    return _pages(spark, sf).select("doc_id", "page", "page_start", (F.col("page_start") + F.length("page_text")).alias("page_end"), F.md5("page_text").alias("digest"))


@query(f"WITH {LAYOUT_SQL}, {PAGES}, q AS (SELECT *, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id, page ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS own FROM g) SELECT q.doc_id, q.block_no, page_start + own AS char_start FROM q JOIN s ON q.doc_id = s.doc_id AND q.page = s.page")
def page_offset_join(spark, sf):
    b = L.running_offsets(layout(spark, sf)[0], ["doc_id", "page"], "block_no")
    return b.join(_pages(spark, sf), ["doc_id", "page"]).select("doc_id", "block_no", (F.col("page_start") + F.col("char_start")).alias("char_start"))


@query(f"WITH {LAYOUT_SQL}, {CAPTIONS} SELECT doc_id, page, fig_no, block_no, caption, gap FROM cap")
def caption_join(spark, sf):
    blocks, figures = layout(spark, sf)
    return L.caption_join(figures, blocks)


_EQUATION = L.EQUATION.replace("(?iU)", "(?i)")


@query(rf"""WITH {LAYOUT_SQL}, e AS (SELECT *, {" || ".join(f"regexp_extract(text, '{_EQUATION}', {i})" for i in (1, 2, 3, 4))} AS equation FROM g WHERE regexp_matches(text, '{_EQUATION}')),
n AS (SELECT f.doc_id, f.page, f.fig_no, block_no, equation, least(CASE WHEN x0 >= fx1 - 30 THEN abs(x0 - fx1) ELSE 999 END, CASE WHEN x1 <= fx0 + 30 THEN abs(fx0 - x1) ELSE 999 END, CASE WHEN y0 >= fy1 - 30 THEN abs(y0 - fy1) ELSE 999 END) AS gap
  FROM f JOIN e ON f.doc_id = e.doc_id AND f.page = e.page WHERE (((x0 >= fx1 - 30 AND abs(x0 - fx1) < 150) OR (x1 <= fx0 + 30 AND abs(fx0 - x1) < 150)) AND (y0 + y1) / 2 >= fy0 + (fy1 - fy0) * 0.25E0)
    OR (y0 >= fy1 - 30 AND abs(y0 - fy1) < 100 AND x0 >= fx0 - 50 AND x0 <= fx1 + 50))
SELECT doc_id, page, fig_no, block_no, equation, gap FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, fig_no ORDER BY gap, block_no) AS r FROM n) WHERE r = 1""")
def equation_join(spark, sf):
    blocks, figures = layout(spark, sf)
    return L.equation_join(figures, blocks)


NEAR = """n AS (SELECT f.doc_id, f.page, f.fig_no, block_no, text, sqrt(pow((x0 + x1) / 2 - (fx0 + fx1) / 2, 2) + pow((y0 + y1) / 2 - (fy0 + fy1) / 2, 2)) AS gap FROM f JOIN g ON f.doc_id = g.doc_id AND f.page = g.page),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, fig_no ORDER BY gap, block_no) AS rank FROM n WHERE gap <= 400)"""


@query(f"WITH {LAYOUT_SQL}, {NEAR} SELECT doc_id, page, fig_no, block_no, rank FROM k WHERE rank <= 3")
def nearest_k(spark, sf):
    blocks, figures = layout(spark, sf)
    return L.nearest_blocks(figures, blocks, k=3).select(*L.FIGURE, "block_no", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {LAYOUT_SQL}, {NEAR} SELECT doc_id, page, fig_no, block_no FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, fig_no ORDER BY rank) AS place FROM k WHERE rank <= 15 AND length(text) >= 120) WHERE place <= 2")
def first_n_passing(spark, sf):
    blocks, figures = layout(spark, sf)
    near = L.nearest_blocks(figures, blocks).where(F.length("text") >= 120)
    return near.withColumn("place", F.row_number().over(W.partitionBy(*L.FIGURE).orderBy("rank"))).where("place <= 2").select(*L.FIGURE, "block_no")


@query(f"WITH {LAYOUT_SQL} SELECT doc_id, page, arg_max(block_no, (length(text), -block_no)) AS block_no FROM g GROUP BY 1, 2")
def argmax_text(spark, sf):
    return layout(spark, sf)[0].groupBy("doc_id", "page").agg(F.max_by("block_no", F.struct(F.length("text"), -F.col("block_no"))).alias("block_no"))


CUT600 = f"CASE WHEN length(text) <= 600 THEN text WHEN {_dot('left(text, 600)')} > 100 THEN left(text, {_dot('left(text, 600)')} + 1) ELSE left(text, 600) || '...' END"
SURROUND = rf"""n AS (SELECT f.doc_id, f.page, f.fig_no, g.block_no, text, sqrt(pow((x0 + x1) / 2 - (fx0 + fx1) / 2, 2) + pow((y0 + y1) / 2 - (fy0 + fy1) / 2, 2)) AS gap
  FROM f JOIN g ON f.doc_id = g.doc_id AND f.page = g.page LEFT JOIN cap ON cap.doc_id = f.doc_id AND cap.page = f.page AND cap.fig_no = f.fig_no WHERE NOT coalesce(text = cap.caption OR g.block_no = cap.block_no, false)),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, fig_no ORDER BY gap, block_no) AS rank, len(regexp_extract_all(text, '[θφπ∑∏∫=+\-×÷√|⟩⟨]')) AS math, {_matrix('text')} AS matrix FROM n WHERE gap <= 400),
t AS (SELECT *, CASE WHEN rank <= 15 AND length(text) >= 30 AND len(regexp_extract_all({UNI.format('text')}, '\b[a-zA-Z]{{3,}}\b')) >= 3 AND NOT matrix AND math <= length(text) * 0.3E0 THEN 1
  WHEN rank <= 15 AND length(text) >= 20 AND len(regexp_extract_all({UNI.format('text')}, '\b[a-zA-Z]{{2,}}\b')) >= 1 AND NOT matrix AND math <= length(text) * 0.5E0 THEN 2
  WHEN rank <= 10 AND length(text) >= 15 AND NOT matrix THEN 3 END AS tier FROM k),
m AS (SELECT *, min(tier) OVER (PARTITION BY doc_id, page, fig_no) AS best FROM t WHERE tier IS NOT NULL),
q AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, fig_no ORDER BY rank) AS place FROM m WHERE tier = best),
sur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, fig_no ORDER BY length(text) DESC, rank) AS r FROM q WHERE place <= CASE tier WHEN 1 THEN 5 WHEN 2 THEN 3 ELSE 2 END) WHERE r = 1)"""


@query(f"WITH {LAYOUT_SQL}, {CAPTIONS}, {SURROUND} SELECT doc_id, page, fig_no, block_no, tier, {CUT600} AS surrounding FROM sur")
def surrounding_join(spark, sf):
    blocks, figures = layout(spark, sf)
    return L.surrounding_join(figures, blocks, L.caption_join(figures, blocks))


@query(f"WITH {LAYOUT_SQL}, {CAPTIONS}, {SURROUND} SELECT tier, count(*) AS n FROM sur GROUP BY tier")
def surrounding_tiers(spark, sf):
    return surrounding_join(spark, sf).groupBy("tier").agg(F.count("*").alias("n"))


REFERENCES = rf"""{OFFSETS}, men AS (SELECT doc_id, block_no, text, char_start, CAST(number AS INT) AS number FROM (SELECT *, unnest(list_distinct(regexp_extract_all(text, '(?i)\bfig(?:\.\s*|\s+|ure\s*)(\d+)\b', 1))) AS number FROM o)
  WHERE length(text) >= 30 AND len(regexp_extract_all({UNI.format('text')}, '\b[a-zA-Z]{{3,}}\b')) >= 5),
ref AS (SELECT * FROM (SELECT men.*, row_number() OVER (PARTITION BY men.doc_id, men.number ORDER BY length(text) DESC, block_no) AS r FROM men JOIN (SELECT DISTINCT doc_id, number FROM f) w ON men.doc_id = w.doc_id AND men.number = w.number) WHERE r = 1)"""


@query(f"WITH {LAYOUT_SQL}, {REFERENCES} SELECT doc_id, number, block_no, char_start, md5(left(text, 150)) AS head FROM ref")
def figure_reference_join(spark, sf):
    blocks, figures = _with_offsets(spark, sf)
    return L.figure_reference_join(figures, blocks).select("doc_id", "number", "block_no", "char_start", F.md5(F.left("reference", F.lit(150))).alias("head"))


ASSEMBLED = f"""im AS (SELECT f.doc_id, f.page, f.fig_no, cap.caption, sur.text AS surrounding, ref.text AS reference, coalesce(f.number, 0) AS number FROM f
  LEFT JOIN cap ON cap.doc_id = f.doc_id AND cap.page = f.page AND cap.fig_no = f.fig_no LEFT JOIN sur ON sur.doc_id = f.doc_id AND sur.page = f.page AND sur.fig_no = f.fig_no
  LEFT JOIN ref ON ref.doc_id = f.doc_id AND ref.number = f.number)"""


def images(spark, sf):
    """Figures with caption, surrounding text and reference: a chain of left joins on the figure's key."""
    blocks, figures = _with_offsets(spark, sf)
    captions = L.caption_join(figures, blocks)
    around = L.surrounding_join(figures, blocks, captions).select(*L.FIGURE, "surrounding")
    refs = L.figure_reference_join(figures, blocks).select("doc_id", "number", "reference")
    return figures.select(*L.FIGURE, "number").join(captions.select(*L.FIGURE, "caption"), L.FIGURE, "left").join(around, L.FIGURE, "left").join(refs, ["doc_id", "number"], "left")


@query(f"WITH {LAYOUT_SQL}, {CAPTIONS}, {SURROUND}, {REFERENCES}, {ASSEMBLED} SELECT doc_id, page, fig_no, number, caption IS NOT NULL AS has_caption, surrounding IS NOT NULL AS has_surrounding, reference IS NOT NULL AS has_reference FROM im")
def image_metadata_assembly(spark, sf):
    has = lambda c: F.col(c).isNotNull().alias(f"has_{c}")
    return images(spark, sf).select(*L.FIGURE, "number", has("caption"), has("surrounding"), has("reference"))


@query(f"""WITH {LAYOUT_SQL}, {CAPTIONS}, {SURROUND}, {REFERENCES}, {ASSEMBLED} SELECT doc_id, page, fig_no, CASE WHEN length(reference) >= 15 THEN 'referenced' WHEN length(caption) >= 5 THEN 'caption' WHEN length(surrounding) >= 1 THEN 'surrounding' ELSE 'none' END AS description FROM im""")
def select_description(spark, sf):
    long = lambda c, n: F.length(c) >= n
    return images(spark, sf).select(*L.FIGURE, F.when(long("reference", 15), "referenced").when(long("caption", 5), "caption").when(long("surrounding", 1), "surrounding").otherwise("none").alias("description"))


