"""Inputs derived from the test tables by projections that read the same in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from figmine.sources.spread import spread

CAPTIONS = """SELECT doc_id, lang, lead, concat(lead, replace(text, chr(10), ' ')) AS caption, text AS body FROM (SELECT doc_id, lang, text,
  concat('Figure ', CAST(doc_id % 9 + 1 AS STRING), ': ',
  CASE doc_id % 7 WHEN 0 THEN 'Quantum circuit for ' WHEN 1 THEN 'Histogram of ' WHEN 2 THEN 'QAOA circuit and '
    WHEN 3 THEN 'Plot of quantum circuit ' WHEN 4 THEN 'Surface\u00a0code\u2003 decoder\u3000' WHEN 5 THEN 'Grover search ' ELSE '' END) AS lead FROM {documents})"""
IDS = """SELECT doc_id AS line_no, CASE doc_id % 8 WHEN 0 THEN '' WHEN 1 THEN '# comment'
  WHEN 2 THEN concat('arXiv:', CAST(2401 + doc_id % 12 AS STRING), '.', lpad(CAST(doc_id % 500 AS STRING), 5, '0'))
  WHEN 3 THEN concat('  arxiv:quant-ph/', lpad(CAST(doc_id % 300 AS STRING), 7, '0'), ' ')
  WHEN 4 THEN concat('2402.', CAST(doc_id AS STRING), 'v2') WHEN 5 THEN 'not an id'
  ELSE concat('2403.', lpad(CAST(doc_id % 100 AS STRING), 5, '0')) END AS raw FROM {documents}"""
GATES = """SELECT event_id, CAST(floor(event_id / 5) AS BIGINT) AS image_id, CASE event_id % 11 WHEN 0 THEN 'H' WHEN 1 THEN 'cx'
  WHEN 2 THEN 'Rx(t)' WHEN 3 THEN 'Toffoli' WHEN 4 THEN 'U1' WHEN 5 THEN 'FIG' WHEN 6 THEN 'SWAP' WHEN 7 THEN 'Sdag'
  WHEN 8 THEN 'measure' WHEN 9 THEN 'CZ' ELSE 'noise text' END AS raw_text, CAST(event_id % 97 AS DOUBLE) / 97 AS conf FROM {events}"""
BOXES = """SELECT DISTINCT l_orderkey AS page_key, CAST(l_partkey % 400 AS DOUBLE) AS x0, CAST(l_suppkey % 97 AS DOUBLE) AS y0,
  CAST(l_partkey % 400 + l_quantity * 4 AS DOUBLE) AS x1, CAST(l_suppkey % 97 + 10 * l_linenumber AS DOUBLE) AS y1 FROM {lineitem}"""
VECTORS = "SELECT vec_id, embedding, CASE WHEN label < 5 THEN 1 ELSE 0 END AS is_target, label, vec_id % 50 = 0 AS is_query FROM {embeddings}"
FIGURES = """SELECT doc_id, CAST(doc_id % 400 + 20 AS INT) AS w, CAST(doc_id % 170 + 40 AS INT) AS h, doc_id % 53 <> 0 AS readable,
  doc_id % 3 <> 0 AS has_gates, CAST(doc_id % 101 AS DOUBLE) / 100 AS score, CAST(doc_id % 40 AS INT) AS paper FROM {documents}"""
TABLES = ("documents", "events", "lineitem", "embeddings", "labels", "conversations", "pages", "benchmark")


def made(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A fixture over the tables that its text names; whole texts are dealt over all cores."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(text, **{t: spread(read(t)) if text == CAPTIONS else read(t) for t in TABLES if "{" + t + "}" in text})


def in_sql(text: str) -> str:
    return text.format(**{t: t for t in TABLES})


#: layout blocks of documents: the lines of a text, eight to a page, in two columns
RAW_SPARK = r"SELECT doc_id, CAST(pos AS BIGINT) AS block_no, trim(line) AS line FROM {documents} LATERAL VIEW posexplode(split(text, '\n')) t AS pos, line WHERE trim(line) <> ''"
RAW_DUCKDB = """SELECT doc_id, i - 1 AS block_no, trim(line) AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE trim(line) <> ''"""
LAYOUT = """b AS (SELECT doc_id, CAST(block_no AS INT) AS block_no, CAST(floor(block_no / 8) AS INT) + 1 AS page,
  concat(CASE WHEN block_no % 4 = 1 THEN concat('Figure ', CAST(CAST(floor(block_no / 4) AS INT) + 1 AS STRING), ': ')
    WHEN block_no % 4 = 3 THEN concat('As shown in Fig. ', CAST(CAST(floor(block_no / 4) AS INT) + 1 AS STRING), ', ') ELSE '' END,
    CASE WHEN block_no % 8 = 2 AND doc_id % 3 = 0 THEN concat(CASE doc_id % 4 WHEN 0 THEN '(' WHEN 1 THEN ' Eq. (' WHEN 2 THEN '[' ELSE 'Equation (' END, CAST(block_no + 1 AS STRING),
      CASE doc_id % 5 WHEN 0 THEN '.5' ELSE '' END, CASE doc_id % 4 WHEN 2 THEN ']' ELSE ')' END) ELSE line END) AS text FROM raw),
g AS (SELECT *, 72.0E0 + (block_no % 2) * 40 AS x0, 60.0E0 + (block_no % 8) * 80 AS y0, 372.0E0 + (block_no % 2) * 40 AS x1,
  80.0E0 + (block_no % 8) * 80 + length(text) % 40 AS y1 FROM b),
f AS (SELECT DISTINCT doc_id, page, k AS fig_no, 80.0E0 AS fx0, 60.0E0 + 240 * k AS fy0, 360.0E0 AS fx1, 130.0E0 + 240 * k AS fy1,
  CAST((page - 1) * 2 + k + 1 AS INT) AS number FROM b CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) ks)"""


def layout(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, figures)"""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = f"WITH raw AS ({RAW_SPARK}), {LAYOUT} SELECT "
    return spark.sql(text + "* FROM g", documents=docs), spark.sql(text + "* FROM f", documents=docs)


LAYOUT_SQL = f"raw AS ({RAW_DUCKDB}), {LAYOUT}"
