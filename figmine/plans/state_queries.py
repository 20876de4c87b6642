"""Queries over references, scans of figures, written outputs, saved state and whole runs."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from figmine import vocab
from figmine.functions import text as T
from figmine.operators import classify as K
from figmine.operators.boxes import by_page
from figmine.plans import other_queries as Q
from figmine.plans.fixtures import BOXES, CAPTIONS, FIGURES, GATES, RAW_DUCKDB, RAW_SPARK, VECTORS, in_sql, made
from figmine.plans.other_queries import CENT, CNT, DECIDED, FOUND, SEQ, _list
from figmine.plans.registry import query
from figmine.plans.text_queries import C, STRIP
from figmine.plans.vision_queries import CIRCUIT, MATH, S, SCORES, STATS, STRUCTURED, TEXT
from figmine.sinks import outputs as O
from figmine.sinks.shared import shared_path
from figmine.streaming import incremental
from figmine.vision import backend
from figmine.vision import rules as R

# references and descriptions ----------------------------------------------------------------------

REFERENCES = f"SELECT doc_id, block_no, CASE WHEN block_no % 5 = 0 THEN 'Figure 2:' ELSE line END AS line FROM ({{}})"


def _references(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return spark.sql(REFERENCES.format(RAW_SPARK), documents=docs)


@query(rf"SELECT doc_id, block_no FROM ({REFERENCES.format(RAW_DUCKDB)}) WHERE length(line) <= 500 AND NOT regexp_matches(line, '(?i)^Figure\s+2\s*[:.]?\s*$')")
def fig_ref_sanity(spark, sf):
    return _references(spark, sf).where(T.sane_reference(F.col("line"), F.lit(2))).select("doc_id", "block_no")


@query(f"SELECT doc_id, list(md5(line) ORDER BY block_no)[1:5] AS refs FROM ({REFERENCES.format(RAW_DUCKDB)}) GROUP BY doc_id")
def refs_limit_5(spark, sf):
    found = _references(spark, sf).withColumn("place", F.row_number().over(W.partitionBy("doc_id").orderBy("block_no"))).where("place <= 5")
    lists = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("place", F.md5("line").alias("h")))).alias("refs"))
    return lists.select("doc_id", T.limit_references(F.transform("refs", lambda r: r["h"])).alias("refs"))


@query(f"""WITH x AS (SELECT doc_id, {STRIP.format('caption')} AS c, {STRIP.format('lead')} AS l, caption || ' ' || body AS whole FROM ({C})),
p AS (SELECT doc_id, c AS t, instr(whole, c) - 1 AS s FROM x WHERE coalesce(c, '') <> '' UNION ALL SELECT doc_id, l, coalesce(instr(whole, l) - 1, 0) FROM x WHERE c IS DISTINCT FROM l)
SELECT doc_id, md5(t) AS digest, CAST(s AS INT) AS begins, CAST(CASE WHEN t = l THEN coalesce(s + length(t) * sign(length(whole)), 0) ELSE s + length(t) END AS INT) AS ends FROM p JOIN x USING (doc_id)
UNION ALL SELECT doc_id, md5('As shown in Fig. 2.') AS digest, 5 AS begins, 24 AS ends FROM documents""")
def extract_descriptions(spark, sf):
    refs = F.array(F.struct(F.lit("As shown in Fig. 2.").alias("text"), F.lit(5).alias("start"), F.lit(24).alias("end")))
    x = made(spark, sf, CAPTIONS).withColumn("whole", F.concat("caption", F.lit(" "), "body"))
    rows = x.select("doc_id", F.explode(T.descriptions(F.col("caption"), F.col("lead"), refs, F.col("whole"))).alias("d"))
    return rows.select("doc_id", F.md5("d.text").alias("digest"), F.col("d.start").alias("begins"), F.col("d.end").alias("ends"))


# image rules and scans ----------------------------------------------------------------------------

PLACES = f"""g AS (SELECT page_key, list(y0) AS tops, list_sort(list_distinct(list(y0))) AS t, list_sort(list(floor((x0 + x1) / 2))) AS xs, list_sort(list(floor((y0 + y1) / 2))) AS ys FROM ({in_sql(BOXES)}) GROUP BY 1),
v AS (SELECT *, {", ".join(f"round(list_aggregate(list_transform(range(1, len({c})), lambda i: {c}[i + 1] - {c}[i]), 'var_pop'), 6) AS {c}v" for c in ("t", "xs", "ys"))} FROM g)"""


@query(f"WITH {PLACES} SELECT page_key, CASE WHEN len(tops) < 4 OR tv IS NULL THEN 0.0E0 WHEN tv < 100 THEN 1.0E0 WHEN tv < 300 THEN 0.5E0 ELSE 0.0E0 END AS score FROM v")
def detect_grid(spark, sf):
    return made(spark, sf, BOXES).groupBy("page_key").agg(F.collect_list("y0").alias("tops")).select("page_key", R.grid_score(F.col("tops")).alias("score"))


@query(f"WITH {PLACES} SELECT page_key, CASE WHEN len(xs) < 4 THEN 0.0E0 WHEN xsv < 500 AND ysv < 500 THEN 1.0E0 WHEN xsv < 1000 OR ysv < 1000 THEN 0.5E0 ELSE 0.0E0 END AS score FROM v")
def regular_spacing(spark, sf):
    centres = made(spark, sf, BOXES).groupBy("page_key").agg(F.collect_list(F.floor((F.col("x0") + F.col("x1")) / 2)).alias("xs"), F.collect_list(F.floor((F.col("y0") + F.col("y1")) / 2)).alias("ys"))
    return centres.select("page_key", R.spacing_score(F.col("xs"), F.col("ys")).alias("score"))


@query("SELECT event_id, CAST(((event_id % 256) * 19595 + (event_id * 7 % 256) * 38470 + (event_id * 3 % 256) * 7471 + 32768) >> 16 AS INT) AS gray FROM events")
def grayscale_convert(spark, sf):
    channel = lambda k: (F.col("event_id") * k % 256).cast("int")
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", R.luma(channel(1), channel(7), channel(3)).alias("gray"))


MATRIX = f"((CASE WHEN quads >= 3 THEN 0.8E0 ELSE 0 END * 2.0E0 + 0.5E0 * 1.5E0 + {SCORES} * 1.5E0) / 6.0E0 > 0.4E0)"


def _judged(spark, sf):
    s = made(spark, sf, STATS)
    matrix = R.is_matrix(R.bracket_score(F.col("quads") >= 3, F.lit(False)), F.lit(0.5), R.line_score(F.col("h_lines")), F.lit(0.0))
    return s, F.struct(*s.columns), matrix


@query(f"SELECT event_id, width, height FROM ({S}) WHERE width >= 200 AND height >= 150 AND CAST(width AS DOUBLE) / height BETWEEN 0.2 AND 5.0 AND height <= width AND NOT {MATRIX}")
def embedded_image_scan(spark, sf):
    s, row, matrix = _judged(spark, sf)
    return s.where(R.embedded_image(row, matrix)).select("event_id", "width", "height")


@query(f"SELECT event_id, round(width * 72 / 300.0E0, 6) AS w, round(height * 72 / 300.0E0, 6) AS h FROM ({S}) WHERE NOT {TEXT} AND ({CIRCUIT} OR NOT {MATH}) AND {STRUCTURED} AND width >= 150 AND height >= 100 AND NOT {MATRIX}")
def rendered_region_scan(spark, sf):
    s, row, matrix = _judged(spark, sf)
    return s.where(R.rendered_region(row, matrix)).select("event_id", F.round(F.col("width") * 72 / 300, 6).alias("w"), F.round(F.col("height") * 72 / 300, 6).alias("h"))


@query(f"{Q._GROUPED} SELECT *, CAST(round((x1 - x0) * 300 / 72) AS BIGINT) AS width, CAST(round((y1 - y0) * 300 / 72) AS BIGINT) AS height FROM grouped")
def vector_region_scan(spark, sf):
    """Grouped drawings with the size of their clip at 300 dpi; no matrix rule here."""
    px = lambda a, b: F.round((F.col(b) - F.col(a)) * 300 / 72).cast("long")
    return Q.group_drawings(spark, sf).withColumn("width", px("x0", "x1")).withColumn("height", px("y0", "y1"))


@query()
def find_gate_regions(spark, sf):
    """The boxes of each page are drawn and found again as candidate symbols."""
    return by_page(made(spark, sf, BOXES), together=lambda pages: backend.gate_regions_of(map(backend.draw, pages)))


@query(f"""WITH {FOUND}, c AS (SELECT image_id, gate, count(*) AS n FROM k GROUP BY 1, 2),
l AS (SELECT image_id, list(gate ORDER BY gate) AS every, list(gate ORDER BY gate) FILTER (WHERE list_contains({_list(vocab.OUTPUT_GATES)}, gate)) AS gates,
  list(gate || ':' || n || ':' || CASE WHEN list_contains({_list(vocab.HIGH_GATES)}, gate) THEN 'high' WHEN list_contains({_list(vocab.MEDIUM_GATES)}, gate) THEN 'medium' ELSE 'low' END ORDER BY gate)
  FILTER (WHERE list_contains({_list(vocab.OUTPUT_GATES)}, gate)) AS tiers FROM c GROUP BY 1),
a AS (SELECT i.image_id, coalesce(every, []) AS every, coalesce(gates, []) AS gates, coalesce(tiers, []) AS tiers FROM (SELECT DISTINCT image_id FROM ({in_sql(GATES)})) i LEFT JOIN l USING (image_id)),
b AS (SELECT *, len(every) AS u, len(list_intersect(every, {_list(vocab.CONTROL_GATES)})) > 0 AS ctl FROM a)
SELECT image_id, gates, len(gates) AS gate_count, tiers, len(gates) > 0 AS is_valid,
  CASE WHEN u = 0 THEN 0.0E0 WHEN len(gates) = 0 THEN 0.3E0 ELSE round(least(1.0E0, 0.6E0 + CASE WHEN ctl THEN 0.2E0 ELSE 0 END + CASE WHEN u >= 3 THEN 0.1E0 ELSE 0 END + CASE WHEN u >= 4 THEN 0.1E0 ELSE 0 END), 6) END AS confidence,
  CASE WHEN u = 0 THEN 'no_gates_found' WHEN len(gates) = 0 THEN 'no_quantum_specific_gates' WHEN ctl AND u >= 3 THEN 'valid_multi_qubit_circuit' WHEN u >= 2 THEN 'valid_quantum_circuit' ELSE 'borderline_circuit' END AS reason FROM b""")
def detect_gates(spark, sf):
    return K.detect_gates(made(spark, sf, GATES))


# outputs and state --------------------------------------------------------------------------------

RECORDS = f"SELECT 'p' || paper || '_' || {SEQ} || '.png' AS filename, 'p' || paper AS arxiv_number, category AS quantum_problem, doc_id FROM dd WHERE is_target"
RECORD = "filename string, arxiv_number string, quantum_problem string, doc_id long"
COUNTS = "SELECT 'p' || id AS arxiv_id, CAST(n AS INT) AS circuit_count FROM cn"


def _records(rows):
    paper = F.concat(F.lit("p"), F.col("paper").cast("string"))
    n = F.row_number().over(W.partitionBy("paper").orderBy("doc_id"))
    return rows.select(F.concat(paper, F.lit("_"), n.cast("string"), F.lit(".png")).alias("filename"), paper.alias("arxiv_number"), F.col("category").alias("quantum_problem"), F.col("doc_id").cast("long").alias("doc_id"))


def _named_counts(spark, sf):
    return Q._counts(spark, sf).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("arxiv_id"), F.col("n").cast("int").alias("circuit_count"))


@query(f"WITH {DECIDED}, named AS ({RECORDS}) SELECT 'kept' AS seen, * FROM named WHERE doc_id % 2 = 0 UNION ALL SELECT 'committed' AS seen, * FROM named")
def write_dataset_json(spark, sf):
    """A first version, a second one whose write fails half way, and the second one again: what a reader
    sees after the failure and at the end."""
    path = shared_path(spark, "dataset")
    rows = _records(Q.decided(spark, sf).where("is_target"))
    O.write_dataset(rows.where("doc_id % 2 = 0"), path)
    failing = rows.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).otherwise(F.raise_error(F.lit("this row cannot be written")).cast("long")))
    try:
        O.write_dataset(failing, path)
    except PySparkException:
        kept = O.read_dataset(spark, path, RECORD)
    O.write_dataset(rows, path)
    return kept.select(F.lit("kept").alias("seen"), "*").unionByName(O.read_dataset(spark, path, RECORD).select(F.lit("committed").alias("seen"), "*"))


@query(f"WITH {CNT} {COUNTS}")
def write_counts_csv(spark, sf):
    path = shared_path(spark, "counts")
    O.write_counts(_named_counts(spark, sf), path)
    return O.read_counts(spark, path)


@query(f"WITH {DECIDED}, {CNT}, w AS ({RECORDS}), c AS ({COUNTS}) SELECT true AS saved, (SELECT count(*) FROM w) AS n_records, (SELECT count(*) FROM c) AS n_counts")
def save_all(spark, sf):
    path = shared_path(spark, "outputs")
    saved = O.save_all(_records(Q.decided(spark, sf).where("is_target")), _named_counts(spark, sf), path)
    rows = O.read_dataset(spark, path, RECORD, "/dataset").agg(F.count("*").alias("n_records"))
    return rows.crossJoin(O.read_counts(spark, path, "/counts").agg(F.count("*").alias("n_counts"))).select(F.lit(saved).alias("saved"), "n_records", "n_counts")


@query(f"WITH {DECIDED}, {CNT} SELECT 'record' AS kind, filename AS name, CAST(NULL AS INT) AS n FROM ({RECORDS}) UNION ALL SELECT 'count' AS kind, arxiv_id AS name, circuit_count AS n FROM ({COUNTS})")
def resume_outputs_load(spark, sf):
    path = shared_path(spark, "outputs")
    O.save_all(_records(Q.decided(spark, sf).where("is_target")), _named_counts(spark, sf), path)
    records = O.read_dataset(spark, path, RECORD, "/dataset").select(F.lit("record").alias("kind"), F.col("filename").alias("name"), F.lit(None).cast("int").alias("n"))
    return records.unionByName(O.read_counts(spark, path, "/counts").select(F.lit("count").alias("kind"), F.col("arxiv_id").alias("name"), F.col("circuit_count").alias("n")))


STATE_SQL = f"WITH {DECIDED} SELECT CAST(max(paper) AS INT) AS last_paper_index, 'p' || max(paper) AS last_paper_id, CAST(count(*) FILTER (WHERE is_target) AS INT) AS total_found, CAST(count(DISTINCT paper) AS INT) AS processed FROM dd"


def _saved(spark, sf):
    path = shared_path(spark, "state")
    last, found, n = Q.decided(spark, sf).agg(F.max("paper"), F.count_if("is_target"), F.count_distinct("paper")).first()
    O.save_state(spark, path, last_paper_index=last, last_paper_id=f"p{last}", total_found=found, processed=n, skipped=0, failed=0, timestamp="now", version="1.0")
    return path


@query(STATE_SQL)
def write_checkpoint(spark, sf):
    return spark.read.schema(O.STATE).json(O.state_file(spark, _saved(spark, sf))).select("last_paper_index", "last_paper_id", "total_found", "processed")


@query(STATE_SQL)
def checkpoint_load(spark, sf):
    state = O.load_state(spark, _saved(spark, sf))
    return spark.createDataFrame([tuple(state.values())], O.STATE).select("last_paper_index", "last_paper_id", "total_found", "processed")


@query("SELECT true AS before, false AS after")
def clear_checkpoint(spark, sf):
    path = _saved(spark, sf)
    before = O.load_state(spark, path) is not None
    O.clear_state(spark, path)
    return spark.range(1).select(F.lit(before).alias("before"), F.lit(O.load_state(spark, path) is not None).alias("after"))


@query(f"""WITH {CENT} SELECT c.is_target, count(*) AS n, max((SELECT count(*) FROM v)) AS total, max(len(embedding)) AS embedding_dim, round(max(centroid[1]), 6) AS first
FROM v JOIN c USING (is_target) GROUP BY c.is_target""")
def write_reference_index(spark, sf):
    path, v = shared_path(spark, "index"), made(spark, sf, VECTORS)
    O.write_reference_index(v.select("vec_id", "embedding", "is_target"), K.class_centroids(v), path)
    n = spark.read.parquet(f"{path}/vectors").groupBy("is_target").agg(F.count("*").alias("n"))
    centroids = spark.read.parquet(f"{path}/centroids").select(F.col("is_target").alias("class"), F.round(F.col("centroid")[0], 6).alias("first"))
    meta = spark.read.schema("total long, embedding_dim long").json(f"{path}/metadata")
    return n.join(F.broadcast(centroids), F.col("is_target") == F.col("class")).crossJoin(F.broadcast(meta)).select("is_target", "n", "total", "embedding_dim", "first")


@query(f"WITH {DECIDED} {RECORDS}")
def run_pipeline(spark, sf):
    """Papers in order, ten a batch, each batch detected, written and counted before the next."""

    def detect(papers):  # at most one batch of ids
        return Q.decided(spark, sf, papers).where("is_target").select(F.col("paper").alias("paper_idx"), F.col("doc_id").alias("image_index"), "paper", "doc_id", "category")

    papers = made(spark, sf, FIGURES).select(F.col("paper").alias("paper_idx")).distinct()
    return _records(incremental.run(papers, detect, shared_path(spark, "run"), batch=10))


#: figures after which the stream ends
ENOUGH = 60


@query(f"WITH {DECIDED} {RECORDS} QUALIFY row_number() OVER (ORDER BY paper, doc_id) <= {ENOUGH}")
def stream_until_enough(spark, sf):
    """Figures as a stream of files, ten papers each: stopped after the second one and started again from its checkpoint,
    until enough are found."""
    source, out, checkpoint = (shared_path(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    decided = Q.decided(spark, sf).select(F.col("paper").cast("long").alias("paper_idx"), F.col("doc_id").cast("long").alias("image_index"), "is_target", "category")
    path = shared_path(spark, "stream-all")
    decided.write.parquet(path)
    figures, schema = spark.read.parquet(path), "paper_idx long, image_index long, is_target boolean, category string"
    for part in range(4):
        figures.where(F.col("paper_idx").between(10 * part, 10 * part + 9)).coalesce(1).write.mode("append").parquet(source)
        if part in (1, 3):  # first with the files of the first two parts, then with the rest
            incremental.file_stream(spark, source, schema, lambda rows: rows.where("is_target"), out, checkpoint, most=ENOUGH).awaitTermination()
    found = spark.read.parquet(out).select(F.col("paper_idx").alias("paper"), F.col("image_index").alias("doc_id"), "category")
    return _records(found)
