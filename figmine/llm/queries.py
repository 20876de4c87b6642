"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figmine.llm import alignment, decontaminate, hard_negatives, jaccard, langid, line_dedup, media, mixing, near_vectors, quality, substring, toxicity, url_filter
from figmine.llm.common import documents, stored

LISTED_FROM = "2024-01-01"
#: hosts that the list of op7_url_filter names outright
NAMED_HOSTS = ("spam-farm.example.org", "cheap-pills.example.com")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_report(documents(spark, sf_dir))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup_report(documents(spark, sf_dir))


def dated_list(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of ``pages``, by rule: the first 16 bits of a pattern's md5 say
    whether and when it is added, removed and added again."""
    host = url_filter.host_of(F.col("url"))
    seen = pages.select(host.alias("host"), F.try_element_at(F.filter(F.split(url_filter.path_of(F.col("url")), "/"), lambda x: x != ""), F.lit(1)).alias("step")).where("host <> ''").distinct()
    day = lambda shift: F.expr(f"date_add(date'{LISTED_FROM}', cast({shift} as int))")

    def rows(patterns: DataFrame, kind: str, action: str, every: int, shift: str) -> DataFrame:
        v = patterns.distinct().withColumn("v", F.conv(F.substring(F.md5(F.col("pattern")), 1, 4), 16, 10).cast("int"))
        return v.where(F.col("v") % every == 0).select(F.lit(kind).alias("kind"), "pattern", F.lit(action).alias("action"), day(shift).alias("dated"))

    hosts = seen.select(F.col("host").alias("pattern"))
    paths = seen.where("step is not null").select(F.concat_ws("/", "host", "step").alias("pattern"))
    parents = seen.where(F.size(F.split("host", r"\.")) > 3).select(F.substring_index("host", ".", -3).alias("pattern"))
    named = pages.sparkSession.createDataFrame([("domain", h, "add") for h in NAMED_HOSTS], "kind string, pattern string, action string").withColumn("dated", day("-30"))
    parts = [
        rows(hosts, "domain", "add", 5, "v % 300"), rows(hosts, "domain", "remove", 10, "v % 300 + 45"), rows(hosts, "domain", "add", 20, "v % 300 + 120"),
        rows(paths, "path", "add", 7, "v % 200"), rows(paths, "path", "remove", 14, "v % 200 + 80"), rows(parents, "domain", "add", 11, "v % 250"),
    ]
    out = named
    for p in parts:
        out = out.unionByName(p)
    return out


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr(f"date_add(date'{LISTED_FROM}', cast(page_id % 365 as int))"))
    return url_filter.url_filter(captures, stored(dated_list(pages), "list"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_report(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


#: where vec_id is divisible by 7, the label that op11_hard_negatives sees is the next one
NEXT_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.expr("vec_id % 100 = 0"), label=F.expr(NEXT_LABEL))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


#: where the vocabulary files of the two tokenizers lie; the driver reads them and ships their bytes
TOKENIZERS = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(documents(spark, sf_dir), alignment.Pair.of(*TOKENIZERS))


QUERIES = {f.__name__: f for f in (op1_quality, op2_decontaminate, op3_line_dedup, op4_mix_sources, op5_ngram_jaccard, op6_substring_dedup, op7_url_filter, op8_media, op9_language_id, op10_toxicity, op11_hard_negatives, op12_near_vectors, op13_token_alignment)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"'[^\x20\x09-\x0D]+'"

ORACLE_SQL = {
    "op2_decontaminate": rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS k, w[i : i + least(10, len(w)) - 1] AS win FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, w[i : i + k - 1] AS win FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT DISTINCT doc_id, dw.k, i, item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op3_line_dedup": f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM s),
k AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM l),
dup AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, dup.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN dup ON k.key = dup.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op5_ngram_jaccard": f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, {_WORD}), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, array_to_string(w[i : i + least(3, len(w)) - 1], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM w WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, coalesce(min(reach.y), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach ON reach.x = w.doc_id GROUP BY w.doc_id""",
    "op6_substring_dedup": f"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, {_WORD}), []) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
low AS (SELECT t, min(doc_id) AS m FROM win GROUP BY t HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (t) WHERE doc_id > m)),
every AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
kept AS (SELECT every.doc_id, count(*) FILTER (WHERE gone.p IS NOT NULL) AS r, string_agg(word, ' ' ORDER BY every.p) FILTER (WHERE gone.p IS NULL) AS t
  FROM every LEFT JOIN gone ON gone.doc_id = every.doc_id AND gone.p = every.p GROUP BY every.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(r, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op7_url_filter": f"""
WITH pg AS (SELECT page_id, url, DATE '{LISTED_FROM}' + CAST(page_id % 365 AS INT) AS fetched_at,
    lower(coalesce(regexp_extract(url, '{url_filter.HOST}', 1), '')) AS host,
    list_filter(string_split(regexp_extract(url, '{url_filter.PATH}', 1), '/'), lambda x: x <> '') AS steps FROM pages),
seen AS (SELECT DISTINCT host, steps[1] AS step FROM pg WHERE host <> ''),
hosts AS (SELECT DISTINCT host AS pattern FROM seen),
paths AS (SELECT DISTINCT host || '/' || step AS pattern FROM seen WHERE step IS NOT NULL),
parents AS (SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') AS pattern FROM seen WHERE len(string_split(host, '.')) > 3),
h AS (SELECT pattern, CAST('0x' || substr(md5(pattern), 1, 4) AS INT) AS v FROM hosts),
p AS (SELECT pattern, CAST('0x' || substr(md5(pattern), 1, 4) AS INT) AS v FROM paths),
q AS (SELECT pattern, CAST('0x' || substr(md5(pattern), 1, 4) AS INT) AS v FROM parents),
entries AS (
  SELECT 'd:' || unnest([{", ".join(f"'{x}'" for x in NAMED_HOSTS)}]) AS k, 'add' AS action, DATE '{LISTED_FROM}' - 30 AS dated
  UNION ALL SELECT 'd:' || pattern, 'add', DATE '{LISTED_FROM}' + v % 300 FROM h WHERE v % 5 = 0
  UNION ALL SELECT 'd:' || pattern, 'remove', DATE '{LISTED_FROM}' + v % 300 + 45 FROM h WHERE v % 10 = 0
  UNION ALL SELECT 'd:' || pattern, 'add', DATE '{LISTED_FROM}' + v % 300 + 120 FROM h WHERE v % 20 = 0
  UNION ALL SELECT 'p:' || pattern, 'add', DATE '{LISTED_FROM}' + v % 200 FROM p WHERE v % 7 = 0
  UNION ALL SELECT 'p:' || pattern, 'remove', DATE '{LISTED_FROM}' + v % 200 + 80 FROM p WHERE v % 14 = 0
  UNION ALL SELECT 'd:' || pattern, 'add', DATE '{LISTED_FROM}' + v % 250 FROM q WHERE v % 11 = 0),
daily AS (SELECT lower(k) AS k, dated, max(action) AS action FROM entries GROUP BY 1, 2),
spans AS (SELECT * FROM (SELECT k, action, dated AS valid_from, lead(dated) OVER (PARTITION BY k ORDER BY dated) AS valid_to FROM daily) WHERE action = 'add'),
keys AS (SELECT DISTINCT page_id, url, fetched_at, key FROM (
  SELECT page_id, url, fetched_at, 'd:' || array_to_string(list_slice(parts, i, len(parts)), '.') AS key FROM (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS parts, unnest(range(1, len(list_filter(string_split(host, '.'), lambda x: x <> '')) + 1)) AS i FROM pg WHERE host <> '')
  UNION ALL SELECT page_id, url, fetched_at, 'p:' || host || '/' || array_to_string(list_slice(steps, 1, i), '/') FROM (SELECT *, unnest(range(1, len(steps) + 1)) AS i FROM pg WHERE host <> ''))),
hit AS (SELECT page_id, url, fetched_at, k, valid_from FROM keys JOIN spans ON key = k AND fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, url, fetched_at ORDER BY valid_from DESC, length(k) DESC, k DESC) AS r FROM hit) WHERE r = 1)
SELECT DISTINCT pg.page_id, host, CAST(pg.fetched_at AS DATE) AS fetched_at, best.k IS NOT NULL AS blocked, best.k AS matched, CAST(best.valid_from AS DATE) AS listed_at
FROM pg LEFT JOIN best ON best.page_id = pg.page_id AND best.url IS NOT DISTINCT FROM pg.url""",
    "op11_hard_negatives": f"""
WITH e AS (SELECT vec_id, {NEXT_LABEL} AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 5""",
    "op12_near_vectors": f"""
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {near_vectors.THRESHOLD}),
reach AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x),
low AS (SELECT x, min(y) AS m FROM reach GROUP BY x), n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(low.m, vec_id)) AS component_id, vec_id <= coalesce(low.m, vec_id) AS kept
FROM embeddings LEFT JOIN low ON low.x = vec_id LEFT JOIN n ON n.x = vec_id""",
}
