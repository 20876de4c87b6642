"""Topics of texts: phrases first, similarity with reference texts where no phrase is found.

Phrase lists are a parameter of any length, found through an inverted index in the JVM.  A phrase counts wherever the
normalised text contains it, also inside words.  The first phrases of a list are tried on every text; texts
without any of them meet the others through the index.  A phrase with a space is looked up by what stands around one: the
pieces around the spaces of a text meet the phrases where the text is, and what leaves a task is at most one rank a
text.  A phrase without one lies within a word: the distinct words meet those phrases by grams of three characters."""

from __future__ import annotations

import json
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from figmine import vocab
from figmine.functions import text as T
from figmine.operators import classify as K
from figmine.operators.encoders import bucket_vectors, encode
from figmine.sinks.shared import shared_path

#: characters of a gram of the index, on each side of a space
GRAM = 3
#: characters of a piece on each side of a space, and the piece itself, one a space: of words shorter than that all
SIDE = 16
PIECE = r"(?=((?:(?<![^ ])[^ ]{%d,%d}|[^ ]{%d}) [^ ]{%d,%d}))"
#: phrases tried on every text before the index, and phrases tried together
HEAD, BLOCK = 512, 32
#: phrases of one broadcast; a longer list goes over the texts several times
AT_ONCE = 200_000


def read_topics(spark: SparkSession, path: str) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Topics in order of precedence from a JSON object of lists of phrases, ``{"topic": ["phrase", ...]}``,
    in any store that Spark reads."""
    raw = spark.read.text(path, wholetext=True).first()
    found = json.loads(raw[0]) if raw else {}
    if not isinstance(found, dict) or not all(isinstance(v, list) and all(isinstance(p, str) for p in v) for v in found.values()):
        raise ValueError(f"{path}: topics are an object of lists of phrases")
    return tuple((topic, tuple(p.lower() for p in phrases)) for topic, phrases in found.items())


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of the driver as a relation in the JVM, without a task of Python."""
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return spark.createDataFrame(pa.table({name: pa.array([r[i] for r in rows], types[kind]) for i, (name, kind) in enumerate(fields)}))


def phrase_table(spark: SparkSession, topics=vocab.TOPIC_PHRASES) -> DataFrame:
    """``ord, category, phrase`` in order of precedence."""
    rows = [(i, c, p) for i, (c, p) in enumerate((topic, p) for topic, phrases in topics for p in phrases)]
    return local_table(spark, rows, "ord long, category string, phrase string")


def _once(phrases: DataFrame) -> DataFrame:
    """``ord, category, phrase``: every distinct phrase that has a word once, at its first place."""
    known = phrases.where(F.replace("phrase", F.lit(" "), F.lit("")) != "")
    return known.groupBy("phrase").agg(F.min(F.struct("ord", "category")).alias("first")).select("first.*", "phrase")


def _first_of(text: Column, rows: list) -> Column:
    """The first of some phrases, in order, that a text contains, as ``category, phrase``; after a block that has one no other is tried."""
    one = lambda r: F.struct(F.lit(r["category"]).cast("string").alias("category"), F.lit(r["phrase"]).alias("phrase"))
    blocks = [F.array(*map(one, rows[i : i + BLOCK])) for i in range(0, len(rows), BLOCK)]
    none = F.lit(None).cast("struct<category: string, phrase: string>")
    return F.coalesce(*(F.get(F.filter(b, lambda p: F.contains(text, p["phrase"])), F.lit(0)) for b in blocks), none)


def _spaced(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """``id, rank`` of phrases that have a space.  Each is known by its longest piece around a space; the distinct pieces
    of a text meet the phrases by up to three characters a side, as long as the phrases have them, without a shuffle of pieces."""
    pieces = F.regexp_extract_all("phrase", F.lit(PIECE % (0, SIDE - 1, SIDE, 0, SIDE)), F.lit(1))
    piece = F.array_max(F.transform(pieces, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    left, right = (F.substring_index("piece", " ", i) for i in (1, -1))
    known = phrases.withColumn("piece", piece).withColumn("gram", F.concat(F.right(left, F.lit(GRAM)), F.lit(" "), F.left(right, F.lit(GRAM))))
    known = _written(known.select("gram", "piece", "phrase", "rank"), "grams")
    kinds = known.groupBy((F.instr("gram", " ") - 1).alias("l"), (F.length("gram") - F.instr("gram", " ")).alias("r")).agg(F.count("*").alias("n"), F.max(F.col("piece") != F.col("phrase")).alias("longer")).collect()  # 15 at most
    if not kinds:
        return texts.select("id", F.lit(None).cast("decimal(32, 0)").alias("rank")).limit(0)
    pieces = F.array_distinct(F.regexp_extract_all("t", F.lit(PIECE % (1, SIDE - 1, SIDE, 1, SIDE)), F.lit(1)))
    met = texts.select("id", "t", pieces.alias("pieces")).select("id", "t", F.explode("pieces").alias("of"))
    left, right = (F.substring_index("of", " ", i) for i in (1, -1))
    grams = F.array_distinct(F.array(*(F.concat(F.right(left, F.lit(k["l"])), F.lit(" "), F.left(right, F.lit(k["r"]))) for k in kinds)))
    met = met.select("id", "t", "of", F.explode(grams).alias("gram"))
    blocks = -(-sum(k["n"] for k in kinds) // AT_ONCE)
    parts = [met.join(F.broadcast(known.where(F.expr(f"pmod(xxhash64(phrase), {blocks}) = {b}"))), "gram") for b in range(blocks)]
    hit = F.contains("of", "piece")
    if any(k["longer"] for k in kinds):
        hit = hit & ((F.col("piece") == F.col("phrase")) | F.contains("t", "phrase"))
    return reduce(DataFrame.unionByName, (p.where(hit).select("id", "rank") for p in parts))


def _unspaced(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """``id, rank`` of the first phrase without a space that a word of the text contains: distinct words meet the phrases by
    their first three characters, or by all of a shorter one."""
    sizes = [r[0] for r in phrases.select(F.least(F.length("phrase"), F.lit(GRAM))).distinct().collect()]  # three at most
    if not sizes:
        return texts.select("id", F.lit(None).cast("decimal(32, 0)").alias("rank")).limit(0)
    words = texts.select("id", F.explode(F.array_distinct(F.filter(F.split("t", " "), lambda w: w != ""))).alias("word"))
    grams_of = lambda n: F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substring(F.col("word"), i, F.lit(n)))
    split = words.select("word").distinct().select("word", F.explode(F.array_distinct(F.flatten(F.array(*map(grams_of, sizes))))).alias("gram"))
    met = split.join(phrases.withColumn("head", F.left("phrase", F.lit(GRAM))), F.col("gram") == F.col("head")).where(F.contains("word", "phrase"))
    met = met.groupBy(F.col("word").alias("of")).agg(F.min("rank").alias("rank"))
    return words.join(met, F.col("word") == F.col("of")).select("id", "rank")


def first_phrases(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """``of, first``: for each text (``id, t``: normalised) with any of the phrases (``ord, category, phrase``, distinct) the first one."""
    tie = F.row_number().over(W.partitionBy("ord").orderBy("category", "phrase"))
    listed = _written(phrases.select((F.col("ord").cast("decimal(20, 0)") * 1000000000 + tie).alias("rank"), "category", "phrase"), "phrases")
    spaced = F.contains("phrase", F.lit(" "))
    found = _spaced(texts, listed.where(spaced)).unionByName(_unspaced(texts, listed.where(~spaced)))
    first = found.groupBy(F.col("id").alias("of")).agg(F.min("rank").alias("rank"))
    return first.join(listed, "rank").select("of", F.struct("category", "phrase").alias("first"))


def match_phrases(df: DataFrame, text: str, topics=vocab.TOPIC_PHRASES, key: str | None = None) -> DataFrame:
    """``df`` with ``category`` and ``phrase``: the first phrase, by order of the lists, that the normalised
    text contains; 'Unknown' and null without one.  ``topics`` are lists by topic, or a table like ``phrase_table``;
    ``key`` names a column of distinct values that are not null (without one, rows are written once with a number)."""
    spark, rows = df.sparkSession, df.drop("category", "phrase")
    phrases = _once(topics if isinstance(topics, DataFrame) else phrase_table(spark, topics))
    head = phrases.orderBy("ord", "category", "phrase").limit(HEAD + 1).collect()
    number = F.monotonically_increasing_id() if key is None else F.col(key)
    base = rows.select(F.struct(*rows.columns).alias("row"), T.normalize_text(F.col(text)).alias("t"), number.alias("id"))
    here = _first_of(F.col("t"), head[:HEAD]).alias("first")
    if len(head) <= HEAD:
        out = base.select("row", here)
    else:
        if key is None:  # the number must stay the same when a lost task is run again
            base = _written(base, "texts")
        tried = _written(base.select("id", "t", here).select("id", "first", F.when(F.col("first").isNull(), F.col("t")).alias("t")), "tried")
        rest = first_phrases(tried.where("first is null").select("id", "t"), phrases)
        found = tried.where("first is not null").select(F.col("id").alias("of"), "first").unionByName(rest)
        out = base.select("row", "id").join(found, F.col("id") == F.col("of"), "left")
    return out.select("row.*", F.coalesce("first.category", F.lit("Unknown")).alias("category"), F.col("first.phrase").alias("phrase"))


def _vectors(df: DataFrame, key: str, text: str, make, out: str) -> DataFrame:
    """``key`` and the vector of each text: hashed word counts in the JVM, or what an encoder makes."""
    return bucket_vectors(df, key, text, out) if make is None else encode(df, text, make, out).select(key, out)


def reference_vectors(spark: SparkSession, topics=vocab.TOPIC_PHRASES, make=None) -> DataFrame:
    """``ord, category, ref``: the vector of each topic's reference text, here its phrases."""
    texts = local_table(spark, [(i, c, " ".join(ps)) for i, (c, ps) in enumerate(topics)], "ord int, category string, text string")
    return texts.select("ord", "category").join(_vectors(texts, "ord", "text", make, "ref"), "ord")


def classify(df: DataFrame, key: str, text: str, topics=vocab.TOPIC_PHRASES, make=None) -> DataFrame:
    """``key, category, confidence, score, method`` of each text, in two stages: a phrase decides with score 1;
    only texts without one are encoded and compared with the reference texts.  Empty texts are Unknown.  Keys are
    distinct and not null."""
    rows = match_phrases(df.select(F.col(key).alias("vec_id"), F.coalesce(T.strip(F.col(text)), F.lit("")).alias("body")), "body", topics, "vec_id")
    first = F.when(F.col("body") == "", "no_text").when(F.col("phrase").isNotNull(), "explicit_match")
    rows = _written(rows.withColumn("method", first), "matched")
    done = rows.where("method is not null").select("vec_id", "category", F.when(F.col("method") == "no_text", "LOW").otherwise("HIGH").alias("confidence"), F.when(F.col("method") == "no_text", 0.0).otherwise(1.0).alias("score"), "method")
    left = _vectors(rows.where("method is null").select("vec_id", "body"), "vec_id", "body", make, "embedding")
    second = K.topic_similarity(left, reference_vectors(df.sparkSession, topics, make)).select("vec_id", "category", "confidence", "score", F.lit("embedding_similarity").alias("method"))
    return done.unionByName(second).withColumnRenamed("vec_id", key)


def cascade(df: DataFrame, key: str, steps: list[str], topics=vocab.TOPIC_PHRASES, make=None) -> DataFrame:
    """``key, category, confidence, score, method, step``: both stages on the first text, then, for keys that
    are still Unknown, on each further text that adds something; the last answer stands.  Texts stay in their table: a step
    reads one column of the keys that it decides, and only answers are written and joined."""
    names = ["category", "confidence", "score", "method", "step"]
    now = _written(classify(df, key, steps[0], topics, make).withColumn("step", F.lit(1)), "topics")
    unknown, parts = F.col("category") == "Unknown", []
    for i in range(1, len(steps)):
        parts.append(now.where(~unknown))
        open_ = now.where(unknown).withColumnRenamed(key, "open_key")
        fresh = df.where(~F.col(steps[i]).eqNullSafe(F.col(steps[i - 1]))).select(key, F.col(steps[i]).alias("body"))
        asked = _written(fresh.join(open_.select("open_key"), F.col(key) == F.col("open_key"), "left_semi"), "asked")
        same = open_.join(asked.select(F.col(key).alias("asked_key")), F.col("open_key") == F.col("asked_key"), "left_anti").withColumnRenamed("open_key", key)
        now = _written(same.select(key, *names).unionByName(classify(asked, key, "body", topics, make).withColumn("step", F.lit(i + 1)).select(key, *names)), "topics")
    out = now.select(key, *names)
    for p in parts:
        out = out.unionByName(p.select(key, *names))
    return out
