"""Joins of figures with the text around them: equal keys (document, page) with spatial conditions, and
windows for nearest, first-passing and longest choices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from figmine.functions import text as T

FIGURE = ["doc_id", "page", "fig_no"]
MATH = r"[θφπ∑∏∫=+\-×÷√|⟩⟨]"


def on_page(figures: DataFrame, blocks: DataFrame, condition) -> DataFrame:
    b = blocks.withColumnsRenamed({"doc_id": "b_doc", "page": "b_page"})
    return figures.join(b, (figures["doc_id"] == b["b_doc"]) & (figures["page"] == b["b_page"]) & condition).drop("b_doc", "b_page")


def first_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def running_offsets(blocks: DataFrame, keys: list[str], order: str, text: str = "text") -> DataFrame:
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return blocks.withColumn("char_start", F.coalesce(F.sum(F.length(text) + 1).over(before), F.lit(0)).cast("long"))


def caption_join(figures: DataFrame, blocks: DataFrame, radius: float = 200.0, overlap: float = 0.3) -> DataFrame:
    """Nearest caption block below each figure: x-overlap of at least a share of its width."""
    c = F.col
    across = F.greatest(F.lit(0.0), F.least("x1", "fx1") - F.greatest("x0", "fx0"))
    close = (c("y0") >= c("fy1")) & (c("y0") - c("fy1") <= radius) & (across >= (c("fx1") - c("fx0")) * overlap)
    near = on_page(figures, blocks.where(c("text").rlike(T.FIGURE_START)), close)
    near = near.withColumn("caption", T.clean_caption(c("text"))).where(~T.is_matrix_text(c("caption"))).withColumn("gap", c("y0") - c("fy1"))
    return first_by(near, FIGURE, "gap", "block_no").select(*FIGURE, "block_no", "caption", "gap")


EQUATION = r"(?iU)^\s*(?:\((\d+(?:\.\d+)?)\)|Eq\.\s*\((\d+(?:\.\d+)?)\)|Equation\s*\((\d+(?:\.\d+)?)\)|\[(\d+(?:\.\d+)?)\])\s*$"


def equation_join(figures: DataFrame, blocks: DataFrame) -> DataFrame:
    """Nearest equation number at the right, left or below each figure."""
    c, far = F.col, F.lit(999.0)
    right, left, below = c("x0") >= c("fx1") - 30, c("x1") <= c("fx0") + 30, c("y0") >= c("fy1") - 30
    dr, dl, db = F.abs(c("x0") - c("fx1")), F.abs(c("fx0") - c("x1")), F.abs(c("y0") - c("fy1"))
    beside = ((right & (dr < 150)) | (left & (dl < 150))) & ((c("y0") + c("y1")) / 2 >= c("fy0") + (c("fy1") - c("fy0")) * 0.25)
    under = below & (db < 100) & (c("x0") >= c("fx0") - 50) & (c("x0") <= c("fx1") + 50)
    numbers = blocks.where(c("text").rlike(EQUATION)).withColumn("equation", F.concat(*(F.regexp_extract("text", EQUATION, i) for i in (1, 2, 3, 4))))
    near = on_page(figures, numbers, beside | under).withColumn("gap", F.least(F.when(right, dr).otherwise(far), F.when(left, dl).otherwise(far), F.when(below, db).otherwise(far)))
    return first_by(near, FIGURE, "gap", "block_no").select(*FIGURE, "block_no", "equation", "gap")


def nearest_blocks(figures: DataFrame, blocks: DataFrame, radius: float = 400.0, k: int = 15) -> DataFrame:
    """The k blocks nearest by centre distance, with their rank."""
    c = F.col
    dx, dy = (c("x0") + c("x1")) / 2 - (c("fx0") + c("fx1")) / 2, (c("y0") + c("y1")) / 2 - (c("fy0") + c("fy1")) / 2
    far = F.sqrt(dx * dx + dy * dy)
    near = on_page(figures, blocks, far <= radius).withColumn("gap", far)
    return near.withColumn("rank", F.row_number().over(W.partitionBy(*FIGURE).orderBy("gap", "block_no"))).where(F.col("rank") <= k)


def surrounding_join(figures: DataFrame, blocks: DataFrame, captions: DataFrame) -> DataFrame:
    """The longest acceptable block near a figure; a laxer tier counts only where no stricter one has any."""
    own = captions.select(*FIGURE, F.col("block_no").alias("caption_no"), "caption")
    text, c = F.col("text"), F.col
    # the caption leaves before the nearest are ranked
    named = figures.join(own, FIGURE, "left")
    other = ~F.coalesce((text == c("caption")) | (c("block_no") == c("caption_no")), F.lit(False))
    dx, dy = (c("x0") + c("x1")) / 2 - (c("fx0") + c("fx1")) / 2, (c("y0") + c("y1")) / 2 - (c("fy0") + c("fy1")) / 2
    far = F.sqrt(dx * dx + dy * dy)
    # how strict a tier a text passes depends on the text alone: judged once a block, not once a figure
    math, size = F.regexp_count(text, F.lit(MATH)), F.length(text)
    plain = ~T.is_matrix_text(text)
    level = (F.when((size >= 30) & (F.regexp_count(text, F.lit(T.WORD3)) >= 3) & (math <= size * 0.3) & plain, 1)
             .when((size >= 20) & (F.regexp_count(text, F.lit(r"\b[a-zA-Z]{2,}\b")) >= 1) & (math <= size * 0.5) & plain, 2)
             .when((size >= 15) & plain, 3))
    near = on_page(named, blocks.withColumn("level", level), (far <= 400.0) & other).withColumn("rank", F.row_number().over(W.partitionBy(*FIGURE).orderBy(far, "block_no")))
    tier = F.when((c("rank") <= 15) & (c("level") <= 2) | (c("rank") <= 10), c("level"))
    ranked = near.withColumn("tier", tier).where("tier is not null").withColumn("best", F.min("tier").over(W.partitionBy(*FIGURE))).where("tier = best")
    ranked = ranked.withColumn("place", F.row_number().over(W.partitionBy(*FIGURE).orderBy("rank"))).where(c("place") <= F.element_at(F.array(F.lit(5), F.lit(3), F.lit(2)), c("tier")))
    best = first_by(ranked, FIGURE, F.desc(size), "rank")
    return best.select(*FIGURE, "block_no", "tier", T.truncate_sentence(text, 600, 100).alias("surrounding"))


MENTION = rf"(?i)\bfig(?:\.[{T.BLANK}]*|[{T.BLANK}]+|ure[{T.BLANK}]*)(\d+)\b"


def figure_reference_join(figures: DataFrame, blocks: DataFrame) -> DataFrame:
    """The longest block of the document that mentions the figure's number; a hash join on the number."""
    text = F.col("text")
    mentions = blocks.withColumn("number", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(MENTION), F.lit(1))))).where((F.length("text") >= 30) & (F.regexp_count(text, F.lit(T.WORD3)) >= 5))
    m = mentions.select(F.col("doc_id").alias("m_doc"), F.col("number").try_cast("int").alias("number"), "block_no", "text", "char_start")
    keyed = figures.select("doc_id", F.col("number").alias("want")).distinct()
    joined = keyed.join(m, (keyed["doc_id"] == m["m_doc"]) & (keyed["want"] == m["number"]))
    best = first_by(joined, ["doc_id", "want"], F.desc(F.length("text")), "block_no")
    return best.select("doc_id", F.col("want").alias("number"), "block_no", "char_start", T.truncate_sentence(text, 800, 200, 200).alias("reference"))
