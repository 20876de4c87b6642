"""Queries over image rules: region statistics derived from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from figmine.plans.fixtures import in_sql, made
from figmine.plans.registry import query
from figmine.vision import rules as R

STATS = """SELECT event_id, CAST(event_id % 700 + 1 AS INT) AS width, CAST(event_id * 7 % 400 + 1 AS INT) AS height, CAST(event_id % 60 AS INT) AS n_contours,
  CAST(event_id % 331 AS DOUBLE) AS mean_area, CAST(event_id % 29 AS INT) AS tiny_count, CAST(event_id % 50 AS DOUBLE) / 100 AS density, CAST(event_id * 3 % 700 AS DOUBLE) AS x_spread,
  CAST(event_id % 300 AS DOUBLE) AS y_var, CAST(event_id % 5 AS INT) AS h_lines, CAST(event_id % 9 AS INT) AS n_lines, CAST(event_id % 6 AS INT) AS quads FROM {events}"""
S = in_sql(STATS)
ASPECT = "CAST(width AS DOUBLE) / height"
TEXT = "(n_contours = 0 OR (n_contours > 50 AND mean_area < 150) OR (density > 0.1E0 AND density < 0.35E0 AND n_contours > 30))"
MATH = (f"(height < 80 OR ({ASPECT} > 2.5 AND height < 150) OR ({ASPECT} > 3.0 AND height < 250) OR n_contours = 0 OR (tiny_count > 20 AND height < 200) OR (n_contours > 15 AND mean_area < 100 AND height < 300)"
        f" OR (n_contours > 10 AND x_spread > width * 0.7E0 AND height < 250) OR (n_contours > 8 AND {ASPECT} > 2.0 AND y_var < 100))")  # fmt: skip
CIRCUIT = "((h_lines >= 2 AND quads >= 1) OR h_lines >= 3 OR (quads >= 4 AND h_lines >= 1))"
STRUCTURED = "(n_lines > 5 OR quads > 3)"
SCORES = "CASE WHEN h_lines = 0 THEN 1.0E0 WHEN h_lines <= 2 THEN 0.5E0 ELSE 0.0E0 END"

for _name, _rule, _sql in (
    ("is_text_region", R.is_text_region, TEXT),
    ("is_math_formula", R.is_math_formula, MATH),
    ("has_circuit_structure", R.has_circuit_structure, CIRCUIT),
    ("has_structured_content", R.has_structured_content, STRUCTURED),
    ("figure_regions_strict", R.keep_region, f"(NOT {TEXT} AND ({CIRCUIT} OR NOT {MATH}) AND {STRUCTURED})"),
):

    def _run(spark, sf, rule=_rule):
        s = made(spark, sf, STATS)
        return s.select("event_id", rule(F.struct(*s.columns)).alias("answer"))

    query(f"SELECT event_id, {_sql} AS answer FROM ({S})", _name)(_run)


@query(f"SELECT event_id, {SCORES} AS score FROM ({S})")
def no_horizontal_lines(spark, sf):
    return made(spark, sf, STATS).select("event_id", R.line_score(F.col("h_lines")).alias("score"))


@query(f"SELECT event_id, CASE WHEN quads >= 3 AND n_lines >= 4 THEN 1.0E0 WHEN quads >= 3 OR n_lines >= 4 THEN 0.8E0 ELSE 0.0E0 END AS score FROM ({S})")
def detect_brackets(spark, sf):
    return made(spark, sf, STATS).select("event_id", R.bracket_score(F.col("quads") >= 3, F.col("n_lines") >= 4).alias("score"))


