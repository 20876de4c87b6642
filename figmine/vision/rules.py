"""Image rules as Column expressions over statistics of a region.

Pixel statistics come from a backend (``figmine.vision.backend``); the rules themselves stay in the JVM.
Statistics: width, height, n_contours, mean_area, tiny_count, density, x_spread, y_var, h_lines, n_lines, quads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def matrix_score(brackets: Column, grid: Column, no_lines: Column, spacing: Column) -> Column:
    return (brackets * 2.0 + grid * 1.5 + no_lines * 1.5 + spacing * 1.0) / 6.0


def is_matrix(brackets: Column, grid: Column, no_lines: Column, spacing: Column) -> Column:
    return matrix_score(brackets, grid, no_lines, spacing) > 0.4


def line_score(h_lines: Column) -> Column:
    return F.when(h_lines == 0, 1.0).when(h_lines <= 2, 0.5).otherwise(0.0)


def bracket_score(left: Column, right: Column) -> Column:
    return F.when(left & right, 1.0).when(left | right, 0.8).otherwise(0.0)


def is_text_region(s: Column) -> Column:
    n = s["n_contours"]
    return (n == 0) | ((n > 50) & (s["mean_area"] < 150)) | ((s["density"] > 0.1) & (s["density"] < 0.35) & (n > 30))


def is_math_formula(s: Column) -> Column:
    w, h, n = s["width"], s["height"], s["n_contours"]
    aspect = F.when(h > 0, w / h).otherwise(0.0)
    return (
        (h < 80) | ((aspect > 2.5) & (h < 150)) | ((aspect > 3.0) & (h < 250)) | (n == 0) | ((s["tiny_count"] > 20) & (h < 200))
        | ((n > 15) & (s["mean_area"] < 100) & (h < 300)) | ((n > 10) & (s["x_spread"] > w * 0.7) & (h < 250)) | ((n > 8) & (aspect > 2.0) & (s["y_var"] < 100))
    )


def has_circuit_structure(s: Column) -> Column:
    lines, quads = s["h_lines"], s["quads"]
    return ((lines >= 2) & (quads >= 1)) | (lines >= 3) | ((quads >= 4) & (lines >= 1))


def has_structured_content(s: Column) -> Column:
    return (s["n_lines"] > 5) | (s["quads"] > 3)


def keep_region(s: Column) -> Column:
    """A region of a rendered page stays: not text, a circuit or no formula, and structured."""
    return ~is_text_region(s) & (has_circuit_structure(s) | ~is_math_formula(s)) & has_structured_content(s)


def luma(r: Column, g: Column, b: Column) -> Column:
    """Gray value of a colour, with the 16-bit weights of the backend."""
    return F.shiftright(r * 19595 + g * 38470 + b * 7471 + 0x8000, 16)


def gap_variance(places: Column) -> Column:
    """Population variance of the gaps between sorted places; null below two places."""
    s = F.array_sort(places)
    gaps = F.zip_with(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), lambda b, a: (b - a).cast("double"))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)
    mean = total(gaps) / F.size(gaps)
    return F.when(F.size(s) >= 2, F.round(total(F.transform(gaps, lambda x: (x - mean) * (x - mean))) / F.size(gaps), 6))


def grid_score(tops: Column) -> Column:
    """Elements in regular rows: ``tops`` are the upper edges of all elements."""
    v = gap_variance(F.array_distinct(tops))
    return F.when((F.size(tops) < 4) | v.isNull(), 0.0).when(v < 100, 1.0).when(v < 300, 0.5).otherwise(0.0)


def spacing_score(xs: Column, ys: Column) -> Column:
    """Element centres at regular distances along both axes, or along one."""
    a, b = gap_variance(xs), gap_variance(ys)
    return F.when(F.size(xs) < 4, 0.0).when((a < 500) & (b < 500), 1.0).when((a < 1000) | (b < 1000), 0.5).otherwise(0.0)


def matrix(s: Column) -> Column:
    """The matrix rule from the statistics of an image: brackets, rows, lines and spacing together."""
    return is_matrix(bracket_score(s["left"], s["right"]), grid_score(s["tops"]), line_score(s["h_lines"]), spacing_score(s["xs"], s["ys"]))


def embedded_image(s: Column, matrix: Column, min_w: int = 200, min_h: int = 150) -> Column:
    """An embedded image stays: large enough, shape 0.2 to 5, not portrait, no matrix."""
    w, h = s["width"], s["height"]
    return (w >= min_w) & (h >= min_h) & (w / h).between(0.2, 5.0) & (h <= w) & ~matrix


def rendered_region(s: Column, matrix: Column) -> Column:
    """A region cut from a rendered page stays: at least 150 by 100 pixels and no matrix."""
    return keep_region(s) & (s["width"] >= 150) & (s["height"] >= 100) & ~matrix
