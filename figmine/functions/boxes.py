"""Box geometry: Column expressions for pairs, numpy for the greedy steps within one page."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection over union of boxes given as columns x0, y0, x1, y1."""
    w = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    area = lambda c: (c["x1"] - c["x0"]) * (c["y1"] - c["y0"])
    union = area(a) + area(b) - w * h
    return F.when((w * h > 0) & (union > 0), w * h / union).otherwise(0.0)


def px_to_pt(x: Column, dpi: float = 300.0) -> Column:
    return x * 72.0 / dpi


def suppress(boxes: np.ndarray, limit: float = 0.4) -> np.ndarray:
    """Greedy suppression, largest first (stable): mask of boxes kept.  A row of NaN is a figure without
    a box; its size stands in columns 4 and 5."""
    size = np.where(np.isnan(boxes[:, 0]), boxes[:, 4] * boxes[:, 5], (boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1])) if boxes.shape[1] == 4 else boxes[:, 4] * boxes[:, 5]
    keep = np.zeros(len(boxes), bool)
    kept: list[int] = []
    for i in np.argsort(-size, kind="stable"):
        b = boxes[i]
        if kept:
            k = boxes[kept]
            if np.isnan(b[0]):
                near = np.isnan(k[:, 0]) & (abs(k[:, 4:6] - b[4:6]) < 10).all(axis=1)
            else:
                w = np.clip(np.minimum(k[:, 2], b[2]) - np.maximum(k[:, 0], b[0]), 0, None)
                h = np.clip(np.minimum(k[:, 3], b[3]) - np.maximum(k[:, 1], b[1]), 0, None)
                both = np.nan_to_num(w * h)
                union = (b[2] - b[0]) * (b[3] - b[1]) + (k[:, 2] - k[:, 0]) * (k[:, 3] - k[:, 1]) - both
                near = (both > 0) & (both > limit * union)
            if near.any():
                continue
        keep[i] = True
        kept.append(int(i))
    return keep


def merge_near(boxes: np.ndarray, gap: float) -> np.ndarray:
    """Grow each box in turn by all later unused ones within the gap on both axes, until nothing changes."""
    current = boxes.astype(float)
    while True:
        left, out = list(range(len(current))), []
        grown = False
        while left:
            box = current[left.pop(0)].copy()
            for j in list(left):
                b = current[j]
                if max(box[0], b[0]) - min(box[2], b[2]) <= gap and max(box[1], b[1]) - min(box[3], b[3]) <= gap:
                    box = np.array([*np.minimum(box[:2], b[:2]), *np.maximum(box[2:], b[2:])])
                    left.remove(j)
                    grown = True
            out.append(box)
        current = np.array(out).reshape(-1, 4)
        if not grown:
            return current


def drop_overlapped(boxes: np.ndarray, share: float = 0.5) -> np.ndarray:
    """Boxes x, y, w, h: largest first, drop those overlapped by more than a share of their own area."""
    corner, size = boxes[:, :2].astype(float), boxes[:, 2:4].astype(float)
    keep, kept = np.zeros(len(boxes), bool), []
    for i in np.argsort(-(size[:, 0] * size[:, 1]), kind="stable"):
        both = np.clip(np.minimum(corner[i] + size[i], corner[kept] + size[kept]) - np.maximum(corner[i], corner[kept]), 0, None)
        if not (both[:, 0] * both[:, 1] > share * size[i, 0] * size[i, 1]).any():
            keep[i] = True
            kept.append(int(i))
    return keep
