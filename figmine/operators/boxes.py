"""Greedy box steps page by page: order-dependent, so each page is solved in numpy.

Rows are dealt by page and sorted; a task streams its pages and carries the last one on, so the cost of
a page is one numpy call and a task holds one Arrow batch."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from figmine.sources.spread import dealt_by

SIDES = ["x0", "y0", "x1", "y1"]


def by_page(df: DataFrame, solve: Callable[[np.ndarray], np.ndarray] | None = None, page: str = "page_key", together: Callable[[list], list] | None = None) -> DataFrame:
    """``page, x0, y0, x1, y1`` of what ``solve`` makes of the boxes of each page (n x 4, in order), or ``together`` of
    those of all pages of a batch."""
    together = together or (lambda parts: [solve(b) for b in parts])

    def one(table: pa.Table):
        pages = table[page].to_numpy()
        boxes = np.stack([table[c].to_numpy() for c in SIDES], axis=1) if len(pages) else np.zeros((0, 4))
        cut = np.append(np.flatnonzero(np.append(True, pages[1:] != pages[:-1])), len(pages)) if len(pages) else np.zeros(1, int)
        made = list(zip(pages[cut[:-1]], together([boxes[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]), strict=True))
        if made:
            rows = np.concatenate([m for _, m in made])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat([p for p, _ in made], [len(m) for _, m in made])), *(pa.array(rows[:, i]) for i in range(4))], [page, *SIDES])

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            pages = table[page].to_numpy()
            if not len(pages):
                continue
            last = int(np.flatnonzero(np.append(True, pages[1:] != pages[:-1]))[-1])
            yield from one(table.slice(0, last))
            rest = table.slice(last)
        if rest is not None:
            yield from one(rest)

    dealt = dealt_by(df.select(page, *SIDES), page).sortWithinPartitions(page, *SIDES)
    return dealt.mapInArrow(run, f"{page} long, x0 double, y0 double, x1 double, y1 double")
