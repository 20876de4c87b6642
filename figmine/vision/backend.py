"""Pixel backend in numpy.

Connected components stand for contours and long runs of dark pixels for lines: documented
approximations of edge- and Hough-based detectors, which a cluster can plug in with the same interface."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

STATS = "width int, height int, n_contours int, mean_area double, tiny_count int, density double, x_spread double, y_var double, h_lines int, n_lines int, quads int, left boolean, right boolean, tops array<int>, xs array<int>, ys array<int>"


def to_gray(rgb: np.ndarray) -> np.ndarray:
    if rgb.ndim == 2:
        return rgb
    return ((rgb[..., 0].astype(np.uint32) * 19595 + rgb[..., 1].astype(np.uint32) * 38470 + rgb[..., 2].astype(np.uint32) * 7471 + 0x8000) >> 16).astype(np.uint8)


def cell_means(gray: np.ndarray, n: int) -> np.ndarray:
    """Means of n x n cells of an image; a side shorter than n is repeated."""
    a = gray.astype(np.float64)
    for axis in (0, 1):
        if a.shape[axis] < n:
            a = np.repeat(a, -(-n // a.shape[axis]), axis=axis)
        cut = np.arange(n) * a.shape[axis] // n
        a = np.add.reduceat(a, cut, axis=axis) / np.diff(np.append(cut, a.shape[axis])).reshape((-1, 1) if axis == 0 else (1, -1))
    return a


def flat(image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows and columns of an image that differ from the one before, as an image, and their places with the
    end: what is drawn of few parts has few of them."""
    if not image.size:
        return image, np.arange(image.shape[0] + 1), np.arange(image.shape[1] + 1)
    ys = np.concatenate([[0], np.flatnonzero((image[1:] != image[:-1]).any(axis=1)) + 1, [image.shape[0]]])
    rows = image[ys[:-1]]
    xs = np.concatenate([[0], np.flatnonzero((rows[:, 1:] != rows[:, :-1]).any(axis=0)) + 1, [image.shape[1]]])
    return rows[:, xs[:-1]], ys, xs


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the runs of a mask, and the number of the 8-connected region of each.

    All pairs of touching runs are found at once; labels then fall to the smallest of their neighbours,
    and to their labels' labels, until nothing changes."""
    padded = np.zeros((mask.shape[0], mask.shape[1] + 2), np.int8)
    padded[:, 1:-1] = mask
    edges = np.diff(padded, axis=1)
    ys, starts = np.nonzero(edges == 1)
    ends = np.nonzero(edges == -1)[1]
    width = mask.shape[1] + 2
    # runs of the row above that touch a run: those that end at or after its start and start at or before its end
    low = np.searchsorted(ys * width + ends, (ys - 1) * width + starts)
    high = np.searchsorted(ys * width + starts, (ys - 1) * width + ends, "right")
    n = np.maximum(high - low, 0)
    a = np.repeat(np.arange(len(ys)), n)
    b = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - low, n)
    label = np.arange(len(ys))
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        for side in (a, b):
            np.minimum.at(label, side, least)
            np.minimum.at(label, before[side], least)
        label = label[label]
        if np.array_equal(label, before):
            break
    return ys, starts, ends, np.unique(label, return_inverse=True)[1]


def _boxes(k: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """Boxes and pixel counts of regions from those of their runs."""
    m = int(k.max()) + 1 if len(k) else 0
    out = np.zeros((m, 5), np.int64)
    out[:, :2] = np.iinfo(np.int64).max
    np.minimum.at(out[:, 0], k, x0)
    np.minimum.at(out[:, 1], k, y0)
    np.maximum.at(out[:, 2], k, x1)
    np.maximum.at(out[:, 3], k, y1)
    np.add.at(out[:, 4], k, (x1 - x0) * (y1 - y0))
    out[:, 2:4] -= out[:, :2]
    return out


def components(mask: np.ndarray) -> np.ndarray:
    """Boxes and pixel counts (x, y, w, h, area) of 8-connected regions, by merging runs of rows."""
    ys, starts, ends, k = runs(mask)
    return _boxes(k, starts, ys, ends, ys + 1)


def long_runs(mask: np.ndarray, least: int) -> int:
    """Groups of neighbouring rows that have a run of at least ``least`` dark pixels."""
    padded = np.cumsum(np.pad(mask.astype(np.int32), ((0, 0), (1, 0))), axis=1)
    if mask.shape[1] < least:
        return 0
    full = ((padded[:, least:] - padded[:, :-least]) == least).any(axis=1)
    return int((full & ~np.append(False, full[:-1])).sum())


def draw(boxes: np.ndarray, shade: int = 100) -> np.ndarray:
    """A white page with the given boxes (x0, y0, x1, y1) filled; 1 pixel a unit."""
    limits = np.ceil(boxes[:, 2:].max(axis=0)).astype(int) + 2 if len(boxes) else (1, 1)
    page = np.full((limits[1], limits[0]), 255, np.uint8)
    for x0, y0, x1, y1 in boxes.astype(int).tolist():
        page[y0:y1, x0:x1] = shade
    return page


#: cells of the rows and columns of pages that are labelled together
TOGETHER = 1 << 20


def gate_regions_of(pages: Iterable[np.ndarray], thresholds: tuple[int, ...] = (150, 200)) -> list[np.ndarray]:
    """Corners of the candidate symbols that any threshold finds, each once, for each of some pages: shape 0.3 to 4, area 400
    to 50000, both sides over 20.  Pages are cut down to the rows and columns that differ, which changes no region, and
    labelled below each other, a white row between them."""
    out, held, rows, width = [], [], 0, 0
    for page in pages:
        part = flat(page)
        h, w = part[0].shape
        if held and (rows + h + 1) * max(width, w) > TOGETHER:
            out += _together(held, rows, width, thresholds)
            held, rows, width = [], 0, 0
        held.append(part)
        rows, width = rows + h + 1, max(width, w)
    return out + (_together(held, rows, width, thresholds) if held else [])


def _together(parts: list[tuple], rows: int, width: int, thresholds: tuple[int, ...]) -> list[np.ndarray]:
    sheet, at = np.full((rows, width), 255, np.uint8), 0
    for small, _, _ in parts:
        sheet[at : at + small.shape[0], : small.shape[1]] = small
        at += small.shape[0] + 1
    tops, lefts = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    page_of = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])  # by row: a page has one place more than rows
    first = np.cumsum([0, *(len(p[2]) for p in parts)])
    masks, found = [], [np.zeros((0, 5), np.int64)]
    for t in thresholds:
        mask = sheet < t
        if any(np.array_equal(mask, m) for m in masks):
            continue
        masks.append(mask)
        ys, starts, ends, k = runs(mask)
        page = page_of[ys]
        b = _boxes(k, lefts[first[page] + starts], tops[ys], lefts[first[page] + ends], tops[ys + 1])
        of = np.zeros(len(b), np.int64)
        of[k] = page
        shape, area = b[:, 2] / np.maximum(b[:, 3], 1), b[:, 2] * b[:, 3]
        good = (shape > 0.3) & (shape < 4) & (area > 400) & (area < 50000) & (b[:, 2] > 20) & (b[:, 3] > 20)
        found.append(np.column_stack([of, b[:, :4]])[good])
    b = np.unique(np.concatenate(found), axis=0)
    corners = np.column_stack([b[:, 1:3], b[:, 1:3] + b[:, 3:]]).astype(np.float64)
    return np.split(corners, np.searchsorted(b[:, 0], np.arange(1, len(parts))))


def all_gate_regions(gray: np.ndarray, thresholds: tuple[int, ...] = (150, 200)) -> np.ndarray:
    """Corners of the candidate symbols of one page."""
    return gate_regions_of([gray], thresholds)[0]


def sobel(gray: np.ndarray) -> np.ndarray:
    """Edges: pixels whose gradient (sum of both directions) is over 150."""
    g = np.pad(gray.astype(np.int64), 1, mode="edge")
    dx = g[:-2, 2:] + 2 * g[1:-1, 2:] + g[2:, 2:] - g[:-2, :-2] - 2 * g[1:-1, :-2] - g[2:, :-2]
    dy = g[2:, :-2] + 2 * g[2:, 1:-1] + g[2:, 2:] - g[:-2, :-2] - 2 * g[:-2, 1:-1] - g[:-2, 2:]
    return abs(dx) + abs(dy) > 150


def brackets(gray: np.ndarray) -> tuple[bool, bool]:
    """Whether a column of edges in the left and in the right tenth is higher than a quarter of the image."""
    tall = sobel(gray).sum(axis=0) > gray.shape[0] * 0.25
    w = gray.shape[1]
    return bool(tall[: int(w * 0.1)].any()), bool(tall[int(w * 0.9) :].any())


def _tile_maps(hist: np.ndarray, size: int, limit: float, tiles: int) -> np.ndarray:
    """The map of gray values of each tile from its histogram, clipped; what is over goes to all values alike."""
    most = max(1.0, limit * size / 256)
    over = np.maximum(hist - most, 0).sum(axis=1, keepdims=True)
    return np.floor(np.cumsum(np.minimum(hist, most) + over / 256, axis=1) * 255 / size + 0.5).clip(0, 255).reshape(tiles, tiles, 256)


def _between(gray: np.ndarray, maps: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Means of the maps of the four tiles around pixels at rows y and columns x, in tiles, by distance."""
    out, tiles = np.zeros(gray.shape), maps.shape[0]
    for dy in (0, 1):
        ty = np.clip(np.floor(y).astype(int) + dy, 0, tiles - 1)
        wy = 1 - abs(y - (np.floor(y) + dy))
        for dx in (0, 1):
            tx = np.clip(np.floor(x).astype(int) + dx, 0, tiles - 1)
            wx = 1 - abs(x - (np.floor(x) + dx))
            out += wy[:, None] * wx[None, :] * maps[ty[:, None], tx[None, :], gray]
    return out


def equalized(gray: np.ndarray, limit: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Contrast-limited adaptive equalisation: each tile's clipped histogram gives a map of gray values, and a
    pixel takes the mean of the maps of the four tiles around it, by distance."""
    h, w = gray.shape
    th, tw = -(-h // tiles), -(-w // tiles)
    padded = np.pad(gray, ((0, th * tiles - h), (0, tw * tiles - w)), mode="edge" if min(h, w) else "constant")
    cells = padded.reshape(tiles, th, tiles, tw).swapaxes(1, 2).reshape(tiles * tiles, th * tw)
    hist = np.stack([np.bincount(c, minlength=256) for c in cells]).astype(np.float64)
    maps = _tile_maps(hist, th * tw, limit, tiles)
    return np.floor(_between(gray, maps, (np.arange(h) + 0.5) / th - 0.5, (np.arange(w) + 0.5) / tw - 0.5) + 0.5).astype(np.uint8)


def equalized_range(gray: np.ndarray, limit: float = 2.0, tiles: int = 8) -> tuple[int, int]:
    """The darkest and the lightest value of the equalised image.  Between four tiles a part of one gray value runs
    linearly along rows and columns, so only the corners of such parts are computed; an image of many parts, and one
    whose extremes lie where rounding turns, is equalised whole."""
    small, ys, xs = flat(gray)
    values = np.unique(small)
    if not gray.size or len(values) > 16 or 16 * small.size > gray.size:
        even = equalized(gray, limit, tiles)
        return int(even.min()), int(even.max())
    sides = []
    for places, n in ((ys, gray.shape[0]), (xs, gray.shape[1])):
        t = -(-n // tiles)
        whole = places.copy()
        whole[-1] = t * tiles  # the last row and column are repeated up to whole tiles
        cut = np.arange(tiles)[:, None] * t
        shared = np.maximum(np.minimum(cut + t, whole[1:]) - np.maximum(cut, whole[:-1]), 0)
        at = (np.arange(n) + 0.5) / t - 0.5
        turns = np.flatnonzero(np.diff(np.floor(at))) + 1
        ends = np.unique(np.concatenate([places[:-1], places[1:] - 1, turns, turns - 1]))
        sides.append((t, shared, at[ends], ends))
    (th, down, y, rows), (tw, across, x, columns) = sides
    hist = np.stack([(down @ (small == v).astype(np.float64) @ across.T).ravel() for v in values], axis=1)
    most = max(1.0, limit * th * tw / 256)
    over = np.maximum(hist - most, 0).sum(axis=1, keepdims=True)
    level = ((np.cumsum(np.minimum(hist, most), axis=1) + over * ((values + 1.0) / 256)) * 255 / (th * tw) + 0.5).clip(0, 255)
    if (abs(level - np.rint(level)) < 1e-6)[level < 255].any():  # rounding turns there, so in the order of all 256 values
        whole = np.zeros((tiles * tiles, 256))
        whole[:, values] = hist
        maps = _tile_maps(whole, th * tw, limit, tiles)[:, :, values]
    else:
        maps = np.floor(level).reshape(tiles, tiles, -1)
    out = _between(np.searchsorted(values, gray[rows[:, None], columns]), maps, y, x)
    ends = np.array([out.min(), out.max()]) + 0.5
    if (abs(ends - np.rint(ends)) < 1e-6).any():
        even = equalized(gray, limit, tiles)
        return int(even.min()), int(even.max())
    return int(ends[0]), int(ends[1])


def _windows(places: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows (or columns) that are equal between places: those whose surroundings differ from the ones of the row before, as
    the parts that r rows before to r after lie in, and for each row which of them stands for it."""
    part = np.repeat(np.arange(len(places) - 1), np.diff(places))
    wide = np.concatenate([np.full(r, part[0]), part, np.full(r, part[-1])])
    alone = wide[: len(part)] != wide[2 * r :]
    new = np.concatenate([[True], alone[1:] | alone[:-1] | (part[1:] != part[:-1])])
    return wide[np.flatnonzero(new)[:, None] + np.arange(2 * r + 1)], np.cumsum(new) - 1


def _thresholded(gray: np.ndarray, block: int, less: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Adaptive threshold of the rows and columns that stand for others (turned), and for each row and column which one does."""
    sigma, r = 0.3 * ((block - 1) * 0.5 - 1) + 0.8, block // 2
    kernel = np.exp(-(np.arange(-r, r + 1) ** 2) / (2 * sigma**2))
    kernel /= kernel.sum()
    small, ys, xs = flat(gray)
    (down, row_of), (across, column_of) = _windows(ys, r), _windows(xs, r)
    turned = small.T.astype(np.float64)
    mean = sum(k * turned[:, d] for k, d in zip(kernel, down.T.copy(), strict=True))
    mean = sum(k * mean[a] for k, a in zip(kernel, across.T.copy(), strict=True))
    white = small.T[across[:, r]][:, down[:, r]] > np.floor(mean + 0.5) - less
    return white, [row_of, column_of]


def adaptive_threshold(gray: np.ndarray, block: int = 11, less: float = 2.0) -> np.ndarray:
    """White where a pixel is above the Gaussian mean of its surroundings less a constant, else black.  Rows and columns
    with equal surroundings are computed once."""
    if not gray.size:
        return gray.copy()
    white, (row_of, column_of) = _thresholded(gray, block, less)
    return np.where(white.T[row_of][:, column_of], 255, 0).astype(np.uint8)


def black_share(gray: np.ndarray, block: int = 11, less: float = 2.0) -> float:
    """The share of black pixels after the adaptive threshold of an image that is not empty."""
    white, of = _thresholded(gray, block, less)
    rows, columns = (np.bincount(o) for o in of)
    return float(columns @ ~white @ rows / gray.size)


def roi_variants(gray: np.ndarray) -> list[np.ndarray]:
    """A region as it is, equalised, and thresholded: what a text reader is shown."""
    return [gray, equalized(gray), adaptive_threshold(gray)]


def read_region(gray: np.ndarray, box: tuple[int, int, int, int], read: Callable[[np.ndarray], list[tuple[str, float]]], pad: int = 10) -> tuple[str, float]:
    """The text of highest confidence that ``read`` finds in any variant of a padded region; the first of equals."""
    x, y, w, h = box
    part = gray[max(0, y - pad) : min(gray.shape[0], y + h + pad), max(0, x - pad) : min(gray.shape[1], x + w + pad)]
    best = ("", 0.0)
    for variant in roi_variants(part) if part.size else ():
        for text, confidence in read(variant):
            if confidence > best[1]:
                best = (text, confidence)
    return best


def statistics(gray: np.ndarray, threshold: int = 200) -> dict:
    mask = gray < threshold
    b = components(mask)
    area = b[:, 4].astype(float)
    boxed = (b[:, 2] / np.maximum(b[:, 3], 1) > 0.3) & (b[:, 2] / np.maximum(b[:, 3], 1) < 5) & (b[:, 2] * b[:, 3] > 100)
    h = long_runs(mask, max(1, gray.shape[1] // 4))
    return {
        "width": gray.shape[1], "height": gray.shape[0], "n_contours": len(b), "mean_area": float(area.mean()) if len(b) else 0.0, "tiny_count": int((area < 50).sum()),
        "density": float(mask.mean()), "x_spread": float(np.ptp(b[:, 0])) if len(b) else 0.0, "y_var": float(b[:, 1].var()) if len(b) else 0.0,
        "h_lines": h, "n_lines": h + long_runs(mask.T, max(1, gray.shape[0] // 4)), "quads": int(boxed.sum()),
        **dict(zip(("left", "right"), brackets(gray), strict=True)), "tops": b[:, 1].tolist(), "xs": (b[:, 0] + b[:, 2] // 2).tolist(), "ys": (b[:, 1] + b[:, 3] // 2).tolist(),
    }


def with_statistics(images: DataFrame) -> DataFrame:
    """``image_id`` and statistics of images given as ``image_id, width, height, pixels`` (gray bytes);
    images whose bytes do not fit their size give null statistics."""

    def run(batches):
        for batch in batches:
            ids, out = batch.column(0), []
            for w, h, raw in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                fits = raw is not None and w and h and len(raw) == w * h
                out.append(statistics(np.frombuffer(raw, np.uint8).reshape(h, w)) if fits else None)
            names = [x.split()[0] for x in STATS.split(", ")]
            kinds = [{"double": pa.float64(), "int": pa.int32(), "boolean": pa.bool_()}.get(x.split()[1], pa.list_(pa.int32())) for x in STATS.split(", ")]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([s and s[n] for s in out], k) for n, k in zip(names, kinds, strict=True))], ["image_id", *names])

    return images.select("image_id", "width", "height", "pixels").mapInArrow(run, f"image_id long, {STATS}")
