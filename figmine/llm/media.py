"""Media columns: Netpbm and BMP images decoded to numpy arrays, area-resized by integral images, and
written as NPY tiles with difference hashes.

Defined cases: null or broken content gives null outputs (``decode`` raises ``ValueError``); images with
no pixels, or with samples that are no numbers or above their maximum, are broken, as are plain ones with a
comment among their samples; samples stay as stored, also where their maximum is below 255; extra columns pass
through, columns named like an output are replaced.  A null text is an empty payload.  Integral images are
made in strips along the longer side, so a very long one costs little beside itself.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from figmine.llm.common import bound_batches

UNIT = 576
TILE = 32
#: pixels of a strip of an integral image
STRIP = 1 << 18


def _header(raw: bytes, n: int) -> tuple[list[int], int]:
    """n whitespace-separated numbers after the magic, with comments; position after one blank."""
    at, out = 2, []
    while len(out) < n:
        while at < len(raw) and (raw[at : at + 1].isspace() or raw[at] == 0x23):
            at = (raw.find(b"\n", at) if raw[at] == 0x23 else at) + 1
            if at == 0:
                raise ValueError("open comment")
        end = at
        while end < len(raw) and 0x30 <= raw[end] <= 0x39:
            end += 1
        if end == at:
            raise ValueError("bad Netpbm header")
        out.append(int(raw[at:end]))
        at = end
    return out, at + 1


def decode_netpbm(raw: bytes) -> np.ndarray:
    """P1 to P6: (h, w) or (h, w, 3), uint8 (uint16 above a maximum of 255); bitmaps become 0 and 255."""
    kind = raw[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("no Netpbm image")
    bitmap, depth = kind in (b"P1", b"P4"), 3 if kind in (b"P3", b"P6") else 1
    numbers, at = _header(raw, 2 if bitmap else 3)
    w, h = numbers[:2]
    top = 1 if bitmap else numbers[2]
    if not w or not h or not 0 < top < 65536:
        raise ValueError("bad Netpbm header")
    n = w * h * depth
    if at > len(raw) or n > 8 * len(raw):  # no format has more than eight samples a byte
        raise ValueError("truncated")
    if kind == b"P1":
        a = np.frombuffer(raw[at - 1 :].translate(None, b" \t\n\v\f\r"), np.uint8)[:n].astype(np.int64) - 0x30
    elif kind in (b"P2", b"P3"):
        a = np.array([_sample(x) for x in raw[at - 1 :].split(None, n)[:n]], np.int64)
    elif kind == b"P4":
        stride = (w + 7) // 8
        if len(raw) - at < stride * h:
            raise ValueError("truncated")
        rows = np.frombuffer(raw, np.uint8, count=stride * h, offset=at)
        a = np.unpackbits(rows.reshape(h, stride), axis=1)[:, :w].ravel()
    else:
        dtype = np.dtype(">u2" if top > 255 else np.uint8)
        if len(raw) - at < n * dtype.itemsize:
            raise ValueError("truncated")
        a = np.frombuffer(raw, dtype, count=n, offset=at)
    if len(a) < n:
        raise ValueError("truncated")
    if a.min() < 0 or a.max() > top:
        raise ValueError("sample out of range")
    if bitmap:
        a = (1 - a.astype(np.uint8)) * np.uint8(255)
    a = a.astype(np.uint16 if top > 255 else np.uint8)
    return a.reshape((h, w, 3) if depth == 3 else (h, w))


def _sample(raw: bytes) -> int:
    if not raw.isdigit() or len(raw.lstrip(b"0")) > 5:
        raise ValueError("bad sample")
    return int(raw)


def encode_pgm(a: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (a.shape[1], a.shape[0]) + np.ascontiguousarray(a, np.uint8).tobytes()


def _mask_bytes(raw: bytes) -> list[int]:
    """Which byte of a pixel holds red, green and blue."""
    whole = [0xFF << 8 * i for i in range(4)]
    masks = struct.unpack_from("<III", raw, 54) if len(raw) >= 66 else ()
    if len(set(masks)) != 3 or not set(masks) <= set(whole):
        raise ValueError("unsupported colour masks")
    return [whole.index(m) for m in masks]


def decode_bmp(raw: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits: (h, w, 3) uint8, RGB, top row first.  The colour masks of 32-bit
    pixels are read; masks that are not whole bytes are broken content, as is any other kind of BMP."""
    if raw[:2] != b"BM" or len(raw) < 54:
        raise ValueError("no BMP image")
    start, size, w, h, _, bits, compression = struct.unpack_from("<I4x", raw, 10)[0:1] + struct.unpack_from("<IiiHHI", raw, 14)
    if compression not in (0, 3) or bits not in (1, 4, 8, 24, 32) or w <= 0 or h == 0 or compression == 3 and bits != 32:
        raise ValueError("unsupported BMP")
    rows, stride = abs(h), (w * bits + 31) // 32 * 4
    if len(raw) < start + stride * rows:
        raise ValueError("truncated")
    a = np.frombuffer(raw, np.uint8, count=stride * rows, offset=start).reshape(rows, stride)
    if bits >= 24:
        place = _mask_bytes(raw) if compression == 3 else [2, 1, 0]
        a = a[:, : w * bits // 8].reshape(rows, w, bits // 8)[:, :, place]
    else:
        used = struct.unpack_from("<I", raw, 46)[0] or 1 << bits
        palette = np.frombuffer(raw, np.uint8, count=4 * used, offset=14 + size).reshape(used, 4)[:, 2::-1]
        index = a if bits == 8 else np.stack([a >> 4, a & 15], -1).reshape(rows, -1) if bits == 4 else np.unpackbits(a, axis=1)
        index = index[:, :w]
        if index.max() >= used:
            raise ValueError("bad palette index")
        a = palette[index]
    return np.ascontiguousarray(a if h < 0 else a[::-1])


def decode(raw: bytes) -> np.ndarray:
    return decode_bmp(raw) if raw[:2] == b"BM" else decode_netpbm(raw)


def gray(a: np.ndarray) -> np.ndarray:
    return a if a.ndim == 2 else (a.astype(np.uint32) @ np.array([299, 587, 114], np.uint32) + 500) // 1000


def _sums(a: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The integral image along the first axis at fractional edges, made in strips."""
    low = np.minimum(edges.astype(np.int64), len(a) - 1)
    part = (edges - low).reshape(-1, *[1] * (a.ndim - 1))
    out, total = np.empty((len(edges), *a.shape[1:])), np.zeros(a.shape[1:])
    step = max(1, STRIP // max(1, a[0].size))
    for start in range(0, len(a), step):
        rows = a[start : start + step].astype(np.float64)
        sums = np.cumsum(np.concatenate([total[None], rows]), axis=0)
        mine = np.flatnonzero((low >= start) & (low < start + len(rows)))
        at = low[mine] - start
        out[mine] = sums[at] + rows[at] * part[mine]
        total = sums[-1]
    return out


def area_resize(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over exact areas, read off the integral image: (height, width[, channels]) of doubles."""
    if a.shape[1] > a.shape[0]:  # strips run along the longer side
        return np.swapaxes(area_resize(np.swapaxes(a, 0, 1), width, height), 0, 1)
    ys, xs = np.arange(height + 1) * (a.shape[0] / height), np.arange(width + 1) * (a.shape[1] / width)
    rows = np.diff(_sums(a, ys), axis=0)
    cols = np.moveaxis(_sums(np.moveaxis(rows, 1, 0), xs), 0, 1)
    return np.diff(cols, axis=1) / (a.shape[0] / height * (a.shape[1] / width))


def npy_tile(a: np.ndarray, size: int = TILE) -> bytes:
    """A size x size tile of rounded means as the bytes of an NPY file."""
    out = io.BytesIO()
    np.lib.format.write_array(out, np.floor(area_resize(a, size, size) + 0.5).astype(np.uint16 if a.dtype == np.uint16 else np.uint8), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def difference_hash(a: np.ndarray, size: int = 8) -> str:
    """Hex of size*size bits: each cell brighter than its right neighbour."""
    small = np.round(area_resize(gray(a), size, size + 1), 6)
    return np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


def media_columns(df: DataFrame, content: str = "content", tile: int = TILE) -> DataFrame:
    """``df`` with ``media_height, media_width, media_channels, media_tile`` (NPY) and ``media_hash``."""
    names = ("media_height", "media_width", "media_channels", "media_tile", "media_hash")
    kept = df.select(*[c for c in df.columns if c.lower() not in names])
    at = kept.columns.index(content)

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(5)]
            for raw in batch.column(at).to_pylist():
                try:
                    a = decode(raw or b"")
                    values = (a.shape[0], a.shape[1], a.shape[2] if a.ndim == 3 else 1, npy_tile(a, tile), difference_hash(a))
                except ValueError:
                    values = (None,) * 5
                for c, v in zip(cols, values, strict=True):
                    c.append(v)
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [*batch.schema.names, *names])

    schema = T.StructType(list(kept.schema.fields))
    for name, kind in zip(names, ("integer", "integer", "integer", "binary", "string"), strict=True):
        schema.add(name, kind)
    return kept.mapInArrow(run, schema)


def payload_of(text: str | None, unit: int = UNIT) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + b"\xff" * (max(unit, -(-len(raw) // unit) * unit) - len(raw))


def media_report(docs: DataFrame) -> DataFrame:
    """Every text stored as a graymap of 24 columns, read back, with the digests of both."""

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(7)]
            for text in batch.column(1).to_pylist():
                n, payload = payload_of(text)
                stored = encode_pgm(np.frombuffer(payload, np.uint8).reshape(-1, 24))
                image = decode_netpbm(stored)
                back = image.tobytes()
                feature = f"{difference_hash(image)}:{zlib.crc32(npy_tile(image)):08x}"
                for c, v in zip(cols, (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
