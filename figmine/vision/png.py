"""PNG in numpy and zlib: eight bits a sample, not interlaced."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_MAGIC = b"\x89PNG\r\n\x1a\n"
#: samples a pixel by colour type
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode(a: np.ndarray) -> bytes:
    """A gray (h, w) or RGB (h, w, 3) image of uint8 as a PNG file."""
    h, w = a.shape[:2]
    rows = np.ascontiguousarray(a, np.uint8).reshape(h, -1)
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rows], axis=1).tobytes()
    head = struct.pack(">IIBBBBB", w, h, 8, 0 if a.ndim == 2 else 2, 0, 0, 0)
    return _MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw, 6)) + _chunk(b"IEND", b"")


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """One row without its filter; ``step`` bytes a pixel."""
    if kind == 0:
        return row
    if kind == 1:
        return row.reshape(-1, step).cumsum(axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return row + above
    out, up = row.astype(np.int64), above.astype(np.int64).tolist()
    values = out.tolist()
    for i in range(len(values)):
        left = values[i - step] if i >= step else 0
        if kind == 3:
            guess = (left + up[i]) // 2
        elif kind == 4:
            corner = up[i - step] if i >= step else 0
            p = left + up[i] - corner
            guess = min((abs(p - left), 0, left), (abs(p - up[i]), 1, up[i]), (abs(p - corner), 2, corner))[2]
        else:
            raise ValueError("unknown filter")
        values[i] = (values[i] + guess) & 255
    return np.array(values, np.uint8)


def decode(raw: bytes) -> np.ndarray:
    """(h, w) or (h, w, 3) of uint8; transparency is dropped.  Broken or other content is a ValueError."""
    if raw[:8] != _MAGIC:
        raise ValueError("no PNG file")
    at, head, palette, data = 8, None, None, b""
    while at + 8 <= len(raw):
        size, kind = struct.unpack_from(">I4s", raw, at)
        body = raw[at + 8 : at + 8 + size]
        if len(body) < size:
            raise ValueError("truncated")
        if kind == b"IHDR" and size == 13:
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body[: len(body) // 3 * 3], np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data += body
        at += size + 12
    if head is None or head[2] != 8 or head[3] not in _SAMPLES or head[6] or not head[0] or not head[1]:
        raise ValueError("unsupported PNG")
    w, h, step = head[0], head[1], _SAMPLES[head[3]]
    try:
        flat = np.frombuffer(zlib.decompress(data), np.uint8)
    except zlib.error as e:
        raise ValueError("broken PNG") from e
    if len(flat) < h * (w * step + 1):
        raise ValueError("truncated")
    rows, above = flat[: h * (w * step + 1)].reshape(h, -1), np.zeros(w * step, np.uint8)
    out = np.empty((h, w * step), np.uint8)
    for y in range(h):
        above = out[y] = _unfiltered(int(rows[y, 0]), rows[y, 1:], above, step)
    a = out.reshape(h, w, step)
    if head[3] == 3:
        if palette is None or a.max() >= len(palette):
            raise ValueError("bad palette")
        return palette[a[..., 0]]
    return a[..., 0] if step < 3 else a[..., :3]
