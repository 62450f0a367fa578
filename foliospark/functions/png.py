"""PNG pictures (8-bit, gray or RGB) to arrays and back, with NumPy and zlib."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"


class BrokenPng(ValueError):
    """The bytes are no picture that can be read."""


def _paeth(line: bytes, prev: bytes, ch: int) -> bytearray:
    out = bytearray(len(line))
    for i, x in enumerate(line):
        a, b, c = (out[i - ch] if i >= ch else 0), prev[i], (prev[i - ch] if i >= ch else 0)
        pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
        out[i] = (x + (a if pa <= pb and pa <= pc else b if pb <= pc else c)) & 255
    return out


def _average(line: bytes, prev: bytes, ch: int) -> bytearray:
    out = bytearray(len(line))
    for i, x in enumerate(line):
        out[i] = (x + ((out[i - ch] if i >= ch else 0) + prev[i]) // 2) & 255
    return out


def header(data: bytes | None) -> tuple[int, int, int, int]:
    """Width, height, bit depth and colour type from the first chunk."""
    if not data or data[:8] != SIGNATURE or data[12:16] != b"IHDR" or len(data) < 33:
        raise BrokenPng("no PNG header")
    w, h, depth, colour = struct.unpack(">IIBB", data[16:26])
    return w, h, depth, colour


def decode(data: bytes | None) -> np.ndarray:
    """The picture as (height, width) or (height, width, 3) uint8; BrokenPng for anything else.

    Chunk sums are checked; missing, cut and interlaced files and other depths count as broken.
    """
    w, h, depth, colour = header(data)
    ch = {0: 1, 2: 3}.get(colour)
    if ch is None or depth != 8 or data[28] != 0 or not w or not h:
        raise BrokenPng("only 8-bit gray or RGB without interlace")
    at, packed, ended = 8, [], False
    while at + 12 <= len(data):
        (n,) = struct.unpack(">I", data[at : at + 4])
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(body) < n or data[at + 8 + n : at + 12 + n] != struct.pack(">I", zlib.crc32(body, zlib.crc32(kind))):
            raise BrokenPng("a chunk is damaged")
        if kind == b"IDAT":
            packed.append(body)
        elif kind == b"IEND":
            ended = True
            break
        at += 12 + n
    if not ended:
        raise BrokenPng("the file is cut off")
    try:
        raw = zlib.decompress(b"".join(packed))
    except zlib.error as e:
        raise BrokenPng(str(e)) from e
    if len(raw) != h * (1 + w * ch):
        raise BrokenPng("too few or too many pixels")
    rows = np.frombuffer(raw, np.uint8).reshape(h, 1 + w * ch)
    kinds = rows[:, 0]
    if kinds.max() > 4:
        raise BrokenPng("unknown filter")
    out = rows[:, 1:].copy()
    if kinds.any():
        for y in range(h):
            k = kinds[y]
            if k == 1:
                out[y] = np.cumsum(out[y].reshape(w, ch), axis=0, dtype=np.uint8).reshape(-1)
            elif k == 2 and y:
                out[y] += out[y - 1]
            elif k > 2:
                prev = out[y - 1].tobytes() if y else bytes(w * ch)
                out[y] = np.frombuffer((_average if k == 3 else _paeth)(out[y].tobytes(), prev, ch), np.uint8)
    return out.reshape(h, w) if ch == 1 else out.reshape(h, w, ch)


def gray(picture: np.ndarray) -> np.ndarray:
    """One channel; RGB by the public integer weights for luma."""
    if picture.ndim == 2:
        return picture
    r, g, b = (picture[..., i].astype(np.uint32) for i in range(3))
    return ((19595 * r + 38470 * g + 7471 * b + 32768) >> 16).astype(np.uint8)


def encode(picture: np.ndarray) -> bytes:
    """A gray or RGB uint8 array as PNG, without line filters."""
    a = np.ascontiguousarray(picture, dtype=np.uint8)
    h, w = a.shape[:2]
    rows = np.zeros((h, 1 + a[0].size), np.uint8)
    rows[:, 1:] = a.reshape(h, -1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))

    head = struct.pack(">IIBBBBB", w, h, 8, 0 if a.ndim == 2 else 2, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")
