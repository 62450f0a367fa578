"""Pictures of written lines as sequences of column symbols, their winnowed fingerprints, and alignment.

A symbol says which of five bands around the line's middle holds more ink and how the bands change a few columns on;
such order relations survive other brightness, small shifts, blur and specks. A rolling hash runs over strided
symbols, and of every window of positions the smallest hash is kept.
"""

from __future__ import annotations

import numpy as np

from ..functions.png import BrokenPng, decode, gray

BANDS, BAND = 5, 5
AHEAD, GRAM, GAP, WINNOW = 3, 7, 3, 5
LEAST_CONTRAST, INK_MEAN = 24.0, 0.12
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ink(data: bytes | None) -> np.ndarray | None:
    """Ink between 0 and 1, single specks removed; None for missing, broken and blank pictures."""
    try:
        g = gray(decode(data)).astype(np.float32)
    except BrokenPng:
        return None
    n = g.size
    ranked = np.partition(g, (n // 100, 4 * n // 5), axis=None)
    ground, dark = float(ranked[4 * n // 5]), float(ranked[n // 100])
    if ground - dark < LEAST_CONTRAST:
        return None
    f = np.clip((ground - g) / (ground - dark), 0.0, 1.0)
    around = box(f, False) - f
    f[(f > 0.5) & (around < 0.8)] = 0.0
    return f if (f > 0.4).sum() >= 12 else None


def box(a: np.ndarray, mean: bool = True) -> np.ndarray:
    """Sum or mean over 3 x 3."""
    p = np.pad(a, 1)
    v = p[:-2] + p[1:-1] + p[2:]
    s = v[:, :-2] + v[:, 1:-1] + v[:, 2:]
    return s / 9.0 if mean else s


def middle(f: np.ndarray) -> float:
    """The mean row of the ink."""
    rows = f.sum(axis=1)
    return float((rows * np.arange(len(rows))).sum() / rows.sum())


def _bands(f: np.ndarray, mid: np.ndarray) -> np.ndarray:
    """Ink per column in ``BANDS`` bands around each column's ``mid`` (at a fraction of a row), smoothed along the line."""
    h, w = f.shape
    upto = np.zeros((h + 1, w), np.float32)
    np.cumsum(f, axis=0, out=upto[1:])
    edges = np.clip(mid[None, :] + (BAND * np.arange(BANDS + 1) - BANDS * BAND / 2.0 + 0.5)[:, None], 0.0, float(h)).astype(np.float32)
    i = np.minimum(edges.astype(np.int64), h - 1)
    low = np.take_along_axis(upto, i, axis=0)
    at = low + (edges - i) * (np.take_along_axis(upto, i + 1, axis=0) - low)
    p = np.zeros((BANDS, w + 4), np.float32)
    p[:, 2:-2] = at[1:] - at[:-1]
    return p[:, :-4] + 2 * p[:, 1:-3] + 3 * p[:, 2:-2] + 2 * p[:, 3:-1] + p[:, 4:]


_SPAN = AHEAD + (GRAM - 1) * GAP
_SPACE = _SPAN + WINNOW


def fingerprints(pictures: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Selected hashes (int64) and their columns, for each ink picture; pictures of one height are handled side by side."""
    out: list = [None] * len(pictures)
    for height in {p.shape[0] for p in pictures}:
        own = [k for k, p in enumerate(pictures) if p.shape[0] == height]
        starts, at = [], _SPACE
        for k in own:
            starts.append(at)
            at += pictures[k].shape[1] + _SPACE
        f, mid, ok = np.zeros((height, at), np.float32), np.zeros(at, np.float32), np.zeros(at, bool)
        for k, s in zip(own, starts):
            w = pictures[k].shape[1]
            # equal mean ink, so that blur and thin strokes leave the order of sums alone
            f[:, s : s + w] = box(pictures[k]) * (INK_MEAN * pictures[k].size / pictures[k].sum())
            mid[s - 2 : s + w + 2] = middle(pictures[k])
            ok[s : max(s, s + w - _SPAN)] = True
        for k, found in zip(own, _selected(_bands(f, mid), ok, starts)):
            out[k] = found
    return out


def _selected(b: np.ndarray, ok: np.ndarray, starts: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    w, eps = b.shape[1], np.float32(0.35)
    here, there = b[:, : w - AHEAD], b[:, AHEAD:]
    s = np.zeros(w - AHEAD, np.uint64)
    ahead = there > here + eps
    above = here[1:] > here[:-1] + eps
    for i in range(BANDS):
        s |= ahead[i].astype(np.uint64) << np.uint64(i)
    for i in range(BANDS - 1):
        s |= above[i].astype(np.uint64) << np.uint64(BANDS + i)
    n = len(s) - (GRAM - 1) * GAP
    h, inked = np.zeros(n, np.uint64), np.zeros(n, np.int32)
    for j in range(GRAM):
        x = s[j * GAP : j * GAP + n]
        h = (h ^ x) * _MIX
        h ^= h >> np.uint64(29)
        inked += x > 0
    none = np.uint64(1 << 63)
    h = np.where((inked >= GRAM - 2) & ok[:n], h >> np.uint64(1), none)
    win = np.lib.stride_tricks.sliding_window_view(h, WINNOW)
    at = np.unique(np.arange(len(win)) + np.argmin(win, axis=1))
    at = at[h[at] < none]
    cut = np.searchsorted(at, np.asarray([*starts[1:], w + 1]) - 1)
    parts, last = [], 0
    for first, stop in zip(starts, cut.tolist()):
        parts.append((h[at[last:stop]].astype(np.int64), (at[last:stop] - first).astype(np.int32)))
        last = stop
    return parts


def similarity(a: np.ndarray, b: np.ndarray, dx: int, give_up: float = 0.7) -> float:
    """The correlation of two ink pictures, smoothed, at the best shift near ``dx`` columns and the difference of middles.

    Below ``give_up`` at the first shift no other is tried. Where the pictures are much alike but not the same, each is
    compared with the other blurred once more, as one may be a blurred copy.
    """
    best = _correlation(a, b, dx, give_up)
    if 0.9 < best < 0.99:
        best = max(best, _correlation(box(a), b, dx, give_up), _correlation(a, box(b), dx, give_up))
    return best


def _correlation(a: np.ndarray, b: np.ndarray, dx: int, give_up: float) -> float:
    dy = round(middle(a) - middle(b))
    a, b = box(np.pad(a, 1)), box(np.pad(b, 1))
    size = max(a.shape[0], b.shape[0]) * max(a.shape[1], b.shape[1])
    ma, mb = float(a.sum()), float(b.sum())
    base = np.sqrt(max(1e-9, (float((a * a).sum()) - ma * ma / size) * (float((b * b).sum()) - mb * mb / size)))
    best = 0.0
    for x, y in ((dx, dy), (dx - 1, dy), (dx + 1, dy), (dx, dy - 1), (dx, dy + 1), (dx - 1, dy - 1), (dx - 1, dy + 1), (dx + 1, dy - 1), (dx + 1, dy + 1)):
        left, right, top, low = max(0, x), min(a.shape[1], b.shape[1] + x), max(0, y), min(a.shape[0], b.shape[0] + y)
        if right - left < 8 or low - top < 4:
            continue
        dot = float(np.vdot(a[top:low, left:right], b[top - y : low - y, left - x : right - x]))
        best = max(best, (dot - ma * mb / size) / base)
        if best < give_up and (x, y) == (dx, dy - 1):
            return best
    return best
