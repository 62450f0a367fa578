"""Image kernels on NumPy arrays: thresholds, regions, resizing, augmentation."""

from __future__ import annotations

import numpy as np

INK_BELOW, START_SHARE, END_SHARE = 180, 0.02, 0.01
MIN_HEIGHT, MIN_WIDTH, PAD = 15, 50, 5
#: The usual weights of red, green and blue in gray.
LUMA = np.array([0.299, 0.587, 0.114])


def ink_rows(gray: np.ndarray, below: int = INK_BELOW) -> np.ndarray:
    """Dark pixels of each row."""
    return (gray < below).sum(axis=1)


def regions(gray: np.ndarray, below: int = INK_BELOW, min_height: int = MIN_HEIGHT, min_width: int = MIN_WIDTH, pad: int = PAD) -> list[tuple[int, int, int, int]]:
    """Boxes (x0, y0, x1, y1) of written lines.

    A region starts at a row with more ink than 2 % of the width, goes on until a row with at most 1 %, and closes at
    the bottom; boxes are padded sideways, clamped, and dropped when too small.
    """
    h, w = gray.shape
    ink = ink_rows(gray, below)
    out, start = [], None
    for y in range(h + 1):
        n = ink[y] if y < h else -1
        if start is None and n > START_SHARE * w:
            start = y
        elif start is not None and n <= END_SHARE * w:
            columns = np.flatnonzero((gray[start:y] < below).any(axis=0))
            if y - start >= min_height and len(columns):
                x0, x1 = max(0, int(columns[0]) - pad), min(w, int(columns[-1]) + pad)
                if x1 - x0 >= min_width:
                    out.append((x0, start, x1, y))
            start = None
    return out


def resize(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resizing with a triangle filter as wide as the reduction."""

    def weights(n: int, m: int) -> np.ndarray:
        scale = n / m
        support = max(1.0, scale)
        centre = (np.arange(m) + 0.5) * scale - 0.5
        d = np.abs(np.arange(n)[None, :] - centre[:, None]) / support
        k = np.clip(1.0 - d, 0.0, None)
        return k / k.sum(axis=1, keepdims=True)

    return weights(a.shape[0], height) @ a.astype(np.float64) @ weights(a.shape[1], width).T


def to_height(a: np.ndarray, height: int = 128) -> np.ndarray:
    """Resized to a height, keeping the aspect, in whole steps of brightness."""
    return np.clip(np.rint(resize(a, height, max(1, int(height * a.shape[1] / a.shape[0])))), 0, 255)


def average_hash(gray: np.ndarray, side: int = 8) -> str:
    """64 bits: which cells of the picture reduced to 8 x 8 are brighter than their mean."""
    small = np.round(resize(gray, side, side))
    return "".join("1" if x else "0" for x in (small > small.mean()).reshape(-1))


def grid_feature(gray: np.ndarray, rows: int = 4, cols: int = 16) -> list[float]:
    """Mean brightness in a grid over the picture resized to 64 x 512, in [0, 1]."""
    a = resize(gray, 64, 512) / 255.0
    return a.reshape(rows, 64 // rows, cols, 512 // cols).mean(axis=(1, 3)).reshape(-1).tolist()


def augment(picture: np.ndarray, seed: int) -> np.ndarray:
    """Rotation up to 10 degrees on white, brightness and contrast by 0.7 to 1.3, blur half of the time, specks in a third.

    Gray stays gray and RGB stays RGB; the contrast turns about the mean of the gray picture.
    """
    r = np.random.default_rng(seed)
    h, w = picture.shape[:2]
    angle = np.deg2rad(r.uniform(-10, 10))
    y, x = np.mgrid[:h, :w]
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sx = np.rint(np.cos(angle) * (x - cx) - np.sin(angle) * (y - cy) + cx).astype(int)
    sy = np.rint(np.sin(angle) * (x - cx) + np.cos(angle) * (y - cy) + cy).astype(int)
    ok = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    a = picture[np.clip(sy, 0, h - 1), np.clip(sx, 0, w - 1)].astype(np.float64)
    a[~ok] = 255
    a = np.clip(a * r.uniform(0.7, 1.3), 0, 255)
    mean = round(float((a if a.ndim == 2 else a @ LUMA).mean()))
    a = np.clip(mean + (a - mean) * r.uniform(0.7, 1.3), 0, 255)
    if r.random() < 0.5:
        sigma = r.uniform(0.3, 1.0)
        k = np.exp(-0.5 * (np.arange(-3, 4) / sigma) ** 2)
        k /= k.sum()
        p = np.pad(a, ((3, 3), (3, 3)) + ((0, 0),) * (a.ndim - 2), mode="edge")
        p = sum(k[i] * p[:, i : i + w] for i in range(7))
        a = sum(k[i] * p[i : i + h] for i in range(7))
    if r.random() < 0.3:
        u = r.random((h, w))
        a[u < 0.01] = 0
        a[u > 0.99] = 255
    return np.clip(np.rint(a), 0, 255).astype(np.uint8)


def typed_strip(seed: int, height: int = 64, width: int = 512) -> np.ndarray:
    """A light strip with dark bars in the rhythm of typed words, unlike handwriting, to try drift detectors on."""
    r = np.random.default_rng(seed)
    strip = np.full((height, width), 245, np.uint8)
    x = 10
    for _ in range(int(r.integers(4, 9))):
        for _ in range(int(r.integers(2, 9))):
            if x + 8 > width - 10:
                return strip
            strip[15 : 15 + int(r.choice([24, 32])), x : x + 6] = 15
            x += 10
        x += 12
    return strip


def compose_page(texts: list[str], seed: int, height: int = 1100, width: int = 850) -> np.ndarray:
    """A light page with dark strokes for each text, for demos and tests."""
    r = np.random.default_rng(seed)
    page = np.full((height, width), 245, np.uint8)
    y = 60
    for t in texts:
        if y + 40 > height:
            break
        n = min(width - 120, 60 + 8 * len(t))
        for x in range(60, 60 + n, 4):
            page[y + int(r.integers(0, 6)) : y + 24, x : x + 3] = 60
        y += 60
    return page
