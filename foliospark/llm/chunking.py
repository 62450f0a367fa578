"""Splitting oversized texts: balanced targets snapped to the strongest nearby boundary.

Per text: the least number of pieces, targets that would make all pieces equally long, each target snapped to the
strongest boundary near it; when any piece passes the limit the whole text is planned anew with a piece more. Whole
texts, in Arrow batches, one at a time.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2000
OVERLAP = 200
#: Strength of a cut before position i, strongest first: after a paragraph, a sentence, a line, a clause, a word.
_BOUNDARIES = ((6, re.compile(r"\n[^\S\n]*\n\s*")), (5, re.compile(r"[.!?…。！？][\"'»“”)\]]*\s+")), (4, re.compile(r"\n\s*")), (3, re.compile(r"[,;:]\s+")), (2, re.compile(r"\s+")))
#: Within several blanks a cut may fall at any place.
_BLANKS = re.compile(r"\s{2,}")


def boundaries(text: str, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a cut separates words, with their strength; 0 inside words longer than ``limit``, which must be cut.

    A long word may also end a piece before the blank that follows it, so one of just ``limit`` characters fits.
    """
    strength = np.full(len(text) + 1, -1, np.int8)
    for m in re.finditer(rf"\S{{{limit // 2 + 1},}}", text):
        if m.end() - m.start() > limit:
            strength[m.start() + 1 : m.end()] = 0
        strength[m.end()] = 1
    for m in _BLANKS.finditer(text):
        strength[m.start() : m.end()] = 1
    for s, pattern in reversed(_BOUNDARIES):
        for m in pattern.finditer(text):
            strength[m.end()] = s
    strength[0] = strength[-1] = -1
    at = np.flatnonzero(strength >= 0)
    return at, strength[at]


def _snap(at: np.ndarray, strength: np.ndarray, low: int, target: float, high: int, window: float) -> int | None:
    """The strongest boundary in [low, high] near the target; nearer wins among equals; None if there is none."""
    i, j = np.searchsorted(at, low), np.searchsorted(at, high, side="right")
    if i >= j:
        return None
    p, s = at[i:j], strength[i:j]
    far = np.abs(p - target)
    near = far <= window
    if near.any():
        p, s, far = p[near], s[near], far[near]
        return int(p[np.lexsort((far, -s))[0]])
    return int(p[np.argmin(far)])


def _again_from(at: np.ndarray, end: int, overlap: int, last: int) -> int:
    """Where the piece after a cut at ``end`` starts: the boundary nearest to ``overlap`` before it, after ``last``."""
    want = max(end - overlap, last + 1)
    if not overlap or want >= end:
        return end
    i, j = np.searchsorted(at, max(last + 1, end - 2 * overlap)), np.searchsorted(at, end)
    return int(at[i:j][np.argmin(np.abs(at[i:j] - want))]) if i < j else want


def _planned(n: int, at: np.ndarray, strength: np.ndarray, count: int, limit: int, overlap: int) -> list[tuple[int, int, int]] | None:
    """``count`` pieces (start, new_from, end) of nearly equal length, None where one passes the limit."""
    length = (n + (count - 1) * overlap) / count
    step = length - overlap
    out: list[tuple[int, int, int]] = []
    start = fresh = 0
    for k in range(count - 1):
        target = length + k * step
        if target <= fresh:  # a long word has taken this piece's place
            continue
        high = min(start + limit, n - 1)
        end = _snap(at, strength, fresh + 1, target, high, max(1.0, min(step, limit - overlap) / 4))
        if end is None or start < fresh and end < target - step / 2:  # the overlap gives way before a word is cut or a piece is left small
            wider = _snap(at, strength, fresh + 1, target, min(fresh + limit, n - 1), max(1.0, step / 4))
            if wider is not None and (end is None or wider > end):
                end = wider
                i = np.searchsorted(at, max(start, end - limit))
                start = int(at[i]) if i < len(at) and at[i] <= fresh else fresh
        if end is None:
            break
        out.append((start, fresh, end))
        start, fresh = _again_from(at, end, overlap, start), end
    if n - start > limit and n - fresh <= limit:
        i = np.searchsorted(at, n - limit)
        start = int(at[i]) if i < len(at) and at[i] <= fresh else fresh
    out.append((start, fresh, n))
    return out if n - start <= limit else None


def _filled(n: int, at: np.ndarray, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """Pieces as long as the limit allows, for texts whose words are nearly as long as the limit."""
    out, start, fresh = [], 0, 0
    while n - start > limit:
        k = np.searchsorted(at, start + limit, side="right") - 1
        if k < 0 or at[k] <= fresh:
            start = fresh
            if n - start <= limit:
                break
            k = np.searchsorted(at, fresh + limit, side="right") - 1
        end = int(at[k])
        out.append((start, fresh, end))
        start, fresh = _again_from(at, end, overlap, start), end
    return [*out, (start, fresh, n)]


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, bool]]:
    """``(start, new_from, end, hard)`` of each piece; [start, new_from) repeats the piece before.

    ``hard`` says that the cut at ``end`` lies inside a word; that happens only where more than ``limit``
    characters hold no white space. Texts within the limit, also the empty one, are one piece.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    n = len(text)
    if n <= limit:
        return [(0, 0, n, False)]
    at, strength = boundaries(text, limit)
    least = max(2, math.ceil((n - overlap) / (limit - overlap)))
    plan = None
    for count in range(least, 2 * least + 4):
        plan = _planned(n, at, strength, count, limit, overlap)
        if plan is not None:
            break
    if plan is None:
        plan = _filled(n, at, limit, overlap)
    inside = lambda i: i < n and not text[i - 1].isspace() and not text[i].isspace()
    return [(s, f, e, inside(e)) for s, f, e in plan]


SCHEMA = "doc_id bigint, piece_no int, start int, new_from int, end int, hard boolean, piece string"


def split_texts(docs: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """A row for each piece of every text longer than ``limit`` code points; shorter, empty and null texts give none."""

    def run(batches):
        for b in batches:
            rows = []
            for d, t in zip(b["doc_id"], b["text"]):
                rows += [(d, k, s, f, e, h, t[s:e]) for k, (s, f, e, h) in enumerate(pieces(t, limit, overlap))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece_no", "start", "new_from", "end", "hard", "piece"])

    big = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.length("text") > limit)
    return big.mapInPandas(run, SCHEMA)
