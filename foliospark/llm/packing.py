"""Filling fixed-capacity containers: best-two-fit in blocks of bounded size.

Items are dealt by hash into blocks of about ``block_items`` items; each block is packed on its own, so
the work is proportional to the input and every task bounded. With thousands of items a block leaves at most its
last container open, which is a share of about 1 / (containers of a block).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
BLOCK_ITEMS = 20_000


class _Sizes:
    """How many items of each size are unpacked, with the largest available size up to x."""

    def __init__(self, sizes: np.ndarray, capacity: int) -> None:
        self.count = np.bincount(sizes, minlength=capacity + 1)
        self.count[0] = 0
        self._below()

    def _below(self) -> None:
        n = len(self.count)
        self.below = np.maximum.accumulate(np.where(self.count > 0, np.arange(n), 0))

    def take(self, s: int) -> None:
        self.count[s] -= 1
        if self.count[s] == 0:
            self._below()

    def give(self, s: int) -> None:
        self.count[s] += 1
        if self.count[s] == 1:
            self._below()

    def pair(self, room: int, more_than: int) -> tuple[int, int] | None:
        """Two unpacked items that fill ``room`` best and together exceed ``more_than``."""
        a = np.flatnonzero(self.count[: room + 1])
        if not len(a):
            return None
        b = self.below[room - a]
        same = (b == a) & (self.count[a] < 2)
        b = np.where(same, self.below[np.maximum(a - 1, 0)], b)
        total = np.where(b > 0, a + b, 0)
        k = int(np.argmax(total))
        return (int(a[k]), int(b[k])) if total[k] > more_than else None


def best_two_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """The sizes of each container. Sizes are 1..capacity; greedy largest-first filling, then a container's
    smallest item gives way to two unpacked ones that fit the expanded gap more tightly, as long as that helps."""
    left = _Sizes(np.asarray(sizes, dtype=np.int64), capacity)
    bins: list[list[int]] = []
    while (top := int(left.below[capacity])) > 0:
        items, room = [], capacity
        s = top
        while s:
            left.take(s)
            items.append(s)
            room -= s
            s = int(left.below[room]) if room else 0
        while room:
            small = min(items)
            found = left.pair(room + small, small)
            if found is None:
                break
            left.take(found[0])
            left.take(found[1])
            left.give(small)
            items.remove(small)
            items += found
            room += small - sum(found)
        bins.append(items)
    return bins


def _pack_block(block: int, doc: np.ndarray, piece: np.ndarray, size: np.ndarray, capacity: int) -> pd.DataFrame:
    order = np.lexsort((piece, doc, size))
    doc, piece, size = doc[order], piece[order], size[order]
    first = np.searchsorted(size, np.arange(capacity + 2))
    nxt = first[:-1].copy()
    rows = np.empty(len(size), np.int64)
    bin_no, place, start = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    bins = best_two_fit(size[size > 0], capacity)
    for k, items in enumerate(bins):
        at = 0
        for j, s in enumerate(sorted(items, reverse=True)):
            r = nxt[s]
            nxt[s] += 1
            bin_no[r], place[r], start[r] = k, j, at
            at += s
    empty = np.flatnonzero(size == 0)  # need no room: they are dealt to the containers in turn, after their items
    turn = np.arange(len(empty))
    full, used = np.array([len(b) for b in bins] or [0]), np.array([sum(b) for b in bins] or [0])
    own = turn % len(full)
    bin_no[empty], place[empty], start[empty] = own, full[own] + turn // len(full), used[own]
    rows[:] = block
    return pd.DataFrame({"doc_id": doc, "piece_no": piece, "n_tokens": size, "block": rows, "bin": bin_no, "place": place, "start": start})


def pack(items: DataFrame, id_col: str, size_col: str, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id, piece_no, n_tokens, container, place, start`` of every item.

    Items longer than ``capacity`` are cut into full pieces and a rest; all others stay whole. Items of size 0 or
    null get a place that takes no room, in the containers of their block in turn. Repeated rows are packed as often as they come.
    """
    s = items.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(size_col), F.lit(0)).cast("bigint").alias("n"))
    full = F.greatest(F.ceil(F.col("n") / capacity).cast("int"), F.lit(1))
    cut = s.select("doc_id", "n", F.explode(F.sequence(F.lit(0), full - 1)).alias("piece_no"))
    cut = cut.select("doc_id", "piece_no", F.least(F.lit(capacity), F.col("n") - F.col("piece_no") * capacity).cast("bigint").alias("n_tokens"))
    blocks = max(1, math.ceil(cut.count() / block_items))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return _pack_block(int(key[0]), pdf["doc_id"].to_numpy(), pdf["piece_no"].to_numpy(np.int64), pdf["n_tokens"].to_numpy(np.int64), capacity)

    dealt = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(blocks)))
    done = dealt.groupBy("block").applyInPandas(run, "doc_id bigint, piece_no bigint, n_tokens bigint, block bigint, bin bigint, place bigint, start bigint")
    return done.select("doc_id", F.col("piece_no").cast("int"), F.col("n_tokens").cast("int"), F.concat_ws("-", F.col("block").cast("string"), F.col("bin").cast("string")).alias("container"), F.col("place").cast("int"), F.col("start").cast("int"))
