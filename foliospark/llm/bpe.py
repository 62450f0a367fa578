"""Byte-level BPE by speculation and verification.

Greedy longest match proposes the tokens of each distinct word; a table of adjacent pairs, filled by exact
merging of each new pair once, checks all proposals at once; a word any pair of which fails is merged
exactly. A sequence of tokens is the BPE encoding of a word exactly when every adjacent pair is the encoding of
its own bytes, so the result is exact. Texts are split into words by the vocabulary's public pattern.
"""

from __future__ import annotations

import base64
import os
from itertools import chain

import numpy as np
import regex
from pyspark import SparkFiles

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the vocabulary's public pattern, white space written as the Unicode property.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
WORDS_KEPT = 500_000
PAIRS_KEPT = 1_000_000
#: Words longer than this are cut by the pattern's own rules only; exact merging of them uses a heap.
_LONG = 64


class ByteBpe:
    """An encoder with memories of words and pairs, both emptied when full."""

    def __init__(self, path: str = VOCABULARY) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.words: dict[str, tuple[int, ...]] = {}
        self.pair_keys = np.empty(0, np.int64)
        self.pair_good = np.empty(0, bool)

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the pair of lowest rank first, leftmost among equals."""
        ranks = self.ranks
        n = len(word)
        if n > _LONG:
            return self._merge_long(word)
        parts = [word[i : i + 1] for i in range(n)]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        import heapq

        ranks, n = self.ranks, len(word)
        nxt, prv, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, stop = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if not alive[i] or j >= n or end[j] != stop:
                continue
            end[i], nxt[i], alive[j] = stop, nxt[j], False
            if nxt[j] < n:
                prv[nxt[j]] = i
                if (q := ranks.get(word[i : end[nxt[i]]])) is not None:
                    heapq.heappush(heap, (q, i, end[nxt[i]]))
            if prv[i] >= 0 and (q := ranks.get(word[prv[i] : stop])) is not None:
                heapq.heappush(heap, (q, prv[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : end[i]]])
            i = nxt[i]
        return out

    def _greedy(self, word: bytes) -> list[int]:
        ranks, out, i, n = self.ranks, [], 0, len(word)
        while i < n:
            for j in range(min(n, i + self.longest), i, -1):
                r = ranks.get(word[i:j])
                if r is not None:
                    out.append(r)
                    i = j
                    break
        return out

    def _good_pairs(self, keys: np.ndarray) -> np.ndarray:
        """Whether each pair (left * 2**20 + right) is the encoding of its bytes."""
        uniq, back = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.pair_keys, uniq)
        known = (at < len(self.pair_keys)) & (self.pair_keys[np.minimum(at, max(len(self.pair_keys) - 1, 0))] == uniq) if len(self.pair_keys) else np.zeros(len(uniq), bool)
        good = np.zeros(len(uniq), bool)
        if known.any():
            good[known] = self.pair_good[at[known]]
        fresh = ~known
        if fresh.any():
            b = self.bytes_of
            good[fresh] = [self.merge(b[k >> 20] + b[k & 0xFFFFF]) == [k >> 20, k & 0xFFFFF] for k in uniq[fresh].tolist()]
            keep = self.pair_keys if len(self.pair_keys) < PAIRS_KEPT else np.empty(0, np.int64)
            flag = self.pair_good if len(keep) else np.empty(0, bool)
            keys_all, flags_all = np.concatenate([keep, uniq[fresh]]), np.concatenate([flag, good[fresh]])
            order = np.argsort(keys_all, kind="stable")
            self.pair_keys, self.pair_good = keys_all[order], flags_all[order]
        return good[back]

    def learn(self, words: list[str]) -> None:
        """Encode new distinct words into the memory."""
        raw = [w.encode("utf-8") for w in words]
        proposed = [[r] if (r := self.ranks.get(b)) is not None else self._greedy(b) for b in raw]
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(proposed)), lengths)
        inner = owner[1:] == owner[:-1]
        bad: set[int] = set()
        if inner.any():
            left = np.flatnonzero(inner)
            good = self._good_pairs((flat[left] << 20) | flat[left + 1])
            bad = set(owner[left[~good]].tolist())
        for i, w in enumerate(words):
            self.words[w] = tuple(self.merge(raw[i])) if i in bad else tuple(proposed[i])

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text; null and empty texts give an empty list."""
        split = [PATTERN.findall(t) if t else [] for t in texts]
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        fresh = set().union(*split) - self.words.keys() if split else set()
        if fresh:
            self.learn(list(fresh))
        get = self.words.__getitem__
        return [list(chain.from_iterable(map(get, s))) for s in split]


_loaded: dict[str, ByteBpe] = {}


def ship(context, path: str = VOCABULARY) -> None:
    """Sends the vocabulary file to the executors, once for a context."""
    name = os.path.basename(path)
    if not any(os.path.basename(f) == name for f in context.listFiles):
        context.addFile(path)


def encoder(path: str = VOCABULARY) -> ByteBpe:
    """One encoder for each worker process, from the shipped file or else the path itself."""
    if path not in _loaded:
        try:
            shipped = SparkFiles.get(os.path.basename(path))
        except Exception:  # noqa: BLE001 - no Spark here
            shipped = path
        _loaded[path] = ByteBpe(shipped if os.path.exists(shipped) else path)
    return _loaded[path]
