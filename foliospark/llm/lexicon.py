"""Trusted words with complete retrieval of near spellings, and their ranking in context.

Glyphs that recognisers confuse are folded together; a trie holds the folded words, and a Levenshtein automaton of
one edit, run for a whole batch of tokens at once over the trie's levels, finds every folded word within that
distance. The automaton's states are bit masks, so a level is a few array operations for all open paths.
"""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np

#: Shapes that recognisers take for one another, written out as strokes, longest first.
_PAIRS = (("ﬁ", "fi"), ("ﬂ", "fl"), ("�", "r"), ("ß", "b"), ("æ", "ae"), ("œ", "oe"))
_STROKES = str.maketrans(
    {
        "ſ": "s", "5": "s", "0": "o", "9": "g", "q": "g", "6": "c", "e": "c", "8": "ii", "b": "ii", "h": "ii", "1": "i", "l": "i", "|": "i",
        "j": "i", "!": "i", "f": "t", "m": "rri", "n": "ri", "w": "vv", "d": "ci", "u": "ii", "z": "2",
    }
)
_MARKS = re.compile("[̀-ͯ]")
EDGE = ".,;:!?…()[]{}\"'«»“”„‘’*<>"
LONGEST = 60
#: Cost of an edit in logarithms of counts, for a token of one letter.
EDIT = 24.0
#: How many times more frequent a word of the same strokes may be before a spelling falls to it.
RATIO = 400
#: Share of all words from which a word is common, so at most 1 / COMMON are.
COMMON = 1e-4


def fold(word: str) -> str:
    """A word as strokes: equal for words that differ only by usual confusions of glyphs."""
    w = word.lower()
    for a, b in _PAIRS:
        if a in w:
            w = w.replace(a, b)
    if not w.isascii():
        w = _MARKS.sub("", unicodedata.normalize("NFKD", w))
    return w.translate(_STROKES).replace("ct", "ci")  # after e has become c, so that e and c stay equal beside a t


def shape(token: str) -> str:
    """A token with digits as its shape: digits 0, capitals A, other letters a."""
    return "".join("0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in token)


class Trie:
    """Folded words as levels of arrays: the nodes of a level are numbered in order, so children of a node lie next to each other."""

    def __init__(self, words: list[str]) -> None:
        words = sorted(set(words))
        self.words = words
        lens = np.array([len(w) for w in words], np.int64)
        width = int(lens.max()) if len(words) else 0
        text = np.zeros((len(words), width), np.int32)
        text[np.arange(width) < lens[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.int32)
        chars, codes = np.unique(text, return_inverse=True)
        codes = codes.reshape(text.shape)
        self.code = {chr(c): i for i, c in enumerate(chars.tolist()) if c}
        differs = np.zeros(text.shape, bool)
        differs[:1] = True
        differs[1:] = text[1:] != text[:-1]
        np.logical_or.accumulate(differs, axis=1, out=differs)
        at, size = np.zeros(len(words), np.int64), 1  # the node each word has reached
        first, n, label, end = [np.zeros(1, np.int64)], [], [np.zeros(1, np.int64)], [np.full(1, -1, np.int64)]
        for k in range(width):
            long = lens > k
            new = long & differs[:, k]
            node = size + np.cumsum(new) - 1
            below = np.bincount(at[new] - (size - len(end[-1])), minlength=len(end[-1]))
            n.append(below)
            first[-1] = size + np.cumsum(below) - below
            label.append(codes[new, k])
            last = np.full(int(new.sum()), -1, np.int64)
            done = np.flatnonzero(lens == k + 1)
            last[node[done] - size] = done
            end.append(last)
            first.append(np.zeros(len(last), np.int64))
            at = np.where(long, node, at)
            size += len(last)
        n.append(np.zeros(len(end[-1]), np.int64))
        self.first, self.n, self.label, self.end = (np.concatenate(x) for x in (first, n, label, end))

    def within_one(self, tokens: list[str]) -> list[list[tuple[int, str]]]:
        """For each folded token all folded words at distance 0 or 1, with the distance. Tokens longer than LONGEST have none."""
        out: list[list[tuple[int, str]]] = [[] for _ in tokens]
        ok = [i for i, t in enumerate(tokens) if 0 < len(t) <= LONGEST]
        for lot in range(0, len(ok), 4000):
            self._run([(i, tokens[i]) for i in ok[lot : lot + 4000]], out)
        return out

    def _run(self, tokens: list[tuple[int, str]], out: list) -> None:
        masks = np.zeros((len(tokens), len(self.code) + 2), np.uint64)
        lens = np.array([len(t) for _, t in tokens])
        for r, (_, t) in enumerate(tokens):
            for p, c in enumerate(t):
                k = self.code.get(c)
                if k is not None:
                    masks[r, k] |= np.uint64(1 << p)
        goal = np.uint64(1) << lens.astype(np.uint64)
        one = np.uint64(1)
        row, node = np.arange(len(tokens)), np.zeros(len(tokens), np.int64)
        exact, near = np.ones(len(tokens), np.uint64), np.full(len(tokens), 3, np.uint64)  # bit p: p characters read
        while len(row):
            n = self.n[node]
            rep = np.repeat(np.arange(len(row)), n)
            if not len(rep):
                break
            slot = np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n) + self.first[node][rep]
            r, nd = row[rep], slot
            m = masks[r, self.label[slot]]
            e0, e1 = exact[rep], near[rep]
            x0 = (e0 & m) << one
            x1 = ((e1 & m) << one) | e0 | (e0 << one) | (x0 << one)
            x1 |= x0
            limit = (goal[r] << one) - one
            x0, x1 = x0 & limit, x1 & limit
            live = x1 > 0
            row, node, exact, near = r[live], nd[live], x0[live], x1[live]
            hit = np.flatnonzero((self.end[node] >= 0) & ((near & goal[row]) > 0))
            for h in hit.tolist():
                out[tokens[row[h]][0]].append((0 if exact[h] & goal[row[h]] else 1, self.words[self.end[node[h]]]))


class Lexicon:
    """Trusted words with counts, their folds, shapes of number tokens, points after words and counts of other words.

    It may hold a whole small corpus or just the answers that concern one token. ``near`` has, for folds, the trusted
    words one edit away; where it has none, a trie of all folds is searched.
    """

    def __init__(self, words: dict[str, int], shapes: set[str], points: dict[str, int], others: dict[str, tuple[int, int]] | None = None, total: int | None = None, folds: dict[str, list[tuple[int, str]]] | None = None, near: dict[str, list[tuple[int, str]]] | None = None, common: set[str] | None = None) -> None:
        self.words, self.shapes, self.points, self.others = words, shapes, points, others or {}
        self.total = max(1, sum(words.values()) if total is None else total)
        if folds is None:
            folds = {}
            for w in sorted(words, key=lambda w: (-words[w], w)):
                folds.setdefault(fold(w), []).append((words[w], w))
        self.folds, self.near = folds, near
        self.common = {w for w, n in words.items() if n >= COMMON * self.total} if common is None else common
        self._trie: Trie | None = None

    def one_edit(self, folded: str) -> list[tuple[int, str]]:
        """(count, word) of the trusted words whose fold is one edit away."""
        if self.near is not None:
            return self.near.get(folded, [])
        if self._trie is None:
            self._trie = Trie(list(self.folds))
        return [x for d, f in self._trie.within_one([folded])[0] if d for x in self.folds[f]]


def rank(length: int, own: float, candidates: list[tuple[int, str, int]], contexts: list[tuple[float, float]] | None = None) -> str | None:
    """The candidate (distance, word, count) that explains a token of ``length`` letters best; None if none beats the token itself.

    A candidate counts by the logarithm of its count and of how often it stands beside the neighbours
    (``contexts``: counts before and after); an edit costs the less the longer the token, for the fewer right words lie
    that near to another by chance. ``own`` is what the token as it stands has to be beaten at.
    """
    best, top = None, own
    for k, (d, w, n) in enumerate(candidates):
        s = math.log(n) - EDIT * d / length
        if contexts:
            s += 2.0 * (math.log1p(contexts[k][0]) + math.log1p(contexts[k][1]))
        if s > top:
            best, top = w, s
    return best


def own_weight(exact: bool, n: int, digital: int, total: int) -> float:
    """What an untrusted token weighs by itself.

    Against words of the same strokes its count, which may be RATIO times theirs; against words an edit away its count too, but a
    spelling that a text born digital holds is beaten by none.
    """
    if exact:
        return math.log(max(1, n)) - math.log(RATIO)
    return math.log(max(1, total if digital else n))


def trusted(n: int, digital: int, top: int, share: float) -> bool:
    """Whether a word with ``n`` occurrences, ``digital`` of them in texts born digital, is trusted.

    Texts born digital hold no misreadings, so a word seen there as often as its whole count lets expect is trusted
    (``share`` is that of digital words); otherwise it falls to a far more frequent one of the same strokes (``top``).
    Without any digital text only that ratio decides.
    """
    seen = digital >= 2 and digital >= 0.3 * share * n if share > 0 else n * 8 >= top
    return seen and (n * RATIO >= top or digital >= 0.6 * share * n)


def trusted_words(counts: dict[str, tuple[int, int]], share: float) -> dict[str, int]:
    """The words to trust among (count, count in digital texts), held in memory."""
    tops: dict[str, int] = {}
    for w, (n, _) in counts.items():
        f = fold(w)
        tops[f] = max(tops.get(f, 0), n)
    return {w: n for w, (n, d) in counts.items() if trusted(n, d, tops[fold(w)], share)}
