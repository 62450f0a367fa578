"""Abusive, hateful or sexual content: a bidirectional gated recurrent network with attention pooling.

Inputs are words and their character trigrams, both hashed; windows of ``WINDOW`` words overlap by half and all
of them are scored, a document by its highest window. Marks are given for documents, not passages, so the windows
that carry each marked document are chosen first, across two halves of them, and the network fitted on these (numpy, on
the driver, on at most ``MAX_POSITIVE`` + ``MAX_NEGATIVE`` labelled documents). Workers keep the input projections of
distinct words, so a step of the recurrence is one small product.
"""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np

WINDOW, STRIDE = 24, 12
DIM, HIDDEN, BUCKETS = 24, 16, 1 << 14
MAX_POSITIVE, MAX_NEGATIVE = 1000, 6000
#: Characters of the labelled texts together; the sample ends, in hash order, before the text that passes it.
MAX_CHARS = 60_000_000
WORDS_KEPT = 200_000

#: Letters of other scripts and signs that stand for a Latin letter.
_LOOKALIKE = str.maketrans("аеорсухікјѕԁһпαοеνϲ", "aeopcyxikjsdhnaoevc") | str.maketrans("ſ|", "sl")
_LEET = str.maketrans("@$0135478!", "asoiestabi")
_BREAK = re.compile("[-¬‐\u00ad=][^\\S\n]*\n\\s*")
_LETTER, _SIGN = re.compile(r"[^\W\d_]"), re.compile(r"[@$!\d]")
_NO_WORD = re.compile(r"[\W_]+")
_INVISIBLE = re.compile("[\u200b-\u200d\u2060\ufeff\u00ad]")
_MARKS = re.compile("[\u0300-\u036f]")


def normal(raw: str) -> str:
    """A word in lower case without accents, look-alikes, digits for letters and signs; numbers read ``#``; maybe ''."""
    w = raw.lower()
    if not w.isascii():
        w = _MARKS.sub("", unicodedata.normalize("NFKD", _INVISIBLE.sub("", w))).lower().translate(_LOOKALIKE)
    if w.isalpha():
        return w
    w = w.strip(".,;:?!\"'()[]{}<>*_-")
    if w.isalpha():
        return w
    if _SIGN.search(w) and _LETTER.search(w):
        w = w.translate(_LEET)
    w = _NO_WORD.sub("", w)
    return "#" if w.isdigit() else w


def raw_words(text: str | None) -> list[str]:
    """A text cut at white space, words broken at line ends joined; null gives none."""
    if not text:
        return []
    return (_BREAK.sub("", text) if "\n" in text else text).split()


def features(word: str) -> list[int]:
    """Hash buckets of a word and of its character trigrams."""
    marked = f"<{word}>"
    grams = [marked[i : i + 3] for i in range(max(1, len(marked) - 2))]
    return [zlib.crc32(marked.encode()) % BUCKETS, *(BUCKETS + zlib.crc32(g.encode()) % BUCKETS for g in grams)]


def window_starts(n: int) -> list[int]:
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class Lexicon:
    """Distinct words as rows; row 0 stands for no word. Spellings of one word share its row."""

    def __init__(self) -> None:
        self.raw: dict[str, int] = {}
        self.row: dict[str, int] = {}
        self.names: list[str] = [""]
        self.flat: list[list[int]] = []
        self.single = np.zeros(1024, bool)

    def _add(self, word: str) -> int:
        if not word:
            return 0
        r = self.row.get(word)
        if r is None:
            r = self.row[word] = len(self.row) + 1
            self.names.append(word)
            self.flat.append(features(word))
            if r >= len(self.single):
                self.single = np.concatenate([self.single, np.zeros(len(self.single), bool)])
            self.single[r] = len(word) == 1 and word != "#"
        return r

    def learn(self, split: list[list[str]]) -> None:
        """Rows for all new spellings of a batch."""
        for w in set().union(*split) - self.raw.keys() if split else ():
            self.raw[w] = self._add(normal(w))

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [raw_words(t) for t in texts]
        self.learn(split)
        return [self.ids(t) for t in split]

    def ids(self, tokens: list[str]) -> np.ndarray:
        """The rows of learned words; three or more single letters in a row are read as one word."""
        out = np.fromiter(map(self.raw.__getitem__, tokens), np.int64, len(tokens))
        out = out[out > 0]
        one = self.single[out]
        if one.sum() >= 3:
            edge = np.flatnonzero(np.diff(np.concatenate([[0], one.astype(np.int8), [0]])))
            runs = [(i, j) for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()) if j - i >= 3]
            if runs:
                parts, last = [], 0
                for i, j in runs:
                    parts += [out[last:i], [self._add("".join(self.names[k] for k in out[i:j]))]]
                    last = j
                out = np.concatenate([*parts, out[last:]]).astype(np.int64)
        return out


def windows_of(ids: np.ndarray) -> np.ndarray:
    """All overlapping windows of a document as rows of word numbers, padded with 0."""
    if len(ids) < WINDOW:
        ids = np.concatenate([ids, np.zeros(WINDOW - len(ids), np.int64)])
    starts = np.asarray(window_starts(len(ids)))
    return ids[starts[:, None] + np.arange(WINDOW)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Network:
    """Parameters with forward pass, gradients and Adam steps."""

    NAMES = ("emb", "wf", "uf", "bf", "wb", "ub", "bb", "wa", "va", "wo", "bo")

    def __init__(self, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) * (1.0 / np.sqrt(s[0]))).astype(np.float32)
        self.p = {
            "emb": (r.standard_normal((2 * BUCKETS, DIM)) * 0.3).astype(np.float32),
            "wf": g(DIM, 3 * HIDDEN), "uf": g(HIDDEN, 3 * HIDDEN), "bf": np.zeros(3 * HIDDEN, np.float32),
            "wb": g(DIM, 3 * HIDDEN), "ub": g(HIDDEN, 3 * HIDDEN), "bb": np.zeros(3 * HIDDEN, np.float32),
            "wa": g(2 * HIDDEN, HIDDEN), "va": g(HIDDEN, 1)[:, 0], "wo": g(2 * HIDDEN, 1)[:, 0], "bo": np.full(1, -1.0, np.float32),
        }
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    @staticmethod
    def bag(flat: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.array([len(f) for f in flat])
        return np.concatenate([np.asarray(f) for f in flat]), np.concatenate([[0], np.cumsum(n)[:-1]]), (1.0 / np.sqrt(n)).astype(np.float32)

    def embed(self, flat: list[list[int]]) -> np.ndarray:
        if not flat:
            return np.zeros((0, DIM), np.float32)
        idx, start, scale = self.bag(flat)
        return np.add.reduceat(self.p["emb"][idx], start, axis=0) * scale[:, None]

    @staticmethod
    def _run(xw: np.ndarray, u: np.ndarray, mask: np.ndarray, keep: bool):
        """One direction over time-major projections (T, B, 3H)."""
        T, B, _ = xw.shape
        H = HIDDEN
        h = np.zeros((B, H), np.float32)
        hs, saved = np.empty((T, B, H), np.float32), []
        for t in range(T):
            hu = h @ u
            zr = _sigmoid(xw[t, :, : 2 * H] + hu[:, : 2 * H])
            z, r = zr[:, :H], zr[:, H:]
            n = np.tanh(xw[t, :, 2 * H :] + r * hu[:, 2 * H :])
            new = h + mask[t] * (1.0 - z) * (n - h)
            if keep:
                saved.append((h, z, r, n, hu[:, 2 * H :]))
            h = hs[t] = new
        return hs, saved

    def forward(self, win: np.ndarray, proj_f: np.ndarray, proj_b: np.ndarray, keep: bool = False):
        """Probabilities of windows; ``proj_*`` are the projected inputs of each word, row 0 for no word."""
        p = self.p
        w = np.ascontiguousarray(win.T)
        mask = (w > 0).astype(np.float32)[:, :, None]
        hf, sf = self._run(proj_f[w], p["uf"], mask, keep)
        hb, sb = self._run(proj_b[w[::-1]], p["ub"], mask[::-1], keep)
        h = np.concatenate([hf, hb[::-1]], axis=2)
        a = np.tanh(h @ p["wa"])
        s = np.where(mask[:, :, 0] > 0, a @ p["va"], -1e9)
        s[0] = np.where(mask[:, :, 0].any(axis=0), s[0], 0.0)
        e = np.exp(s - s.max(axis=0))
        alpha = (e / e.sum(axis=0)).astype(np.float32)
        pooled = np.einsum("tb,tbh->bh", alpha, h)
        prob = _sigmoid(pooled @ p["wo"] + p["bo"][0])
        return (prob, (w, mask, h, a, alpha, pooled, sf, sb)) if keep else prob

    def project(self, emb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, zero = self.p, np.zeros((1, 3 * HIDDEN), np.float32)
        return np.concatenate([zero, emb @ p["wf"] + p["bf"]]), np.concatenate([zero, emb @ p["wb"] + p["bb"]])

    def _back(self, dh_all: np.ndarray, saved: list, u: np.ndarray, mask: np.ndarray):
        T, B, H = dh_all.shape
        dx, du, dh = np.empty((T, B, 3 * H), np.float32), np.zeros_like(u), np.zeros((B, H), np.float32)
        for t in range(T - 1, -1, -1):
            h, z, r, n, hn = saved[t]
            g = dh + dh_all[t]
            gm = g * mask[t]
            dn = gm * (1.0 - z) * (1.0 - n * n)
            dz = -gm * (n - h) * z * (1.0 - z)
            dr = dn * hn * r * (1.0 - r)
            dx[t, :, :H], dx[t, :, H : 2 * H], dx[t, :, 2 * H :] = dz, dr, dn
            dhu = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ dhu
            dh = g - gm * (1.0 - z) + dhu @ u.T
        return dx, du

    def step(self, win: np.ndarray, y: np.ndarray, weight: np.ndarray, flat: list[list[int]], rate: float) -> float:
        """One Adam step on a batch; ``win`` holds word numbers into ``flat`` (1-based)."""
        p = self.p
        used, local = np.unique(win, return_inverse=True)
        local = local.reshape(win.shape)
        rows = used[used > 0]
        shift = 1 - int(used[0] == 0)
        local = local + shift
        idx, start, scale = self.bag([flat[i - 1] for i in rows])
        emb = np.add.reduceat(p["emb"][idx], start, axis=0) * scale[:, None]
        pf, pb = self.project(emb)
        prob, (w, mask, h, a, alpha, pooled, sf, sb) = self.forward(local, pf, pb, keep=True)
        d = ((prob - y) * weight / weight.sum()).astype(np.float32)
        grad = {"wo": pooled.T @ d, "bo": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * p["wo"]
        dalpha = np.einsum("bh,tbh->tb", dpool, h)
        dh = alpha[:, :, None] * dpool[None]
        ds = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        grad["va"] = np.einsum("tb,tbk->k", ds, a)
        da = ds[:, :, None] * p["va"] * (1.0 - a * a)
        grad["wa"] = np.einsum("tbh,tbk->hk", h, da)
        dh += da @ p["wa"].T
        dxf, grad["uf"] = self._back(np.ascontiguousarray(dh[:, :, :HIDDEN]), sf, p["uf"], mask)
        dxb, grad["ub"] = self._back(np.ascontiguousarray(dh[::-1, :, HIDDEN:]), sb, p["ub"], mask[::-1])
        demb = np.zeros_like(emb)
        for dx, order, wn, un in ((dxf, w, "wf", "bf"), (dxb, w[::-1], "wb", "bb")):
            at, g = order.reshape(-1), dx.reshape(-1, 3 * HIDDEN)
            o = np.argsort(at, kind="stable")
            ids, first = np.unique(at[o], return_index=True)
            per = np.add.reduceat(g[o], first, axis=0)
            per, ids = per[ids > 0], ids[ids > 0] - 1
            grad[wn], grad[un] = emb[ids].T @ per, per.sum(axis=0)
            demb[ids] += per @ p[wn].T
        gi = np.repeat(demb * scale[:, None], np.diff(np.append(start, len(idx))), axis=0)
        o = np.argsort(idx, kind="stable")
        ids, first = np.unique(idx[o], return_index=True)
        self.t += 1
        c1, c2 = 1 - 0.9**self.t, 1 - 0.999**self.t
        self._adam("emb", np.add.reduceat(gi[o], first, axis=0), rate, c1, c2, ids)
        for k, g in grad.items():
            self._adam(k, g, rate, c1, c2)
        return float(-(weight * (y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7))).sum() / weight.sum())

    def _adam(self, k: str, g: np.ndarray, rate: float, c1: float, c2: float, rows: np.ndarray | None = None) -> None:
        at = slice(None) if rows is None else rows
        m = self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * g
        v = self.v[k][at] = 0.999 * self.v[k][at] + 0.001 * g * g
        self.p[k][at] -= (rate * (m / c1) / (np.sqrt(v / c2) + 1e-7)).astype(np.float32)


class Scorer:
    """Scores documents with a trained network, keeping the projections of distinct words.

    The gates are read as (1 + tanh(x / 2)) / 2 with the halves folded into the weights, in buffers used again.
    """

    def __init__(self, params: dict[str, np.ndarray]) -> None:
        self.net = Network.__new__(Network)
        self.net.p = params
        half = np.ones(3 * HIDDEN, np.float32)
        half[: 2 * HIDDEN] = 0.5
        self.half = half
        self.uf, self.ub = params["uf"] * half, params["ub"] * half
        self._clear()

    def _clear(self) -> None:
        self.lex, self.done = Lexicon(), 0
        self.pf = self.pb = np.zeros((1, 3 * HIDDEN), np.float32)

    def _ready(self) -> None:
        if self.done < len(self.lex.flat):
            f, b = self.net.project(self.net.embed(self.lex.flat[self.done :]))
            self.pf, self.pb = np.concatenate([self.pf, f[1:] * self.half]), np.concatenate([self.pb, b[1:] * self.half])
            self.lex.flat[self.done :] = [None] * (len(self.lex.flat) - self.done)
            self.done = len(self.lex.flat)

    def learned(self, flat: list[list[int]]) -> None:
        """Projections for given words, for windows whose rows they are."""
        f, b = self.net.project(self.net.embed(flat))
        self.pf, self.pb = f * self.half, b * self.half
        self.pf[0] = self.pb[0] = 0.0

    @staticmethod
    def _run(proj: np.ndarray, u: np.ndarray, w: np.ndarray, mask: np.ndarray | None, out: np.ndarray) -> None:
        T, B = w.shape
        H = HIDDEN
        h, hu, x, zr, n = np.zeros((B, H), np.float32), np.empty((B, 3 * H), np.float32), np.empty((B, 3 * H), np.float32), np.empty((B, 2 * H), np.float32), np.empty((B, H), np.float32)
        for t in range(T):
            np.matmul(h, u, out=hu)
            np.take(proj, w[t], axis=0, out=x, mode="clip")
            np.add(x[:, : 2 * H], hu[:, : 2 * H], out=zr)
            np.tanh(zr, out=zr)
            zr += 1.0
            zr *= 0.5
            np.multiply(zr[:, H:], hu[:, 2 * H :], out=n)
            n += x[:, 2 * H :]
            np.tanh(n, out=n)
            new = h if mask is None else h.copy()
            new -= n
            new *= zr[:, :H]
            new += n
            h = new if mask is None else np.where(mask[t], new, h)
            out[t] = h

    def _score(self, win: np.ndarray) -> np.ndarray:
        p = self.net.p
        w = np.ascontiguousarray(win.T)
        full = bool((w > 0).all())
        mask = None if full else (w > 0)[:, :, None]
        h = np.empty((*w.shape, 2 * HIDDEN), np.float32)
        self._run(self.pf, self.uf, w, mask, h[:, :, :HIDDEN])
        self._run(self.pb, self.ub, w[::-1], None if full else mask[::-1], h[::-1, :, HIDDEN:])
        s = np.tanh(h.reshape(-1, 2 * HIDDEN) @ p["wa"]) @ p["va"]
        s = s.reshape(w.shape)
        if not full:
            s = np.where(w > 0, s, np.float32(-1e9))
        e = np.exp(s - s.max(axis=0))
        e /= e.sum(axis=0)
        v = (h.reshape(-1, 2 * HIDDEN) @ p["wo"]).reshape(w.shape)
        return _sigmoid((e * v).sum(axis=0) + p["bo"][0])

    def windows(self, win: np.ndarray, batch: int = 1024) -> np.ndarray:
        """Probabilities of windows; padded ones are scored apart from full ones."""
        out = np.zeros(len(win), np.float32)
        whole = (win > 0).all(axis=1)
        for rows in (np.flatnonzero(whole), np.flatnonzero(~whole)):
            for i in range(0, len(rows), batch):
                out[rows[i : i + batch]] = self._score(win[rows[i : i + batch]])
        return out

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """The highest window score of each text; texts without a word score 0."""
        if len(self.lex.raw) > WORDS_KEPT:
            self._clear()
        ids = self.lex.batch(texts)
        self._ready()
        parts = [windows_of(i) if len(i) else np.zeros((0, WINDOW), np.int64) for i in ids]
        n = np.array([len(x) for x in parts])
        out = np.zeros(len(texts))
        if n.sum():
            prob = self.windows(np.concatenate(parts))
            has = np.flatnonzero(n)
            out[has] = np.maximum.reduceat(prob, np.concatenate([[0], np.cumsum(n)[:-1]])[has])
        return out


def _first_choice(docs: list[np.ndarray], win: np.ndarray, own: np.ndarray, y: np.ndarray, part: np.ndarray, size: int) -> np.ndarray:
    """A score of each window to start from: the four words most telling of marked documents.

    Words are counted by documents, the window's own left out, so a name that only one marked document holds tells nothing.
    """
    pos, neg = np.zeros(size), np.zeros(size)
    for k in np.flatnonzero(part):
        (pos if y[k] else neg)[np.unique(docs[k])] += 1
    n_pos, n_neg = max(1, (y[part] == 1).sum()), max(1, (y[part] == 0).sum())
    odds = lambda p: np.log((p + 0.05) / n_pos) - np.log((neg + 0.5) / n_neg)
    mine = np.where((y[own] == 1)[:, None], odds(np.maximum(pos - 1, 0))[win], odds(pos)[win])
    mine[win == 0] = 0.0
    return np.sort(mine, axis=1)[:, -4:].sum(axis=1)


def train(texts: list[str | None], marks: list[int], epochs: int = 10, seed: int = 7) -> tuple[dict[str, np.ndarray], float]:
    """Parameters and the threshold of the document score, from labelled documents.

    A fifth of the documents is held back from the fit to set the threshold. Without a positive and a negative mark
    nothing can be learned: every score is then 0 and the threshold 1.
    """
    lex = Lexicon()
    y = np.asarray(marks)
    docs = lex.batch(texts)
    keep = np.array([len(d) > 0 for d in docs], bool)
    docs, y = [d for d, k in zip(docs, keep) if k], y[keep] if len(y) else y
    if not len(y) or y.min() == y.max():
        return {}, 1.0
    parts = [windows_of(d) for d in docs]
    own = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    win = np.concatenate(parts)
    held = np.zeros(len(docs), bool)
    held[np.random.default_rng(seed).permutation(len(docs))[: len(docs) // 5]] = True
    if y[~held].max() == 0 or y[held].sum() < 3:
        held[:] = False
    top = _first_choice(docs, win, own, y, ~held, len(lex.row) + 1)
    net = _fit(win, own, y, ~held, top, lex.flat, epochs, seed)
    if not held.any():
        return net.p, 0.5
    fast = Scorer(net.p)
    fast.learned(lex.flat)
    rest = np.flatnonzero(held[own])
    score = np.zeros(len(docs))
    np.maximum.at(score, own[rest], fast.windows(win[rest]))
    return net.p, _best_threshold(score[held], y[held])


def _best_threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The middle of the range of thresholds with the best F1, between 0.2 and 0.97."""
    cuts = np.linspace(0.2, 0.97, 78)
    f1 = np.array([2 * ((score >= c) & (y == 1)).sum() / max(1, (score >= c).sum() + (y == 1).sum()) for c in cuts])
    best = cuts[f1 >= f1.max() - 1e-9]
    return float(best[len(best) // 2])


def _epoch(net: Network, win, flat, pos: np.ndarray, neg: np.ndarray, rate: float, rng) -> None:
    """One pass over positive and negative windows, the positives weighing about half as much as the negatives together."""
    rows = np.concatenate([pos, neg])
    lab = np.concatenate([np.ones(len(pos)), np.zeros(len(neg))]).astype(np.float32)
    wgt = np.where(lab == 1, max(1.0, 0.35 * len(neg) / max(1, len(pos))), 1.0).astype(np.float32)
    order = rng.permutation(len(rows))
    for i in range(0, len(order), 256):
        o = order[i : i + 256]
        net.step(win[rows[o]], lab[o], wgt[o], flat, rate)


def _score(net: Network, flat, win: np.ndarray) -> np.ndarray:
    fast = Scorer(net.p)
    fast.learned(flat)
    return fast.windows(win)


def _best_of(score: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    best = np.full(n, -np.inf)
    np.maximum.at(best, own, score)
    return best[own]


def _fit(win, own, y, part, top, flat, epochs, seed) -> Network:
    """The network for the documents of ``part``.

    The windows that carry each marked document are chosen by networks fitted on the other half of the marked
    documents, so none confirms what it has only learned by heart; the last network is fitted on these windows, with
    the unmarked windows it errs on looked up anew every second epoch.
    """
    rng = np.random.default_rng(seed)
    inside = part[own]
    pos_w, neg_w = np.flatnonzero(inside & (y[own] == 1)), np.flatnonzero(inside & (y[own] == 0))
    first = pos_w[top[pos_w] >= _best_of(top[pos_w], own[pos_w], len(y))]
    fold = rng.integers(0, 2, len(y))
    score = np.zeros(len(own))
    n_neg = min(len(neg_w), max(3000, 12 * len(first)))
    for k in (0, 1):
        half, net = first[fold[own[first]] == k], Network(seed + 1 + k)
        if not len(half):
            half = first
        for _ in range(3):
            _epoch(net, win, flat, half, rng.choice(neg_w, n_neg, replace=False), 0.004, rng)
        rest = pos_w[fold[own[pos_w]] != k]
        if len(rest):
            score[rest] = _score(net, flat, win[rest])
    chosen = pos_w[(score[pos_w] > 0.5) | (score[pos_w] >= _best_of(score[pos_w], own[pos_w], len(y)))]
    net, hard = Network(seed), neg_w[:0]
    for k in range(epochs):
        if k and k % 2 == 0:
            s = _score(net, flat, win[neg_w])
            hard = neg_w[np.argsort(-s, kind="stable")[: 2 * len(chosen) + 200]]
        _epoch(net, win, flat, chosen, np.concatenate([hard, rng.choice(neg_w, n_neg, replace=False)]), 0.004 if k < epochs - 2 else 0.0015, rng)
    return net
