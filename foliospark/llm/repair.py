"""Noise in text from scanned pages: misread words, words broken at line ends, page furniture; and readable paragraphs.

Statistics over the whole corpus come first: words (with how often they occur in texts born digital), shapes of
number tokens, points after words, pairs of neighbours, and short lines beside page numbers. A token that is no
trusted word is looked up with all words of the same strokes or one edit away (``lexicon``) and is misread when one of
these outranks it, by itself or beside its neighbours; runs and parts of tokens are tried where spaces were lost or
added. Lines that stand outside the flow of the text are furniture when they are page numbers, rules, titles, or lines
that stand beside page numbers throughout the corpus.

Nothing here holds the corpus's words. ``TypeJudge`` judges a token by the answers to its own questions, ``Reader`` a
text by the verdicts on its tokens and the answers to what it asks; ``scans`` has the questions answered by joins.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash

from .lexicon import EDGE, LONGEST, Lexicon, fold, own_weight, rank, shape, trusted_words

HYPHEN = re.compile("[-¬‐­=]$")
_ENDED = re.compile(r"[.!?:…][\"'”»)]*$")
_RULE = re.compile(r"^[\s_\-–—=~*·.]{5,}$")
_BROKEN = re.compile("\\w[-¬‐\u00ad=]$")
_DIGIT = re.compile(r"\d")
_NUM = r"(?:[0-9OolIi|ſSsBgZäjJ]{1,4}|[ivxlj1I|]{1,5})"
_BARE = re.compile(rf"^{_NUM}$")
_DECORATED = re.compile(rf"^(?:[-–—]\s*{_NUM}\s*[-–—]|[\[(]\s*{_NUM}\s*[\])]|{_NUM}\s*/\s*{_NUM}|\S{{1,9}}\s{{1,2}}{_NUM}(?:\s+\S{{1,4}}\s+{_NUM})?)$")
_WIDE = re.compile(rf"^(?:({_NUM})\s{{3,}}(\S.{{0,79}})|(\S.{{0,79}}?)\s{{3,}}({_NUM}))$")
#: Glyphs taken for digits inside numbers.
_AS_DIGIT = str.maketrans({"O": "0", "o": "0", "l": "1", "I": "1", "|": "1", "i": "1", "j": "1", "S": "5", "s": "5", "ſ": "5", "B": "8", "g": "9", "q": "9", "Z": "2", "z": "2"})
_AS_LETTER = str.maketrans({"0": "O", "1": "I", "5": "S", "8": "B", "9": "g", "2": "Z", "6": "G", "|": "I", "l": "I"})
FINE, MISREAD, UNKNOWN, NEAR = 0, 1, 2, 3  # NEAR: unknown, and misread if its neighbours speak for one of its candidates
#: ``(code, own weight, [(distance, word, count)])`` of a token.
Verdict = tuple[int, float, list[tuple[int, str, int]]]
_FINE: Verdict = (FINE, 0.0, [])
_ALWAYS = float("-inf")


def core(token: str) -> str:
    return token.strip(EDGE).lower()


_MIX_BEFORE, _MIX_AFTER, _MASK = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, (1 << 64) - 1


def word_hash(word: str) -> int:
    """An even number, so that a bit is free."""
    return xxhash.xxh64_intdigest(word) & ~1


def pair_key(before: str, after: str) -> int:
    b = word_hash(after)
    k = (word_hash(before) * _MIX_BEFORE + (b ^ (b >> 29)) * _MIX_AFTER) & _MASK
    return k - (1 << 64) if k >> 63 else k


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """``pair_key`` of arrays of word hashes."""
    return (before * np.uint64(_MIX_BEFORE) + (after ^ (after >> np.uint64(29))) * np.uint64(_MIX_AFTER)).view(np.int64)


def flow_width(lines: list[str]) -> int:
    """The width the text was wrapped at."""
    full = sorted(len(x.rstrip()) for x in lines if x.strip())
    return full[int(0.9 * (len(full) - 1))] if full else 0


def outside_flow(lines: list[str]) -> list[int]:
    """Lines that end early without ending a sentence (the next line's first word would have fitted), and lines that
    by their place at a page's edge or their form may be furniture though they are long."""
    width, out = flow_width(lines), []
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            continue
        nxt = lines[i + 1] if i + 1 < len(lines) else ""
        word = nxt.split(None, 1)
        room = len(line.rstrip()) + 1 + (len(word[0]) if word else 0)
        if _RULE.match(s) or len(s) <= 8 and is_page_number(s) or _WIDE.match(s):
            out.append(i)
        elif _ENDED.search(s) or _BROKEN.search(s):
            continue
        elif room <= width - 3 or len(s) <= 8 or line[0] == "\x0c" or nxt[:1] == "\x0c" or len(s) < 60 and (_RULE.match(nxt.strip()) or i and is_page_number(lines[i - 1].strip()) or is_page_number(nxt.strip())):
            out.append(i)
    return out


def is_page_number(s: str) -> bool:
    return bool(_BARE.match(s)) or bool(_DECORATED.match(s)) and (bool(_DIGIT.search(s)) or len(s) <= 12)


def _is_title(s: str) -> bool:
    """Several words, the longer ones capitalised, no point at the end."""
    words = s.split()
    if not 2 <= len(words) <= 8 or s[-1] in ".,;:!?" or not s[0].isalnum():
        return False
    long = [w for w in words if len(w.strip(EDGE)) > 4]
    return bool(long) and len(s) < 60 and all(w[0].isupper() or w[0].isdigit() or not w[0].isalpha() for w in long) and words[0][0].isupper() | words[0][0].isdigit() and sum(c.isalpha() for c in s) >= 0.6 * len(s.replace(" ", ""))


class TypeJudge:
    """Judges tokens by themselves, with the words of a lexicon."""

    def __init__(self, lexicon: Lexicon, pairs: dict[int, int]) -> None:
        self.lex, self.pairs = lexicon, pairs

    def verdict(self, t: str) -> Verdict:
        c, lex = core(t), self.lex
        if not c:
            return (MISREAD, _ALWAYS, []) if t in ("|", "�") else _FINE
        if c in lex.words:
            return (MISREAD, _ALWAYS, []) if self._wrong_point(t, c) else _FINE
        if is_number(c):
            return self._number(t, c)
        if not (c.isalpha() or "|" in c or "�" in c):
            parts = _parts(c)
            if not parts or not any(ch.isalpha() for ch in c):
                return _FINE
            if all(p in lex.words or len(p) == 1 for p in parts):
                inner = re.search(r"\w[.,;:!?]+\w", c)
                return (MISREAD, _ALWAYS, []) if inner and all(len(p) > 2 for p in parts) else _FINE
        if len(c) > LONGEST:
            return (UNKNOWN, 0.0, [])
        f = fold(c)
        options = [(0, w, n) for n, w in lex.folds.get(f, ())] or [(1, w, n) for n, w in lex.one_edit(f)]
        n, digital = lex.others.get(c, (1, 0))
        own = own_weight(bool(options) and options[0][0] == 0, n, digital, lex.total)
        if options and rank(len(c), own, options):
            return (MISREAD, own, options)
        split = self._run_together(c)
        if split:
            return (MISREAD, _ALWAYS, [(1, split, 1)])
        return (NEAR, own, options) if options else (UNKNOWN, 0.0, [])

    def _wrong_point(self, t: str, c: str) -> bool:
        """A comma that hardly ever follows this word where another point mostly does."""
        if t[-1] != "," or not t[:-1].lower().endswith(c):
            return False
        points = self.lex.points
        return wrong_comma(points.get(c + ",", 0), max((points.get(c + p, 0) for p in ".;:"), default=0))

    def _number(self, t: str, c: str) -> Verdict:
        lex = self.lex
        letters = sum(ch.isalpha() for ch in c)
        raw = t.strip(EDGE)
        if len(raw) > 24:
            return (UNKNOWN, 0.0, [])
        if shape(raw) in lex.shapes:
            return _FINE
        if letters:
            f = fold(c)
            if f in lex.folds and (letters >= 2 or len(c) <= 3):
                return (MISREAD, _ALWAYS, [(0, w, n) for n, w in lex.folds[f]])
            m = _stuck(c)
            if m and (m[0] in lex.words or m[1] in lex.words):
                return (MISREAD, _ALWAYS, [])
            split = self._run_together(c) if letters > len(c) / 2 else None
            if split:
                return (MISREAD, _ALWAYS, [(1, split, 1)])
        return (MISREAD, _ALWAYS, []) if any(x in lex.shapes for x in _other_shapes(raw)) else (UNKNOWN, 0.0, [])

    def _word(self, p: str) -> bool:
        return p in self.lex.words or len(p) > 2 and fold(p) in self.lex.folds

    def _run_together(self, c: str) -> str | None:
        """Two words without the space between them."""
        lex = self.lex
        for a, b in _splits(c):
            if (a in lex.common if len(a) < 3 else a in lex.words) and (b in lex.common if len(b) < 3 else self._word(b)) or len(a) > 2 and b in lex.words and len(b) > 2 and fold(a) in lex.folds:
                if len(a) >= 4 or len(b) >= 4 or self.pairs.get(pair_key(a, b), 0) >= 3:
                    return f"{a} {b}"
        return None


def is_number(c: str) -> bool:
    return not c.isalpha() and bool(_DIGIT.search(c))


def wrong_comma(n: int, other: int) -> bool:
    return other >= 20 and other >= 25 * max(1, n)


def _parts(c: str) -> list[str]:
    return [p for p in re.split(r"[-'’/.,;:!?()]+", c) if p]


def _stuck(c: str) -> tuple[str, str] | None:
    """A number and a word without the space between them."""
    m = re.fullmatch(r"([\d.,-]+)([^\W\d]{3,})", c) or re.fullmatch(r"([^\W\d]{3,})([\d.,-]+)", c)
    return (m[1], m[2]) if m else None


def _splits(c: str) -> list[tuple[str, str]]:
    return [(c[:i], c[i:]) for i in range(1, len(c))] if 4 <= len(c) <= LONGEST else []


def _other_shapes(raw: str) -> list[str]:
    """The shapes a number token would have with one glyph, or all of a kind, read the other way."""
    out = [shape(raw.replace(",", "."))] if "," in raw else []
    for table in (_AS_DIGIT, _AS_LETTER):
        out += [shape(raw[:i] + table[ord(ch)] + raw[i + 1 :]) for i, ch in enumerate(raw) if ord(ch) in table]
        if raw.translate(table) != raw:
            out.append(shape(raw.translate(table)))
    return out


def type_questions(t: str, common: set[str]) -> set[tuple[str, str | None, int | None]]:
    """What ``TypeJudge.verdict`` needs to know of a token that is no trusted word: (kind, key, pair).

    Kinds: w word, f words of a fold, n words one edit from a fold, o count of the token itself, s shape, b pair.
    """
    c = core(t)
    out: set[tuple[str, str | None, int | None]] = set()
    number = is_number(c)
    splits = not number
    if number:
        letters, raw = sum(ch.isalpha() for ch in c), t.strip(EDGE)
        out |= {("s", x, None) for x in _other_shapes(raw)}
        if letters:
            out.add(("f", fold(c), None))
            out |= {("w", x, None) for x in _stuck(c) or ()}
            splits = letters > len(c) / 2
    else:
        f = fold(c)
        out |= {("f", f, None), ("n", f, None), ("o", c, None)}
        if not c.isalpha():
            out |= {("w", p, None) for p in _parts(c) if len(p) > 1}
    for a, b in _splits(c) if splits else ():
        if len(a) < 3 and a not in common or len(b) < 3 and b not in common:
            continue
        for x in (a, b):
            if len(x) > 2:
                out |= {("w", x, None), ("f", fold(x), None)}
        if len(a) < 4 and len(b) < 4:
            out.add(("b", None, pair_key(a, b)))
    return out


class _Verdicts(dict):
    """Verdicts from a lexicon in memory, one token at a time."""

    def __init__(self, judge: TypeJudge) -> None:
        super().__init__()
        self.judge = judge

    def get(self, t, default=None):
        if t not in self:
            self[t] = self.judge.verdict(t)
        return self[t]


class Reader:
    """Judges lines with the verdicts on their tokens and the answers to its questions.

    ``words`` has the counts of trusted words, ``folds`` the most frequent one of a fold, ``pairs`` counts by pair key. With
    ``asked`` set, every look-up is noted there as (kind, key, pair); a run with no answers asks for all that any run needs.
    """

    def __init__(self, verdicts: dict[str, Verdict], words: dict[str, int], folds: dict[str, str], pairs: dict[int, int], footers: set[str], asked: set | None = None) -> None:
        self.verdicts, self.words, self.folds, self.pairs, self.footers, self.asked = verdicts, words, folds, pairs, footers, asked

    @classmethod
    def of(cls, lexicon: Lexicon, pairs: dict[tuple[str, str], int], footers: set[str]) -> Reader:
        """A reader for a lexicon in memory."""
        known = {pair_key(a, b): n for (a, b), n in pairs.items()}
        return cls(_Verdicts(TypeJudge(lexicon, known)), lexicon.words, {f: ws[0][1] for f, ws in lexicon.folds.items()}, known, footers)

    def _word(self, w: str) -> int:
        if self.asked is not None:
            self.asked.add(("w", w, None))
        return self.words.get(w, 0)

    def _fold(self, w: str) -> str | None:
        f = fold(w)
        if self.asked is not None:
            self.asked.add(("f", f, None))
        return self.folds.get(f)

    def _pair(self, a: str | None, b: str | None) -> int:
        if a is None or b is None:
            return 0
        k = pair_key(a, b)
        if self.asked is not None:
            self.asked.add(("b", None, k))
        return self.pairs.get(k, 0)

    def _code(self, t: str) -> int:
        return self.verdicts.get(t, _FINE)[0]

    def best(self, t: str, before: str | None, after: str | None) -> str | None:
        """The candidate that outranks a token beside the words ``before`` and ``after`` it; None if none does."""
        code, own, options = self.verdicts.get(t, _FINE)
        if not options:
            return None
        left = core(before) if before and before[-1] not in EDGE else None
        right = core(after) if after and t[-1] not in EDGE else None
        contexts = None
        if code == NEAR or len(options) > 1:
            contexts = [(self._pair(left, w), self._pair(w, right)) for _, w, _ in options]
        return rank(len(core(t)), own, options, contexts)

    # lines

    def furniture(self, lines: list[str], out: list[int] | None = None) -> set[int]:
        """The lines that are page furniture."""
        odd = outside_flow(lines) if out is None else out
        if not odd:
            return set()
        filled = [i for i, x in enumerate(lines) if x.strip()]
        place = {i: k for k, i in enumerate(filled)}
        found: set[int] = set()
        text = {i: lines[i].strip() for i in odd}
        bare = {i for i in odd if _BARE.match(text[i])}
        limit = max(3, len(filled) // 6)

        def beside(i: int, group) -> bool:
            k = place[i]
            return k > 0 and filled[k - 1] in group or k + 1 < len(filled) and filled[k + 1] in group

        for i in odd:
            s = text[i]
            if _RULE.match(s):
                continue
            if i in bare:
                if i - 1 in bare or i + 1 in bare:  # columns of figures stand in the text
                    continue
                value = "" if re.fullmatch("[ivxl]{1,5}", s) else s.translate(_AS_DIGIT)
                if not value.isdigit() or int(value) <= limit:
                    found.add(i)
            elif _DECORATED.match(s) and (_DIGIT.search(s) or re.match(r"^[-–—\[(]", s)):
                found.add(i)
            else:
                m = _WIDE.match(s)
                if m and sum(ch.isalpha() for ch in (m[2] or m[3])) >= 3:
                    found.add(i)
                elif s[-1] not in ",;:" and fold(s).replace(" ", "") in self.footers:
                    k = place[i]
                    if not self._flows(lines[filled[k - 1]] if k else "", s, lines[filled[k + 1]] if k + 1 < len(filled) else ""):
                        found.add(i)
        first = filled[0]
        for i in odd:
            if i in found or i in bare or _RULE.match(text[i]):
                continue
            s = text[i]
            k = place[i]
            before = lines[filled[k - 1]].strip() if k else ""
            edge = lines[i][0] == "\x0c" or k + 1 < len(filled) and bool(_RULE.match(lines[filled[k + 1]].strip()))
            if not edge and self._flows(before, s, lines[filled[k + 1]] if k + 1 < len(filled) else ""):
                continue
            after = lines[filled[k + 1]].strip() if k + 1 < len(filled) else ""
            opens = i == first and (not after[:1].islower() or is_page_number(after))
            if _is_title(s) and (opens or lines[i][0] == "\x0c" or beside(i, found) or k + 1 < len(filled) and _RULE.match(lines[filled[k + 1]].strip()) or not _DIGIT.search(s) and before and not _ENDED.search(before)) or _is_title(s) and s.isupper():
                found.add(i)
            elif (opens or lines[i][0] == "\x0c") and s[:1].isupper() and len(s.split()) >= 2 and s[-1] not in ".,;:!?" and len(s) < 0.75 * flow_width(lines) and len(filled) > 1 and not any(ch in s for ch in "<>@0123456789"):
                found.add(i)
        titles = {_key(text[i]) for i in found if len(text[i]) > 8}
        for i in odd:
            if i not in found and i not in bare and len(text[i]) > 8 and not _RULE.match(text[i]) and _key(text[i]) in titles:
                found.add(i)
        # rules stand beside furniture; a number in a column of figures may be the page's after all
        for i in odd:
            if _RULE.match(text[i]) and len(set(text[i])) <= 2 and text[i][0] in "_-–—=" and (beside(i, found) or i == first):
                found.add(i)
        last_page = 0
        for i in sorted(found | bare):
            digits = text[i].translate(_AS_DIGIT) if i in bare else ""
            if i in found:
                last_page = int(digits) if digits.isdigit() else last_page + 1 if is_page_number(text[i]) else last_page
            elif digits.isdigit() and int(digits) == last_page + 1 and beside(i, found - bare) and (i - 1 not in bare or i + 1 not in bare):
                found.add(i)
                last_page += 1
        return found

    def _flows(self, before: str, line: str, after: str) -> bool:
        """Whether the words at the line's ends go on from or into the neighbouring lines, as the corpus knows them."""
        words = line.split()
        left, right = before.split(), after.split()
        into = bool(left) and left[-1][-1] not in EDGE and self._pair(core(left[-1]), core(words[0])) >= 3
        onto = bool(right) and words[-1][-1] not in EDGE and self._pair(core(words[-1]), core(right[0])) >= 3
        return into or onto

    def judge(self, text: str, odd: list[int] | None = None) -> list[tuple[int, str]]:
        """``(line_no, kind)`` of a text, whose lines outside the flow may be given."""
        lines = text.split("\n")
        furniture = self.furniture(lines, odd) if len(lines) > 1 else set()
        out = [(i, "furniture") for i in sorted(furniture)]
        rows = [(i, lines[i].split()) for i in range(len(lines)) if i not in furniture]
        rows = [(i, w) for i, w in rows if w]
        skip_first = carried = False
        get = self.verdicts.get
        for k, (i, words) in enumerate(rows):
            codes = [v[0] if (v := get(w)) else FINE for w in words]
            if NEAR in codes:
                before = rows[k - 1][1][-1] if k and not skip_first else None
                after = rows[k + 1][1][0] if k + 1 < len(rows) else None
                for j, code in enumerate(codes):
                    if code == NEAR:
                        better = self.best(words[j], words[j - 1] if j else before, words[j + 1] if j + 1 < len(words) else after)
                        codes[j] = MISREAD if better else UNKNOWN
            bad = carried if skip_first else False
            if skip_first:
                codes[0] = FINE
            carried = False
            last = words[-1]
            if HYPHEN.search(last) and len(last) > 1 and k + 1 < len(rows):
                nxt = rows[k + 1][1][0]
                kind, here, there = self._break(last, nxt)
                if kind:
                    out.append((i, "hyphen"))
                skip_first, carried = True, there
                codes[-1] = FINE
                bad = bad or here
            else:
                skip_first = False
            if not bad:
                bad = MISREAD in codes or UNKNOWN in codes and self._added_space(words, codes)
            if bad:
                out.append((i, "misread"))
        return out

    def _break(self, a: str, b: str) -> tuple[bool, bool, bool]:
        """Whether the hyphen is the line's, and in which half characters are wrong."""
        left = a[:-1]
        if not left[-1:].isalnum() and left[-1:] not in "|�" or not b[:1].isalnum() and b[:1] not in "|�ſ":
            return False, False, False
        whole, kept = core(left + b), core(f"{left}-{b}")
        if b[:1].isdigit() and not any(ch.isalpha() for ch in core(b)):
            return False, False, False
        n_whole, n_kept = self._word(whole), self._word(kept)
        if n_whole:
            return not (n_kept > n_whole and a[-1] == "-"), False, False
        if n_kept:
            return False, False, False
        for w, own in ((self._fold(whole), False), (self._fold(kept), True)):
            if w is not None:
                mine = core(left).lstrip(EDGE)
                return not own, not w.startswith(mine), not w.endswith(core(b))
        parts = [p for p in kept.split("-") if p]
        if len(parts) > 1 and a[-1] == "-" and len(parts[-1]) > 2 and self._code(a) == self._code(b) == FINE:
            return False, False, False
        # an unknown whole: the halves' own words decide on misreadings
        return True, False, False

    def _added_space(self, words: list[str], codes: list[int]) -> bool:
        for j, c in enumerate(codes):
            if c != UNKNOWN:
                continue
            for a, b in ((j - 1, j), (j, j + 1)):
                if a < 0 or b >= len(words) or words[a][-1] in EDGE:
                    continue
                w = core(words[a] + words[b])
                if 3 <= len(w) <= LONGEST and _DIGIT.search(w) is None and (self._word(w) or len(w) >= 5 and self._fold(w) is not None):
                    return True
        return False

    # repair

    def _mend(self, token: str, before: str | None, after: str | None) -> str:
        best = self.best(token, before, after)
        if best is None:
            return token
        c = core(token)
        at = token.lower().find(c)
        body = token[at : at + len(c)]
        if body.isupper() and len(body) > 1:
            best = best.upper()
        elif body[:1].isupper():
            best = best[:1].upper() + best[1:]
        return token[:at] + best + token[at + len(c) :] if at >= 0 else token

    def repaired(self, text: str, odd: list[int] | None = None) -> str:
        """The text in paragraphs: furniture dropped, broken words joined, misread words mended by rank in context."""
        lines = text.split("\n")
        furniture = self.furniture(lines, odd) if len(lines) > 1 else set()
        if self.asked is None:
            return "\n\n".join(self._mended(p) for p in self._paragraphs(lines, furniture) if p)
        for p in self._paragraphs(lines, furniture, True):
            self._mended(p)
        joints: list[tuple[int, int]] = []  # the other way to join a broken word concerns its neighbours alone
        other = self._paragraphs(lines, furniture, False, joints)
        for k, j in joints:
            self._mended(other[k][max(0, j - 2) : j + 3])
        return ""

    def _paragraphs(self, lines: list[str], furniture: set[int], always: bool | None = None, joints: list | None = None) -> list[list[str]]:
        paragraphs: list[list[str]] = [[]]
        broken = False
        after_furniture = False
        for i, line in enumerate(lines):
            if i in furniture:
                after_furniture = True
                continue
            words = line.split()
            if not words:
                # a blank line beside furniture parts pages, not paragraphs, where the sentence goes on
                if paragraphs[-1] and (not after_furniture or _ENDED.search(paragraphs[-1][-1])) and not broken:
                    paragraphs.append([])
                continue
            indent = len(line) - len(line.lstrip())
            if indent >= 2 and paragraphs[-1] and _ENDED.search(paragraphs[-1][-1]):
                paragraphs.append([])
            after_furniture = False
            if broken and paragraphs[-1]:
                left = paragraphs[-1].pop()
                kind, _, _ = self._break(left, words[0])
                words[0] = (left[:-1] if (kind if always is None else always) else left) + words[0]
                if joints is not None:
                    joints.append((len(paragraphs) - 1, len(paragraphs[-1])))
            broken = bool(HYPHEN.search(words[-1])) and len(words[-1]) > 1
            paragraphs[-1] += words
        return paragraphs

    def _mended(self, words: list[str]) -> str:
        """A paragraph's words mended, each beside its neighbours as they stand."""
        codes = [self._code(w) for w in words]
        out, j = [], 0
        while j < len(words):
            w = words[j]
            if j + 1 < len(words) and (codes[j] in (UNKNOWN, NEAR) or codes[j + 1] in (UNKNOWN, NEAR)) and w[-1] not in EDGE and not _DIGIT.search(w) and self._word(core(w + words[j + 1])):
                out.append(w + words[j + 1])
                j += 2
                continue
            out.append(self._mend(w, words[j - 1] if j else None, words[j + 1] if j + 1 < len(words) else None))
            j += 1
        return " ".join(out)


def text_tokens(text: str, mend: bool, odd: list[int] = ()) -> set[str]:
    """The tokens of a text whose verdicts a reader may want; to mend, also broken words joined with the next line, over ``odd`` ones, which may be furniture."""
    out = set(text.split())
    if mend:
        rows = [(i, w) for i, w in enumerate(map(str.split, text.split("\n"))) if w]
        skipped = set(odd)
        for k, (_, words) in enumerate(rows):
            if HYPHEN.search(words[-1]) and len(words[-1]) > 1:
                for i, later in rows[k + 1 :]:
                    out |= {words[-1][:-1] + later[0], words[-1] + later[0]}
                    if i not in skipped:
                        break
    return out


def odd_lines(text: str) -> list[int]:
    lines = text.split("\n")
    return outside_flow(lines) if len(lines) > 1 else []


def line_questions(text: str, odd: list[int]) -> tuple[set[str], set[int]]:
    """What decides on a text's odd lines: the keys looked up among the footers, and the pairs that tell whether they flow on."""
    if not odd:
        return set(), set()
    lines = text.split("\n")
    r = Reader({}, {}, {}, {}, set(), set())
    filled = [i for i, x in enumerate(lines) if x.strip()]
    place = {i: k for k, i in enumerate(filled)}
    for i in odd:
        k = place[i]
        r._flows(lines[filled[k - 1]] if k else "", lines[i], lines[filled[k + 1]] if k + 1 < len(filled) else "")
    own = (lines[i].strip() for i in odd)
    return {fold(s).replace(" ", "") for s in own if _may_be_footer(s)}, {k for _, _, k in r.asked}


def _key(s: str) -> str:
    """A title without page number, case, order of words and confusions."""
    words = [fold(w.strip(EDGE)) for w in s.split() if not _BARE.match(w)]
    return "".join(sorted(w for w in words if len(w) > 2))


# statistics

#: A line is known as a footer when it occurs so often, with this share of it beside page numbers, whatever the corpus's size.
FOOTER_LEAST, FOOTER_BESIDE = 4, 0.4


def _may_be_footer(s: str) -> bool:
    return 9 <= len(s) <= 80 and not _RULE.match(s) and not is_page_number(s) and not _WIDE.match(s)




def count_text(text: str, tokens: Counter, odd_lines: Counter | None) -> None:
    """Adds a text's tokens and, for scanned texts, its short lines with whether a page number stands beside them.

    Halves of words broken at line ends are left out.
    """
    lines = text.split("\n")
    broken = False
    for line in lines:
        words = line.split()
        if not words:
            continue
        here = bool(HYPHEN.search(words[-1])) and len(words[-1]) > 1
        tokens.update(words[int(broken) : len(words) - int(here)] if broken or here else words)
        broken = here
    if odd_lines is None or len(lines) < 2:
        return
    odd = [i for i in outside_flow(lines) if _may_be_footer(lines[i].strip())]
    if odd:
        filled = [i for i, x in enumerate(lines) if x.strip()]
        place = {i: k for k, i in enumerate(filled)}
        for i in odd:
            s = lines[i].strip()
            k = place[i]
            near = k == len(filled) - 1 or lines[filled[k + 1]][0] == "\x0c" or any(is_page_number(lines[filled[j]].strip()) or _WIDE.match(lines[filled[j]].strip()) for j in (k - 1, k + 1) if 0 <= j < len(filled))
            odd_lines[("1" if near else "0") + fold(s).replace(" ", "")] += 1


def statistics(tokens: Counter, digital: int, odd_lines: Counter) -> list[tuple[str, str, int, int]]:
    """Rows ``(kind, key, n, n_digital)``: words w, shapes s, points p, lines l (n_digital: beside a page number)."""
    rows: dict[tuple[str, str], int] = {}

    def add(kind: str, key: str, n: int) -> None:
        rows[kind, key] = rows.get((kind, key), 0) + n

    for t, n in tokens.items():
        c = core(t)
        if not c or len(c) > LONGEST:
            continue
        if _DIGIT.search(c):
            add("s", shape(t.strip(EDGE)), n)
        else:
            add("w", c, n)
            if t[-1] in ".,;:" and t[:-1].lower().endswith(c):
                add("p", c + t[-1], n)
    out = [(k, key, n, n if digital else 0) for (k, key), n in rows.items()]
    return out + [("l", key[1:], n, n if key[0] == "1" else 0) for key, n in odd_lines.items()]


def pair_counts(texts: list[str | None], memory: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the words that follow one another within a line, without a point or number between; ``memory`` keeps hashes of tokens."""
    parts = []
    for text in texts:
        if not text:
            continue
        tokens = text.replace("\n", " \0 ").split()  # no pair over a line's end
        for t in set(tokens):
            if t not in memory:
                c = core(t)
                h = word_hash(c) if c and c != "\0" and len(c) <= LONGEST and not _DIGIT.search(c) else 0
                memory[t] = h | (t[-1] in EDGE) if h else 0  # odd: a point follows, so nothing is paired with it
        ids = np.fromiter(map(memory.__getitem__, tokens), np.uint64, len(tokens))
        point, ids = ids & np.uint64(1), ids & ~np.uint64(1)
        ok = (ids[:-1] > 0) & (ids[1:] > 0) & (point[:-1] == 0)
        parts.append(pair_keys(ids[:-1][ok], ids[1:][ok]))
    return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.int64), np.empty(0, np.int64))


def build(rows) -> tuple[Lexicon, set[str]]:
    """The lexicon and the footers from summed statistics rows, in memory."""
    by: dict[str, dict[str, tuple[int, int]]] = {"w": {}, "s": {}, "p": {}, "l": {}}
    for kind, key, n, dig in rows:
        by[kind][key] = (n, dig)
    total, dig = sum(n for n, _ in by["w"].values()), sum(d for _, d in by["w"].values())
    share = dig / total if total else 0.0
    shapes = {k for k, (n, d) in by["s"].items() if (d >= 2 and d >= 0.3 * share * n if share else n >= 20)}
    footers = {k for k, (n, near) in by["l"].items() if n >= FOOTER_LEAST and near >= FOOTER_BESIDE * n}
    return Lexicon(trusted_words(by["w"], share), shapes, {k: n for k, (n, _) in by["p"].items()}, by["w"], total), footers
