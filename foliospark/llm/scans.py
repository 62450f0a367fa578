"""The repair operator on DataFrames: statistics over all texts, then every token, record and field judged or mended.

No word, pair or candidate is dropped or broadcast for being rare or frequent. Each kind of token is judged once: its
questions are joined with the tables of words, folds, shapes and pairs, and near words come from automata over tries
of a part of the words each. Records travel in chunks of bounded size; a chunk gets the verdicts on its tokens, asks
what its contexts need, and is judged with the answers. Rows delivered again change no statistics.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .lexicon import COMMON, EDGE, LONGEST, RATIO, Lexicon, Trie, fold, shape
from .repair import (
    FINE, FOOTER_BESIDE, FOOTER_LEAST, MISREAD, Reader, TypeJudge, core, count_text, is_number, line_questions, odd_lines, pair_counts, statistics, text_tokens, type_questions,
)

_FLUSH = 400_000
#: Characters of text a chunk may hold before it ends, and folds a bucket of the near search has on average.
CHUNK_CHARS, BUCKET_FOLDS = 500_000, 50_000
#: Chunks to a task: reading them in Python takes longer than moving them, so tasks are not merged by their bytes.
TASK_CHUNKS = 8
_ASK = "kind string, key string, pair bigint"
_WORDS = "array<struct<n: bigint, w: string>>"
_OPTIONS = "array<struct<d: int, w: string, n: bigint>>"
_FACT = f"chunk bigint, kind string, key string, pair bigint, code int, own double, options {_OPTIONS}, n bigint"
_OPTION_TYPE = pa.list_(pa.struct([("d", pa.int32()), ("w", pa.string()), ("n", pa.int64())]))


def _batch(rows, names: list[str], types: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _mapped(df: DataFrame, each, schema: str, types: list) -> DataFrame:
    """A row-to-rows function in Arrow batches."""
    names = [x.split()[0] for x in re.split(r",\s*(?![^<]*>)", schema)]

    def run(batches):
        for b in batches:
            rows = [r for x in zip(*(c.to_pylist() for c in b.columns)) for r in each(*x)]
            yield _batch(rows, names, types)

    return df.mapInArrow(run, schema)


# statistics


@dataclass
class Corpus:
    """Tables of the corpus: words (key, fold, n), folds (key, words), shapes (key), counts of all words, points, footers (key), pairs (pair, n)."""

    words: DataFrame
    folds: DataFrame
    shapes: DataFrame
    counts: DataFrame
    footers: DataFrame
    pairs: DataFrame
    total: int
    common: set[str]


def _count_rows(batches):
    """Partial statistics of (text, digital) rows, given out whenever many distinct tokens are held; pairs (kind b) for each batch."""
    digital, scanned, odd = Counter(), Counter(), Counter()
    memory: dict[str, int] = {}
    names, types = ["kind", "key", "pair", "n", "d"], [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def flush():
        rows = [(kind, key, None, n, d) for kind, key, n, d in statistics(digital, 1, Counter()) + statistics(scanned, 0, odd)]
        for c in (digital, scanned, odd):
            c.clear()
        return _batch(rows, names, types)

    for b in batches:
        texts = b.column(0).to_pylist()
        for text, dig in zip(texts, b.column(1).to_pylist()):
            if text:
                count_text(text, digital if dig else scanned, None if dig else odd)
        pair, n = pair_counts(texts, memory)
        none = pa.nulls(len(pair), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(["b"] * len(pair), pa.string()), none, pa.array(pair), pa.array(n.astype(np.int64)), pa.nulls(len(pair), pa.int64())], names)
        if len(memory) > _FLUSH:
            memory.clear()
        if len(digital) + len(scanned) + len(odd) > _FLUSH:
            yield flush()
    yield flush()


def learn(texts: DataFrame) -> Corpus:
    """The statistics of all ``texts`` (text, digital and, if known, rec_id: equal texts of one record count once).

    Only the totals and the common words, at most 1 / COMMON of them, come to the driver.
    """
    texts = texts.where("text is not null")
    texts = texts.distinct() if "rec_id" in texts.columns else texts
    counts = texts.select("text", "digital").mapInArrow(_count_rows, "kind string, key string, pair bigint, n bigint, d bigint")
    counts = stage(counts.groupBy("kind", "key", "pair").agg(F.sum("n").alias("n"), F.sum("d").alias("d")))
    w = counts.where("kind = 'w'").select("key", "n", "d")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    total, digital = w.agg(zero("n"), zero("d")).first()
    share = digital / total if total else 0.0
    folded = _mapped(w, lambda k, n, d: [(k, n, d, fold(k))], "key string, n bigint, d bigint, fold string", [pa.string(), pa.int64(), pa.int64(), pa.string()])
    top = folded.groupBy("fold").agg(F.max("n").alias("top"))
    n, d, best = F.col("n"), F.col("d"), F.col("top")
    seen = (d >= 2) & (d >= 0.3 * share * n) if share > 0 else n * 8 >= best
    words = stage(folded.join(top, "fold").where(seen & ((n * RATIO >= best) | (d >= 0.6 * share * n))).select("key", "fold", "n"))
    folds = words.groupBy(F.col("fold").alias("key")).agg(F.transform(F.sort_array(F.collect_list(F.struct((-n).alias("z"), "key"))), lambda x: F.struct((-x["z"]).alias("n"), x["key"].alias("w"))).alias("words"))
    s = counts.where("kind = 's'")
    shapes = s.where((d >= 2) & (d >= 0.3 * share * n) if share > 0 else n >= 20).select("key")
    footers = counts.where((F.col("kind") == "l") & (n >= FOOTER_LEAST) & (d >= FOOTER_BESIDE * n)).select("key")
    common = {r[0] for r in words.where(n >= max(1.0, COMMON * total)).select("key").collect()}
    return Corpus(words, stage(folds), shapes, counts, footers, counts.where("kind = 'b'").select("pair", "n"), total, common)


# kinds of tokens


def _halves(folded: str) -> set[str]:
    """Keys of which two folds at most one edit apart share one: a half that the edit leaves alone, for the shorter length."""
    out = set()
    for m in (len(folded) - 1, len(folded)):
        if m > 0:
            h = m // 2
            out |= {f"{m}<{folded[:h]}", f"{m}>{folded[len(folded) - (m - h) :]}"}
    return out


def _near_words(asked: DataFrame, folds: DataFrame) -> DataFrame:
    """``key, words``: for each fold asked the trusted words whose fold is one edit away.

    Both sides go to the buckets of their halves; in a bucket the automata of the asked folds run over one trie.
    """
    spark = asked.sparkSession
    keys = 4 * (asked.count() + folds.count())
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(keys / BUCKET_FOLDS))
    half = F.udf(lambda f: sorted(_halves(f)), "array<string>", useArrow=True)
    spread = lambda df: df.withColumn("bucket", F.explode(F.array_distinct(F.transform(half("key"), lambda h: F.pmod(F.xxhash64(h), F.lit(buckets))))))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        words = dict(zip(right.column("key").to_pylist(), right.column("words").to_pylist()))
        wanted = left.column("key").to_pylist()
        rows = []
        if words and wanted:
            for f, found in zip(wanted, Trie(list(words)).within_one(wanted)):
                rows += [(f, words[w]) for d, w in found if d]
        return pa.Table.from_batches([_batch(rows, ["key", "words"], [pa.string(), pa.list_(pa.struct([("n", pa.int64()), ("w", pa.string())]))])])

    found = spread(asked).groupBy("bucket").cogroup(spread(folds).groupBy("bucket")).applyInArrow(search, f"key string, words {_WORDS}")
    return found.groupBy("key").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("words"))), False).alias("words"))


def _first_question(t: str):
    """What decides whether a token is a known word or number, or nothing for one without either."""
    c = core(t)
    if not c:
        return [(t, "x", None)] if t in ("|", "�") else []
    if is_number(c):
        raw = t.strip(EDGE)
        return [(t, "s", shape(raw))] if len(raw) <= 24 else []
    if len(c) > LONGEST:
        return []
    return [(t, "c" if t[-1] == "," and t[:-1].lower().endswith(c) else "w", c)]


def verdicts(types: DataFrame, corpus: Corpus) -> DataFrame:
    """``t, code, own, options`` of every kind of token ``t`` that is not fine."""
    first = stage(_mapped(types, _first_question, "t string, kind string, key string", [pa.string()] * 3))
    known = corpus.words.select(F.lit(True).alias("word"), "key").union(corpus.shapes.select(F.lit(False), "key")).withColumn("known", F.lit(True))
    judged = first.withColumn("word", F.col("kind") != "s").join(known, ["word", "key"], "left")
    hard = stage(judged.where("known is null and kind <> 'x'").select("t"))
    common, total = corpus.common, corpus.total
    questions = stage(_mapped(hard, lambda t: [(t, *q) for q in type_questions(t, common)], f"t string, {_ASK}", [pa.string()] * 3 + [pa.int64()]))
    near = _near_words(questions.where("kind = 'n'").select("key").distinct(), corpus.folds)
    one = lambda w: F.array(F.struct("n", w.alias("w")))
    counted = corpus.counts.where("kind = 'w'")
    facts = corpus.words.select(F.lit("w").alias("kind"), "key", one(F.col("key")).alias("words"))
    facts = facts.union(corpus.folds.select(F.lit("f"), "key", "words")).union(near.select(F.lit("n"), "key", "words"))
    facts = facts.union(counted.select(F.lit("o"), "key", one(F.when(F.col("d") > 0, "d").otherwise("")))).union(corpus.shapes.select(F.lit("s"), "key", F.lit(None).cast(_WORDS)))
    answers = questions.where("kind <> 'b'").join(facts, ["kind", "key"]).select("t", "kind", "key", "words")
    beside = questions.where("kind = 'b'").join(corpus.pairs, "pair").select("t", "kind", F.col("pair").cast("string").alias("key"), one(F.lit("")).alias("words"))
    given = answers.union(beside).groupBy("t").agg(F.collect_list(F.struct("kind", "key", "words")).alias("given"))  # bounded by the token's length

    def judge(t: str, given):
        by: dict[str, dict] = {k: {} for k in "wfnosb"}
        for g in given or ():
            by[g["kind"]][g["key"]] = [(x["n"], x["w"]) for x in g["words"] or ()]
        counts = {k: (x[0][0], int(x[0][1] == "d")) for k, x in by["o"].items()}
        lex = Lexicon({k: x[0][0] for k, x in by["w"].items()}, set(by["s"]), {}, counts, total, by["f"], by["n"], common)
        code, own, options = TypeJudge(lex, {int(k): x[0][0] for k, x in by["b"].items()}).verdict(t)
        return [(t, code, own, [{"d": d, "w": w, "n": n} for d, w, n in options])] if code != FINE else []

    schema = f"t string, code int, own double, options {_OPTIONS}"
    out = _mapped(hard.join(given, "t", "left").select("t", "given"), judge, schema, [pa.string(), pa.int32(), pa.float64(), _OPTION_TYPE])
    # commas where another point mostly follows, and lone strokes
    p, mark = corpus.counts.where("kind = 'p'"), F.substring("key", -1, 1)
    points = p.groupBy(F.expr("substring(key, 1, length(key) - 1)").alias("key")).agg(F.sum(F.when(mark == ",", F.col("n")).otherwise(0)).alias("comma"), F.max(F.when(mark != ",", F.col("n")).otherwise(0)).alias("other"))
    wrong = judged.where("known and kind = 'c'").join(points, "key").where("other >= 20 and other >= 25 * greatest(1, comma)").select("t")
    flat = wrong.union(first.where("kind = 'x'").select("t")).select("t", F.lit(MISREAD).alias("code"), F.lit(float("-inf")).alias("own"), F.lit(None).cast(_OPTIONS).alias("options"))
    return out.union(flat)


# records


def _shifted(t: str | None, h: str | None, m: str | None) -> int | None:
    """The first line of htr_text within merged_text if that is tesseract_text and htr_text with a gap, else None."""
    if not m or not t:
        return None
    if not h:
        return 0 if m == t else None
    gap = len(m) - len(t) - len(h)
    if 1 <= gap <= 4 and m.startswith(t) and m.endswith(h) and not m[len(t) : len(t) + gap].strip("\n"):
        return t.count("\n") + gap
    return None


def _chunked(records: DataFrame, fields: list[str]) -> DataFrame:
    """Scanned records with ``chunk``, ``shift`` and ``odd``, the lines outside the flow of each field; a merged text that only joins the others travels as its shift."""
    names = ["tab", "rec_id", *fields]
    schema = pa.schema([("chunk", pa.int64()), ("shift", pa.int32()), ("odd", pa.list_(pa.list_(pa.int32()))), *((c, pa.string()) for c in names)])
    joined = [fields.index(f) + 2 if f in fields else None for f in ("tesseract_text", "htr_text", "merged_text")]

    def run(batches):
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                row, shift = list(row), None
                if joined[2] is not None:
                    shift = _shifted(*(row[k] if k is not None else None for k in joined))
                    if shift is not None:
                        row[joined[2]] = None
                size += sum(len(x) for x in row[2:] if x)
                rows.append((chunk, shift, [odd_lines(x) if x else [] for x in row[2:]], *row))
                if size > CHUNK_CHARS:
                    chunk, size = chunk + 1, 0
            yield _batch(rows, schema.names, schema.types)

    out = records.where(~F.col("digital")).select(*names)
    return stage(out.mapInArrow(run, "chunk bigint, shift int, odd array<array<int>>, " + ", ".join(f"{c} string" for c in names)))


def _chunk_questions(chunked: DataFrame, fields: list[str], mend: bool) -> DataFrame:
    """``chunk, kind, key, pair``: the tokens (t), footer lines (l) and pairs at odd lines (b) of each chunk, once each while it is read."""
    names, types = ["chunk", "kind", "key", "pair"], [pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches):
        own, now = set(), None
        for b in batches:
            rows = []
            for chunk, odd, *texts in zip(*(c.to_pylist() for c in b.columns)):
                if chunk != now or len(own) > _FLUSH:
                    rows += [(now, *q) for q in own]
                    own, now = set(), chunk
                for t, lines in zip(texts, odd):
                    if t:
                        own |= {("t", x, None) for x in text_tokens(t, mend, lines)}
                        keys, pairs = line_questions(t, lines)
                        own |= {("l", x, None) for x in keys}
                        own |= {("b", None, x) for x in pairs}
            yield _batch(rows, names, types)
        yield _batch([(now, *q) for q in own], names, types)

    return stage(chunked.select("chunk", "odd", *fields).mapInArrow(run, f"chunk bigint, {_ASK}"))


def _reader(facts: pa.Table, asked: set | None) -> Reader:
    found, words, folds, pairs, footers = {}, {}, {}, {}, set()
    for kind, key, pair, code, own, options, n in zip(*(facts.column(c).to_pylist() for c in ("kind", "key", "pair", "code", "own", "options", "n"))):
        if kind == "t":
            found[key] = (code, own, [(o["d"], o["w"], o["n"]) for o in options or ()])
        elif kind == "b":
            pairs[pair] = n
        elif kind == "w":
            words[key] = n
        elif kind == "f":
            folds[key] = options[0]["w"]
        else:
            footers.add(key)
    return Reader(found, words, folds, pairs, footers, asked)


def scan(records: DataFrame, fields: list[str], corpus: Corpus, mend: bool) -> DataFrame:
    """Findings or mended texts of each record and field.

    ``records``: tab, rec_id, the fields, digital. With ``mend`` a row (tab, rec_id, field, text) for every field that
    is not null, else rows (tab, rec_id, field, line_no, kind). Texts born digital have no page furniture or
    misreadings: they give no findings and keep their words. Empty texts give an empty text and no finding.
    """
    chunked = _chunked(records, fields)
    asks = _chunk_questions(chunked, fields, mend)
    judged = stage(verdicts(asks.where("kind = 't'").select(F.col("key").alias("t")).distinct(), corpus))
    none = lambda t: F.lit(None).cast(t)
    by_pair = lambda q: q.where("kind = 'b'").select("chunk", "pair").distinct().join(corpus.pairs, "pair").select("chunk", F.lit("b"), none("string"), "pair", none("int"), none("double"), none(_OPTIONS), "n")
    tokens = asks.where("kind = 't'").select("chunk", F.col("key").alias("t")).join(judged, "t")
    facts = tokens.select("chunk", F.lit("t").alias("kind"), F.col("t").alias("key"), none("bigint").alias("pair"), "code", "own", "options", none("bigint").alias("n"))
    lines = asks.where("kind = 'l'").join(corpus.footers, "key").select("chunk", F.lit("l"), "key", none("bigint"), none("int"), none("double"), none(_OPTIONS), none("bigint"))
    facts = stage(facts.union(lines).union(by_pair(asks)))
    n = max(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(chunked.select("chunk").distinct().count() / TASK_CHUNKS))
    dealt = lambda df: df.repartition(n, "chunk").groupBy("chunk")
    texts = dealt(chunked)

    def ask(key, left: pa.Table, right: pa.Table) -> pa.Table:
        asked: set = set()
        reader = _reader(right, asked)
        odd = left.column("odd").to_pylist()
        for k, f in enumerate(fields):
            for i, text in enumerate(left.column(f).to_pylist()):
                if text:
                    (reader.repaired if mend else reader.judge)(text, odd[i][k])
        return pa.Table.from_batches([_batch([(key[0].as_py(), *q) for q in asked], ["chunk", "kind", "key", "pair"], [pa.int64(), pa.string(), pa.string(), pa.int64()])])

    wanted = stage(texts.cogroup(dealt(facts)).applyInArrow(ask, f"chunk bigint, {_ASK}"))
    top = F.transform(F.slice("words", 1, 1), lambda x: F.struct(F.lit(0).alias("d"), x["w"].alias("w"), x["n"].alias("n")))
    of_words = wanted.where("kind = 'w'").join(corpus.words, "key").select("chunk", "kind", "key", none("bigint"), none("int"), none("double"), none(_OPTIONS), "n")
    of_folds = wanted.where("kind = 'f'").join(corpus.folds, "key").select("chunk", "kind", "key", none("bigint"), none("int"), none("double"), top, none("bigint"))
    facts = facts.union(of_words).union(of_folds).union(by_pair(wanted))
    names = ["tab", "rec_id", "field", "text"] if mend else ["tab", "rec_id", "field", "line_no", "kind"]
    types = [pa.string()] * 4 if mend else [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]

    def read(key, left: pa.Table, right: pa.Table) -> pa.Table:
        reader, out = _reader(right, None), []
        cols = {c: left.column(c).to_pylist() for c in left.column_names}
        for i, shift in enumerate(cols["shift"]):
            done: dict[str, list | str] = {}
            for k, f in enumerate(fields):
                text = cols[f][i]
                if f == "merged_text" and shift is not None:
                    t, h = done.get("tesseract_text"), done.get("htr_text")
                    done[f] = "\n\n".join(x for x in (t, h) if x) if mend else (t or []) + [(line + shift, kind) for line, kind in h or ()]
                elif text is not None:
                    done[f] = (reader.repaired if mend else reader.judge)(text, cols["odd"][i][k])
                else:
                    continue
                mine = (cols["tab"][i], cols["rec_id"][i], f)
                out += [(*mine, done[f])] if mend else [(*mine, line, kind) for line, kind in done[f]]
        return pa.Table.from_batches([_batch(out, names, types)])

    schema = "tab string, rec_id string, field string, " + ("text string" if mend else "line_no int, kind string")
    found = texts.cogroup(dealt(facts)).applyInArrow(read, schema)
    if not mend:
        return found
    plain = lambda tab, rec, *texts: [(tab, rec, f, "\n\n".join(" ".join(p.split()) for p in t.split("\n\n") if p.strip())) for f, t in zip(fields, texts) if t is not None]
    return found.union(_mapped(records.where("digital").select("tab", "rec_id", *fields), plain, schema, types))
