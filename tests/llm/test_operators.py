"""The operators against brute force, round trips and awkward rows."""

import os
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliospark.functions.png import encode
from foliospark.llm import bpe, chunking, leakage, lexicon, packing, repair, scans, strokes, survivors, toxicity
from foliospark.llm.components import grouped_split, hash_to_min, tied_pairs
from foliospark.llm.leakage import cross_split_pairs, record_pairs
from foliospark.llm.queries import LLM
from foliospark.llm.scans import learn, scan
from foliospark.llm.survivors import survivors as survive
from foliospark.llm.tokens import count_tokens, encode_texts

from ..conftest import DATA

# chunking


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 3000))
def test_pieces_cover_the_text_within_the_limit(seed, n):
    r = random.Random(seed)
    t = ""
    while len(t) < n:
        t += "x" * r.choice([1, 3, 7, 12, 40, r.randint(150, 320) if r.random() < 0.05 else 2]) + r.choice([" ", " ", "\n", ". ", "\n\n", ", "])
    p = chunking.pieces(t, 200, 20)
    assert p[0][0] == 0 and p[-1][2] == len(t)
    assert all(e - s <= 200 and s <= f <= e for s, f, e, _ in p)
    assert all(b[1] == a[2] and b[0] > a[0] for a, b in zip(p, p[1:]))
    if len(t) > 200:
        assert any(h for *_, h in p) == (max(map(len, t.split()), default=0) > 200)


def test_pieces_of_short_texts_and_a_word_of_exactly_the_limit():
    assert chunking.pieces("") == [(0, 0, 0, False)] and chunking.pieces("a" * 2000) == [(0, 0, 2000, False)]
    p = chunking.pieces("b c " * 30 + "a" * 2000 + " d")
    assert not any(h for *_, h in p)
    with pytest.raises(ValueError):
        chunking.pieces("x" * 30, 10, 10)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([(60, 10), (50, 25), (30, 0)]))
def test_only_words_over_the_limit_are_cut_whatever_blanks_there_are(seed, sizes):
    limit, overlap = sizes
    r, t = random.Random(seed), ""
    while len(t) < 8 * limit:
        t += "x" * r.choice([1, 5, limit // 2, limit - 1, limit, r.randint(1, 2 * limit) if r.random() < 0.1 else 2]) + r.choice([" ", "\n\n", "\x85", " " * r.randint(1, 3 * limit) if r.random() < 0.1 else ". "])
    p = chunking.pieces(t, limit, overlap)
    assert all(e - s <= limit and s <= f < e for s, f, e, _ in p) and all(b[1] == a[2] for a, b in zip(p, p[1:]))
    assert any(h for *_, h in p) == (max(map(len, t.split())) > limit)


def test_blanks_are_cut_and_pieces_are_balanced():
    assert not any(h for *_, h in chunking.pieces("a" + " " * 3000 + "b"))
    t = "Some words make a sentence. " * 300
    p = chunking.pieces(t)
    assert len(p) == -(-(len(t) - 200) // 1800)
    lengths = [e - s for s, _, e, _ in p]
    assert min(lengths) > 0.8 * max(lengths) and all(150 <= f - s <= 250 for s, f, _, _ in p[1:])


def test_split_texts_leaves_short_and_null_texts_out(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "short", "x"), (4, "word " * 900, "x"), (4, "word " * 900, "x")], "doc_id bigint, merged_text string, piece string")
    got = chunking.split_texts(df, "doc_id", "merged_text").collect()
    assert {r.doc_id for r in got} == {4} and all(len(r.piece) <= 2000 for r in got)
    assert chunking.split_texts(df.limit(0), "doc_id", "merged_text").count() == 0


# survivors


def test_consensus_votes_by_column():
    assert survivors.consensus([["a", "x", "c"], ["a", "b", "c"], ["a", "b", "c", "d"]], [1.0, 1.0, 1.0]) == ["a", "b", "c"]
    assert survivors.choose(["a x c", "a b c", "a b c d"], half_life=50.0)[0] == 1
    assert survivors.choose(["a x c", "a b c", "a b c"], half_life=1.0)[0] == 0  # the newest outweighs all older ones


def test_the_vote_overrules_the_newest(spark):
    rows = [("g", f"r{k}", t, f"2016-01-0{k + 1}", "u", url) for k, (t, url) in enumerate([("the old house", "x"), ("the old house", "x"), ("tke old house", None)])]
    rows += [("h", "a", "one two", "2016-01-01", "u", "x"), ("h", "b", "one too", "2016-01-02", None, None)]
    df = spark.createDataFrame(rows, "group_id string, record_id string, text string, at string, user_id string, url string").withColumn("at", F.col("at").cast("timestamp"))
    assert {r.group_id: r.text_from for r in survive(df, 3.0, ("url",)).collect()} == {"g": "r1", "h": "a"}  # agreement; completeness
    assert {r.group_id: r.text_from for r in survive(df).collect()} == {"g": "r2", "h": "b"}
    assert survivors.depth_of(1.0) >= 53 and survivors.depth_of(3.0) >= 159


def test_survivors_fields_ties_and_awkward_rows(spark):
    rows = [
        ("g", "b", "new text", "2016-01-02", ""), ("g", "a", "tie wins", "2016-01-02", None), ("g", "c", "  .. ", "2016-01-03", "u1"), ("g", "d", "old", None, "u2"), ("g", "a", "tie wins", "2016-01-02", None),
        ("h", "e", None, None, None), ("h", "f", "", None, " "), ("i", "k", "one", None, "u"), (None, "z", "t", None, "u"), ("q", None, "t", None, "u"),
    ]
    df = spark.createDataFrame(rows, "group_id string, record_id string, text string, at string, user_id string").withColumn("at", F.col("at").cast("timestamp")).withColumn("rk", F.lit(1)).withColumn("salt", F.lit(1))
    got = {r.group_id: (r.n_records, r.text_from, r.user_from) for r in survive(df).collect()}
    assert got == {"g": (4, "a", "c"), "h": (2, "", ""), "i": (1, "k", "k")}
    assert survive(df.limit(0)).count() == 0


def test_every_field_survives_by_its_newest_value(spark):
    rows = [("g", "a", "t", "2016-01-01", "u", "old.png", True), ("g", "b", "t", "2016-01-02", "u", "new.png", False), ("g", "c", "t", "2016-01-03", "u", " ", None), ("g", "d", "t", None, "u", "none.png", True), ("h", "e", "t", None, None, None, None)]
    df = spark.createDataFrame(rows, "group_id string, record_id string, text string, at string, user_id string, url string, opted_in boolean").withColumn("at", F.col("at").cast("timestamp"))
    got = {r.group_id: (r.user_from, r.url, r.opted_in) for r in survive(df, fields=("url", "opted_in")).collect()}
    assert got == {"g": ("c", "new.png", False), "h": ("", None, None)}


def test_the_surviving_record_has_all_columns_of_corrections(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    missing = set(spark.read.parquet(f"{DATA}/corrections.parquet").columns) - set(LLM.queries["p2_survivors"](spark, DATA).columns)
    assert missing == {"correction_id", "corrected_text", "corrected_at"}  # text_from, text and newest_at


def test_a_hot_group_keeps_its_newest(spark):
    df = spark.range(3000).select(F.lit("hot").alias("group_id"), F.format_string("%05d", "id").alias("record_id"), F.format_string("text %d", F.col("id") % 7).alias("text"), F.timestamp_seconds(F.col("id") % 1000).alias("at"), F.lit("u").alias("user_id"))
    assert [(r.n_records, r.text_from, r.user_from) for r in survive(df).collect()] == [(3000, "00999", "00999")]


def _members(texts, filled=None):
    return [("g", f"r{k:04}", t, f"{2400 - k}-01-01", (filled or {}).get(k), (filled or {}).get(k)) for k, t in enumerate(texts)]


def test_members_beyond_the_gathered_ones_count(spark):
    frame = lambda rows: spark.createDataFrame(rows, "group_id string, record_id string, text string, at string, user_id string, url string").withColumn("at", F.col("at").cast("timestamp"))
    pick = lambda rows, *how: [(r.text_from, r.consensus) for r in survive(frame(rows), *how).collect()]
    # the newest outweighs all others together, which as doubles sum up to the same
    assert pick(_members(["a"] + ["a b"] * 70)) == [("r0000", "a")]
    # none of the gathered values is the elected text, an older one is
    texts = [("p b c d", "a q c d", "a b r d", "a b c s")[k % 4] for k in range(400)]
    texts[300] = "a b c d"
    assert pick(_members(texts), 3.0) == [("r0300", "a b c d")]
    # r0000 with a quarter and r0006 with the whole weigh the same, r0200 decides
    texts = [f"w k{k}" for k in range(300)]
    texts[0], texts[6] = "w x", "w y"
    assert pick(_members(texts, {6: "u"}), 3.0, ("url",)) == [("r0000", "w x")]
    texts[200] = "w y"
    assert pick(_members(texts, {6: "u"}), 3.0, ("url",)) == [("r0006", "w y")]
    numbered = frame(_members(texts, {6: "u"})).withColumn("group_id", F.lit(3).cast("bigint"))
    assert [(r.group_id, r.text_from) for r in survive(numbered, 3.0, ("url",)).collect()] == [(3, "r0006")]


def test_a_settled_election_is_that_of_all_members():
    r = random.Random(5)
    for _ in range(150):
        h, full = r.choice([0.7, 1.0, 2.5, 3.0]), 8
        rows = [([r.choice("abc") for _ in range(r.randint(1, 4))], r.choice([2, 5, 8])) for _ in range(r.randint(2, 30))]
        e, early = survivors.Election(h, full), None
        for tokens, complete in rows:
            if e.add(tokens, complete) and early is None:
                early = e.text()
        cols, total = [], Fraction(0)
        for k, (tokens, complete) in enumerate(rows):
            w = Fraction(2.0 ** -(k % h / h)) / 2 ** int(k // h) * complete
            cols = survivors._align(cols, tokens, float(w), float(total), w, total)
            total += w
        assert e.text() == survivors._elected(cols) and early in (None, e.text())


# components


def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(f"d{r.randrange(80)}", f"r{r.randrange(90)}") for _ in range(90)] + [("d100", None), (None, "r100"), (None, None), ("d1", "r1"), ("d1", "r1")]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        for x in (a, b):
            if x:
                find(x)
        if a and b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {}
    for x in parent:
        want.setdefault(find(x), []).append(x)
    low = {x: min(v) for v in want.values() for x in v}
    df = spark.createDataFrame(edges, "d string, r string")
    assert {x.node: x.component for x in hash_to_min(df, "d", "r").collect()} == low
    assert hash_to_min(df.limit(0), "d", "r").count() == 0


def test_a_long_chain_and_a_star(spark):
    chain = [(f"d{i:03d}", f"r{i:03d}") for i in range(60)] + [(f"d{i + 1:03d}", f"r{i:03d}") for i in range(59)] + [("hub", f"x{i}") for i in range(300)]
    got = hash_to_min(spark.createDataFrame(chain, "d string, r string"), "d", "r")
    assert got.groupBy("component").count().count() == 2


def test_split_shares_with_one_component_of_a_third(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 10_000, F.lit("hot")).otherwise((F.col("id") / 3).cast("int").cast("string")).alias("component"))
    got = {r.split: r.n for r in grouped_split(df, "component", {"train": 0.8, "validation": 0.1, "test": 0.1}).groupBy("split").agg(F.sum("n_records").alias("n")).collect()}
    assert abs(got["train"] / 30_000 - 0.8) < 0.02 and abs(got["test"] / 30_000 - 0.1) < 0.02


def test_more_records_move_no_stored_component(spark):
    w = {"train": 0.8, "validation": 0.1, "test": 0.1}
    df = spark.range(6000).select(F.when(F.col("id") < 1500, F.lit("hot")).otherwise((F.col("id") / 3).cast("int").cast("string")).alias("component"))
    old = grouped_split(df, "component", w).cache()
    more = df.union(spark.range(600).select(F.when(F.col("id") < 100, F.lit("hot")).otherwise((F.col("id") + 5700).cast("string")).alias("component")))
    new = grouped_split(more, "component", w, old.select("component", "split"))
    moved = old.join(new.select("component", F.col("split").alias("now")), "component").where("split <> now")
    assert moved.count() == 0
    got = {r.split: r.n for r in new.groupBy("split").agg(F.sum("n_records").alias("n")).collect()}
    assert sum(got.values()) == 6600 and all(abs(got[k] / 6600 - v) < 0.03 for k, v in w.items())
    assert grouped_split(df.limit(0), "component", w).count() == 0


def test_pairs_of_a_large_component_come_from_parts(spark):
    df = spark.range(70).select(F.when(F.col("id") < 50, F.lit("big")).otherwise(F.lit("small")).alias("component"), F.format_string("%03d", "id").alias("doc"))
    assert tied_pairs(df, "x", "y", 8).distinct().count() == tied_pairs(df, "x", "y", 8).count() == 50 * 49 // 2 + 20 * 19 // 2


# tokens


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_encoding_equals_exact_merging_and_decodes_back(text):
    e = bpe.encoder()
    ids = e.encode_batch([text])[0]
    assert ids == [i for w in bpe.PATTERN.findall(text) for i in e.merge(w.encode())]
    assert b"".join(e.bytes_of[i] for i in ids).decode() == text


def test_long_words_merge_alike():
    e = bpe.encoder()
    for w in (b"ab" * 200, b"zq" * 40 + b"the" * 30, bytes(range(256)) * 2):
        short, bpe._LONG = bpe._LONG, 10**9
        try:
            slow = e.merge(w)
        finally:
            bpe._LONG = short
        assert e._merge_long(w) == slow


def test_encoding_equals_the_tokenizers_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    r = random.Random(2)
    texts = ["".join(r.choice("abc déß 12\n\t　​名前🙂\x1c\x85's.,") for _ in range(r.randrange(60))) for _ in range(500)] + ["<|endoftext|> x", "a" * 500]
    assert bpe.encoder().encode_batch(texts) == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_encode_texts_with_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hello world"), (3, "hello world")], "doc_id bigint, text string").withColumn("ids", F.lit(0))
    got = sorted((r.doc_id, list(r.ids)) for r in encode_texts(df, "doc_id", "text").collect())
    assert got[0] == (1, []) and got[1] == (2, []) and got[2] == got[3] and len(got[2][1]) == 2
    assert encode_texts(df.limit(0), "doc_id", "text").count() == 0 and count_tokens(df, "doc_id", "text").agg(F.sum("n_tokens")).first()[0] == 4


# packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_packing_keeps_every_item_whole_and_within_capacity(sizes):
    bins = packing.best_two_fit(np.array(sizes, dtype=np.int64), 64)
    assert sorted(s for b in bins for s in b) == sorted(sizes) and all(sum(b) <= 64 for b in bins)
    assert len(bins) <= 2 * -(-sum(sizes) // 64) + 1


def test_pack_places_without_overlap(spark):
    rows = [(i, n) for i, n in enumerate([5000, 0, None, 2048, 1, 700, 700, 700, 2049, 300] * 30)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, n_tokens int").withColumn("bin", F.lit(1)), "doc_id", "n_tokens", block_items=100).collect()
    total = {}
    for r in got:
        total.setdefault(r.container, []).append((r.start, r.n_tokens, r.place))
        assert r.n_tokens <= 2048 and (r.piece_no == 0 or rows[r.doc_id][1] > 2048)
    for v in total.values():
        v.sort(key=lambda x: (x[0], x[2]))
        assert all(a[0] + a[1] <= b[0] or b[1] == 0 for a, b in zip(v, v[1:])) and v[-1][0] + v[-1][1] <= 2048
    assert sum(r.n_tokens for r in got) == sum(n or 0 for _, n in rows) and {r.doc_id for r in got} == set(range(300))
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, n_tokens int"), "doc_id", "n_tokens").count() == 0


# pictures


def _line(seed, width=180):
    r = np.random.default_rng(seed)
    a = np.full((32, width), 235, np.uint8)
    x = 8
    while x < width - 14:
        for _ in range(3):
            x0, y0, x1, y1 = r.integers(0, 10), r.integers(8, 24), r.integers(0, 10), r.integers(8, 24)
            for t in np.linspace(0, 1, 24):
                a[int(y0 + t * (y1 - y0)) :][:2, int(x + x0 + t * (x1 - x0)) :][:, :2] = 50
        x += int(r.integers(11, 16))
    return a


def _changed(a, how, seed):
    r = np.random.default_rng(seed)
    b = a.astype(float)
    if how == "dark":
        b = b * 0.8
    elif how == "shift":
        b = np.roll(b, (2, 3), (0, 1))
    elif how == "specks":
        u = r.random(b.shape)
        b[u < 0.01], b[u > 0.99] = 0, 255
    elif how == "blur":
        p = np.pad(b, 1, mode="edge")
        b = sum(p[i : i + b.shape[0], j : j + b.shape[1]] for i in range(3) for j in range(3)) / 9
    return np.clip(b, 0, 255).astype(np.uint8)


def test_copies_are_found_and_other_lines_are_not(spark):
    rows, want = [], set()
    for k in range(24):
        a = _line(k)
        rows.append((f"train_{k}", encode(a), "t", " Train", "s", "x"))
        how = ("same", "dark", "shift", "specks", "blur", None)[k % 6]
        other = _line(1000 + k) if how is None else _changed(a, how, k)
        rows.append((f"val_{k}", encode(other), None, ("val", "VALIDATION", "test")[k % 3], "s", "x"))
        if how:
            want.add((f"val_{k}", f"train_{k}"))
    rows += [("train_b", encode(np.full((32, 100), 250, np.uint8)), "", "train", "s", "x"), ("val_b", encode(np.full((32, 100), 250, np.uint8)), "", "val", "s", "x"), ("val_n", None, "t", "val", "s", "x"), ("val_c", b"broken", "t", "test", "s", "x"), rows[0], ("odd", rows[0][1], "t", "other", "s", "x")]
    df = spark.createDataFrame(rows, "image_id string, image_png binary, transcription string, split string, source string, cls string")
    got = record_pairs(*cross_split_pairs(df)).select("eval_id", "train_id").collect()
    assert set(map(tuple, got)) == want and len(got) == len(want)
    assert record_pairs(*cross_split_pairs(df.limit(0))).count() == 0


def test_heavy_seeds_are_lengthened_and_lose_no_copy(spark, monkeypatch):
    frame = np.tile(np.array([40] * 6 + [235] * 6, np.uint8), (32, 10))  # a pattern that every picture starts with
    rows = []
    for k in range(12):
        a = np.concatenate([frame, _line(k)], axis=1)
        rows += [(f"t{k}", encode(a), "t", "train", "s"), (f"v{k}", encode((a * 0.9).astype(np.uint8)), "t", "val", "s"), (f"w{k}", encode(np.concatenate([frame, _line(500 + k)], axis=1)), "t", "val", "s")]
    df = spark.createDataFrame(rows, "image_id string, image_png binary, transcription string, split string, source string")
    pairs = lambda: sorted(map(tuple, record_pairs(*cross_split_pairs(df)).select("eval_id", "train_id").collect()))
    plain = pairs()
    assert plain == sorted((f"v{k}", f"t{k}") for k in range(12))
    monkeypatch.setattr(leakage, "HEAVY", 20)
    assert pairs() == plain


def test_no_seed_or_chain_is_left_out(spark, monkeypatch):
    # changed copies share fewer fingerprints in a row; all are heavy
    rows = []
    for k in range(6):
        for how in ("same", "specks", "shift", "blur"):
            rows.append((f"{k} {how}", encode(_changed(_line(k), how, k)), "t", "train" if how == "same" else "val", "s"))
    df = spark.createDataFrame(rows, "image_id string, image_png binary, transcription string, split string, source string")
    pairs = lambda: sorted(tuple(r) for r in record_pairs(*cross_split_pairs(df)).select("eval_id", "train_id", "coverage", "score").collect())
    plain = pairs()
    monkeypatch.setattr(leakage, "HEAVY", 0.5)
    assert pairs() == plain and len(plain) > 12


@pytest.mark.parametrize("heavy", [7, 10**6])
def test_chains_against_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(leakage, "HEAVY", heavy)
    r = random.Random(3)
    prints = []
    for k in range(40):
        places = sorted(r.sample(range(120), r.choice([0, 1, 8, 40])))
        prints.append((k, int(k % 3 > 0), int(k % 3 == 0 or k % 7 == 0), [r.choice([1, 2, 3, r.randrange(4, 40)]) for _ in places], places))
    want = {}
    for ke, _, in_eval, he, pe in prints:
        for kt, in_train, _, ht, pt in prints:
            if in_eval and in_train and ke != kt and he and ht:
                hits = [(a - b, a) for x, a in zip(he, pe) for y, b in zip(ht, pt) if x == y]
                for s in {h + d for h, _ in hits for d in (-1, 0, 1)}:
                    at = [a for h, a in hits if abs(h - s) <= 1]
                    if len(at) >= max(1, int(min(len(he), len(ht)) * leakage.SHARE)) and max(at) - min(at) >= int(leakage.SPAN * min(pe[-1] - pe[0], pt[-1] - pt[0])):
                        want.setdefault((ke, kt), set()).add((s, len(at)))
    df = spark.createDataFrame(prints, "key bigint, in_train int, in_eval int, hashes array<bigint>, places array<int>")
    got = {(x.ke, x.kt): x.chains for x in leakage._chains(df).collect()}
    assert {p: {(c.shift, c.k) for c in cs} for p, cs in got.items()} == want
    assert all(len(cs) == len(want[p]) and cs[0].k == max(c.k for c in cs) for p, cs in got.items())


def test_fingerprints_do_not_depend_on_the_batch():
    inks = [strokes.ink(encode(_line(k, 120 + 10 * k))) for k in range(5)]
    alone = [strokes.fingerprints([x])[0] for x in inks]
    for (h, at), (h2, at2) in zip(alone, strokes.fingerprints(inks)):
        assert np.array_equal(h, h2) and np.array_equal(at, at2)


# toxicity


def test_words_undo_disguises():
    lex = toxicity.Lexicon()
    read = lambda t: [lex.names[i] for i in lex.batch([t])[0]]
    assert read("You b@5t@rd, d a m n it!") == ["you", "bastard", "damn", "it"]
    assert read("exam-\nple undrеss 4,711 n.a.k.e.d") == ["example", "undress", "#", "naked"]
    assert read("") == [] and read(None) == [] and toxicity.windows_of(lex.batch(["a b"])[0]).shape == (1, toxicity.WINDOW)


def test_gradients_agree_with_differences():
    net = toxicity.Network(1)
    lex = toxicity.Lexicon()
    win = np.concatenate([toxicity.windows_of(i) for i in lex.batch(["some words here for a test " * 6, "few"])])
    y, w = np.zeros(len(win), np.float32), np.ones(len(win), np.float32)
    y[0] = 1
    before = {k: v.astype(np.float64).copy() for k, v in net.p.items()}

    def loss():
        pf, pb = net.project(net.embed(lex.flat))
        p = net.forward(win, pf, pb)
        return float(-(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)).sum() / w.sum())

    grads = {}
    net._adam = lambda k, g, *a: grads.__setitem__(k, (g, a[3] if len(a) > 3 else None))
    net.step(win, y, w, lex.flat, 0.01)
    for k in ("uf", "ub", "wf", "wb", "wa", "wo", "va", "bo", "bf"):
        g = np.asarray(grads[k][0])
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        step = 1e-2
        net.p[k][at] = before[k][at] + step
        up = loss()
        net.p[k][at] = before[k][at] - step
        down = loss()
        net.p[k][at] = before[k][at]
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 2e-4, k


def test_held_out_accuracy_and_equal_scorers():
    r = random.Random(4)
    plain = ["the committee reviewed the annual report", "rats were found under the stage", "please return the form before may", "the invoice was paid in full by the tenant"]
    bad = ["you filthy idiot i will break your bones", "shut your damn mouth you cretin", "those people are vermin and should be burned"]

    def doc(toxic):
        s = [r.choice(plain) for _ in range(r.randrange(3, 12))]
        if toxic:
            s.insert(r.randrange(len(s)), r.choice(bad))
        return ". ".join(s)

    y = [int(i % 5 == 0) for i in range(260)]
    x = [doc(t) for t in y]
    params, cut = toxicity.train(x[:200], y[:200])
    s = toxicity.Scorer(params).documents(x[200:] + [None, "", "..."])
    assert ((s[:60] >= cut) == np.array(y[200:], bool)).mean() >= 0.97 and list(s[60:]) == [0.0, 0.0, 0.0]
    assert np.allclose(s[:60], [toxicity.Scorer(params).documents([t])[0] for t in x[200:]], atol=1e-5)
    assert toxicity.train(["a b"], [0]) == ({}, 1.0) and toxicity.train([], []) == ({}, 1.0)


# repair


def _edits(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, z in enumerate(b, 1):
            c.append(min(p[j - 1] + (x != z), p[j] + 1, c[-1] + 1))
        p = c
    return p[-1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abcd", min_size=1, max_size=7), min_size=1, max_size=60), st.lists(st.text("abcde", min_size=1, max_size=8), max_size=20))
def test_automaton_finds_all_words_within_one_edit(words, asked):
    for q, found in zip(asked, lexicon.Trie(words).within_one(asked)):
        assert sorted(found) == sorted((_edits(q, w), w) for w in set(words) if _edits(q, w) <= 1)


CLEAN = "The committee reviewed the attendance register before the office closed and the treasurer described the delivery note. Our warehouse returned the well-preserved manuscript to the municipal library without further explanation."
NOISY = """Annual Report Pelomond
Tbe committee reviewcd the atten-
dance register before the office closed
and the treasurer described the deliv¬
ery note. Our warehousereturned the well-
- 1 -
Annual Report Pelomond
preserved manuscript to the mun icipal
library without further explanation."""


def _corpus(spark):
    rows = [(f"d{i}", None, None, CLEAN, True) for i in range(40)] + [("n", NOISY, None, NOISY, False), ("e", "", None, "", False), ("z", None, None, None, True), ("h", "The committee.", "Our warebouse.", "The committee.\n\nOur warebouse.", False), ("long", "x" * 30_000, None, None, False)]
    return spark.createDataFrame(rows, "rec_id string, tesseract_text string, htr_text string, merged_text string, digital boolean").withColumn("tab", F.lit("documents")).withColumn("kind", F.lit("clash"))


def test_findings_and_mended_text(spark):
    df = _corpus(spark)
    corpus = learn(df.select(F.coalesce("merged_text", "tesseract_text").alias("text"), "digital"))
    fields = ["tesseract_text", "htr_text", "merged_text"]
    got = {(r.rec_id, r.field, r.line_no, r.kind) for r in scan(df, fields, corpus, False).collect()}
    for f in ("tesseract_text", "merged_text"):
        assert {(i, k) for rec, field, i, k in got if (rec, field) == ("n", f)} == {(0, "furniture"), (1, "hyphen"), (1, "misread"), (3, "hyphen"), (4, "misread"), (5, "furniture"), (6, "furniture"), (7, "misread")}
    assert {(f, i, k) for rec, f, i, k in got if rec == "h"} == {("htr_text", 0, "misread"), ("merged_text", 2, "misread")}
    assert not any(rec.startswith("d") for rec, *_ in got)
    mended = {(r.rec_id, r.field): r.text for r in scan(df, fields, corpus, True).collect()}
    text = mended["n", "tesseract_text"]
    assert text.startswith("The committee reviewed the attendance register") and "delivery note." in text and "Report" not in text and "municipal" in text and "well-preserved manuscript" in text
    assert mended["e", "merged_text"] == "" and ("z", "merged_text") not in mended and mended["h", "merged_text"] == "The committee.\n\nOur warehouse."


def test_short_and_rare_words_one_edit_away():
    digital = Counter({"letter": 900, "acta": 900, "der": 900, "the": 1000, "meter": 30, "reading": 30, "cash": 1, "leash": 900})
    scanned = Counter({"lctter": 2, "rnctcr": 1, "motor": 20, "mcker": 1, "cash": 3})
    counts = Counter()
    for kind, key, n, d in repair.statistics(digital, 1, Counter()) + repair.statistics(scanned, 0, Counter()):
        counts[kind, key] += np.array([n, d])
    lex, foot = repair.build([(kind, key, *map(int, v)) for (kind, key), v in counts.items()])
    assert lexicon.fold("lctter") == lexicon.fold("letter") and lexicon.fold("act") == lexicon.fold("ad")
    r = repair.Reader.of(lex, {("the", "meter"): 30, ("meter", "reading"): 30}, foot)
    texts = {"lctter": "the lctter", "acfa": "der acfa der", "plain": "der mcker", "context": "the mcker reading", "right": "the cash", "unlike": "the motor"}
    found = {k for k, x in texts.items() if r.judge(x) == [(0, "misread")]}
    assert found == {"lctter", "acfa", "context"}
    assert r.repaired("der acfa, the mcker reading") == "der acta, the meter reading"


def test_footers_stay_known_below_the_share_of_words(spark):
    page = "A line of the text that goes on until it is full here\nand then the sentence ends in the middle of it.\n{}\n12\n"
    rows = [(f"s{i}", page.format("notes on the osko collection")) for i in range(5)] + [(None, page.format("notes on the osko collection")), ("t", page.format("notes on the other house"))]
    df = spark.createDataFrame(rows, "rec_id string, tesseract_text string").withColumn("tab", F.lit("documents")).withColumn("digital", F.lit(False))
    corpus = learn(df.select(F.col("tesseract_text").alias("text"), "digital"))
    got = {(r.rec_id, r.line_no) for r in scan(df, ["tesseract_text"], corpus, False).where("kind = 'furniture'").collect()}
    assert {r for r, i in got if i == 2} == {f"s{i}" for i in range(5)} | {None}


def test_an_empty_corpus(spark):
    df = _corpus(spark).limit(0)
    corpus = learn(df.select(F.col("merged_text").alias("text"), "digital"))
    assert scan(df, ["tesseract_text"], corpus, False).count() == 0
    assert repair.Reader.of(lexicon.Lexicon({}, set(), {}), {}, set()).repaired("") == ""


def test_columns_of_figures_are_text():
    r = repair.Reader.of(lexicon.Lexicon({}, set(), {}), {}, set())
    lines = ["a long line of the text that goes on and", "12", "7", "53", "on until the sentence ends at the end.", "3"]
    assert r.furniture(lines) == {5}


def test_chunks_and_repeated_rows_change_nothing(spark, monkeypatch):
    good = "the committee approved the government payment before the meeting of the old council ended in june"
    rows = [(f"d{i}", None, f"{good} {'word ' * (i % 3)}", True) for i in range(30)]
    rows += [(f"s{i}", t, t, False) for i, t in enumerate(["the cornrnittee approved govemment payment zzqx", f"{'filling words of a text ' * 40}", "befcre the mceting of theold council\nof the coun-\ncil ended"] * 4)]
    df = spark.createDataFrame(rows, "rec_id string, tesseract_text string, merged_text string, digital boolean").withColumn("tab", F.lit("documents"))
    ten = df.join(spark.range(10).withColumnRenamed("id", "copy"))

    def both(d):
        corpus = learn(d.select("rec_id", F.col("merged_text").alias("text"), "digital"))
        one = lambda mend: {tuple(r) for r in scan(d, ["tesseract_text"], corpus, mend).collect()}
        return one(False), one(True)

    found, mended = both(df)
    assert ("documents", "s0", "tesseract_text", "the committee approved government payment zzqx") in mended
    assert {(r, i) for _, r, _, i, k in found if k == "misread" and r in ("s0", "s2")} == {("s0", 0), ("s2", 0)}
    assert both(ten) == (found, mended)
    monkeypatch.setattr(scans, "CHUNK_CHARS", 10)
    monkeypatch.setattr(scans, "BUCKET_FOLDS", 2)
    assert both(df) == (found, mended)


def test_halves_meet_wherever_the_edit_is():
    r = random.Random(2)
    for _ in range(3000):
        a = "".join(r.choice("abc") for _ in range(r.randint(1, 9)))
        i, c = r.randrange(len(a) + 1), r.choice("abc")
        for b in (a[:i] + c + a[i:], a[:i] + c + a[i + 1 :], a[:i] + a[i + 1 :]):
            if b:
                assert scans._halves(a) & scans._halves(b)
