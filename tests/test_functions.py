import hashlib
import uuid

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliospark.functions import kernels
from foliospark.functions.ids import norm_id
from foliospark.functions.png import BrokenPng, decode, encode, gray
from foliospark.functions.text import bucket_10000, strip, uuid5_dns, words
from foliospark.functions.times import read_time
from foliospark.functions.vectors import cosine


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_ids_in_all_spellings(spark):
    h = "0123456789abcdef0123456789abcdef"
    dashed = str(uuid.UUID(h))
    texts = [dashed, dashed.upper(), h, "{" + dashed + "}", f" {dashed}\t", f"urn:uuid:{dashed}", dashed + "\n", None, "", "xyz", h[:-1], h + "0"]
    assert [x for (x,) in one(spark, [(t,) for t in texts], "t string", norm_id("t"))] == [dashed] * 7 + [None] * 5


def test_times_in_all_notations(spark):
    texts = ["2015-07-26T12:45:11.096757+00:00", "2015-07-26T12:45:11.096757Z", "2015-07-26T07:45:11.096757-05:00", "2015-07-26 12:45:11.096757", "2015-07-26", "pending", "", None, "2015-13-99T00:00:00Z", "12"]
    got = [x for (x,) in one(spark, [(t,) for t in texts], "t string", F.unix_micros(read_time("t")))]
    assert got[:4] == [1437914711096757] * 4 and got[4] == 1437868800000000 and got[5:] == [None] * 5


def test_strip_words_hash_and_uuid(spark):
    texts = ["  a b ", " x\ty\n", "", None, "é \x1c z"]
    got = one(spark, [(t,) for t in texts], "t string", strip("t"), words("t"), bucket_10000("t"), uuid5_dns(F.col("t")))
    for t, (s, w, b, u) in zip(texts, got):
        if t is None:
            assert (s, w, b, u) == (None, [], None, None)
        else:
            assert s == t.strip() and w == t.split() and u == str(uuid.uuid5(uuid.NAMESPACE_DNS, t))
            assert b == int(hashlib.sha256(t.encode()).hexdigest(), 16) % 10000


def test_cosine(spark):
    assert one(spark, [([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 2.0]), (None, [1.0])], "a array<double>, b array<double>", cosine(F.col("a"), F.col("b"))) == [(1.0,), (0.0,), (None,)]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9), st.integers(1, 40), st.booleans(), st.integers(0, 2**32 - 1))
def test_png_round_trip(h, w, rgb, seed):
    a = np.random.default_rng(seed).integers(0, 256, (h, w, 3) if rgb else (h, w), dtype=np.uint8)
    assert np.array_equal(decode(encode(a)), a)
    assert gray(decode(encode(a))).shape == (h, w)


@pytest.mark.parametrize("data", [None, b"", b"abc", encode(np.zeros((4, 4), np.uint8))[:40], encode(np.zeros((4, 4), np.uint8))[:-13], encode(np.zeros((4, 4), np.uint8)).replace(b"IDAT", b"IDAU")])
def test_broken_pngs(data):
    with pytest.raises(BrokenPng):
        decode(data)


def test_regions_at_their_thresholds():
    page = np.full((100, 100), 255, np.uint8)
    page[10:25, 20:75] = 0  # 15 rows high
    page[40:54, 20:75] = 0  # 14 rows: too low
    page[80:100, 2:60] = 0  # to the bottom
    assert kernels.regions(page) == [(15, 10, 79, 25), (0, 80, 64, 100)]  # the right edge is the last dark column plus the padding
    assert kernels.regions(np.full((50, 50), 255, np.uint8)) == []


def test_augmentation_repeats_itself():
    g = np.full((32, 90), 230, np.uint8)
    g[10:20, 10:60] = 40
    assert np.array_equal(kernels.augment(g, 7), kernels.augment(g, 7)) and kernels.augment(g, 7).shape == g.shape
    assert not np.array_equal(kernels.augment(g, 7), kernels.augment(g, 8))
    assert len(kernels.average_hash(g)) == 64 and len(kernels.grid_feature(g)) == 64
    assert len(kernels.regions(kernels.compose_page(["a line of text here", "another one"], 1))) == 2
