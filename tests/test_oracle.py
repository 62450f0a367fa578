"""Every core query with SQL equals it on the smallest tables; those on pictures agree with pictures decoded here."""

import os
from collections import Counter

import numpy as np
import pytest

from foliospark.functions import kernels
from foliospark.functions.png import BrokenPng, decode, gray
from foliospark.plans import load_all

from .conftest import DATA

CORE = load_all()


@pytest.mark.parametrize("name", sorted(CORE.sql))
def test_equals_sql(name, same):
    same(CORE.queries[name], CORE.sql[name])


@pytest.fixture(scope="module")
def pictures(duck):
    """(image_id, split, gray picture or None) of every row."""
    out = []
    for i, s, png in duck.execute("select image_id, lower(trim(split)), image_png from line_images").fetchall():
        try:
            out.append((i, s, gray(decode(png))))
        except BrokenPng:
            out.append((i, s, None))
    return out


def _stats(df, pics):
    got = Counter((r.image_id, r.decodes, r.height, r["mean"], r.average_hash) for r in df.collect())
    assert got == Counter((i, g is not None, None if g is None else g.shape[0], None if g is None else round(float(g.mean()), 2), None if g is None else kernels.average_hash(g)) for i, _, g in pics)


def _roundtrip(df, pics):
    n = sum(g is not None for *_, g in pics)
    assert tuple(df.collect()[0]) == (len(pics), n, n) and 0 < n <= len(pics)


def _report(df, pics):
    got = {r.split: (r.n, r["mean"]) for r in df.collect()}
    for split in {s for _, s, _ in pics}:
        means = [round(float(g.mean()), 2) for _, s, g in pics if s == split and g is not None]
        if split not in ("val", "validation") and means:
            assert got[split][0] == len(means) and abs(got[split][1] - np.mean(means)) < 0.006


def _regions(df, pics):
    got = Counter((r.image_id, tuple(r.bbox)) for r in df.collect())
    assert got == Counter((i, b) for i, _, g in pics if g is not None for b in kernels.regions(g))


def _augmented(df, pics):
    rows = df.collect()
    assert all(g is not None for g in (decode(r.image_png) for r in rows[:20]))
    ids = {i for i, s, g in pics if g is not None and s in ("train", "validation", "val", "test")}
    assert len(rows) % 3 == 0 and {r.image_id[:-5] for r in rows} <= ids and len(rows) >= 0.95 * 3 * len(ids)
    assert {r.split for r in rows} == {"train_augmented", "validation_augmented", "test_augmented"}


def _features(df, pics):
    got = {r.image_id: r.feature for r in df.collect()}
    some = {i: g for i, _, g in pics if g is not None}
    assert set(got) == set(some) and all(len(f) == 64 for f in got.values())
    k = min(some)
    assert np.allclose(got[k], kernels.grid_feature(some[k])) or sum(i == k for i, *_ in pics) > 1


def _reference(df, pics):
    rows = df.collect()
    assert sorted(r.place for r in rows) == list(range(64)) and len({r.n for r in rows}) == 1 and all(0 <= r["mean"] <= 1 for r in rows)


def _windows(df, pics):
    rows = df.collect()
    n = sum(g is not None for _, s, g in set((i, s, None if g is None else g.tobytes()) for i, s, g in pics) if s in ("val", "validation", "test"))
    assert rows and all(r.n <= 20 for r in rows) and sum(r.n for r in rows) >= n - 21 and len({r.threshold for r in rows}) == 1 and sorted(r.window_no for r in rows)[0] == 0


def _document(df, pics):
    (r,) = df.collect()
    assert r.status == "FAIL" and r.exit_code == 1 and "I3 pictures decode" in r.document  # the smallest tables have few rows a split


CHECKS = {
    "image_stats": _stats, "png_roundtrip": _roundtrip, "augmentation_report": _report, "region_features": _regions, "augment_expand": _augmented, "drift_features": _features,
    "drift_reference": _reference, "drift_pictures": _windows, "ingestion_report": _document,
}


@pytest.mark.parametrize("name", sorted(set(CORE.queries) - set(CORE.sql)))
def test_without_sql(name, spark, pictures):
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    CHECKS[name](CORE.queries[name](spark, DATA), pictures)
