"""Reports, snapshots, archives, orders and searches on small fixtures with known answers."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.functions import kernels
from foliospark.functions.png import decode, encode, gray
from foliospark.operators import corrections as corr
from foliospark.operators import drift, images
from foliospark.operators.order import numbered
from foliospark.operators.search import encoded, top_k
from foliospark.plans.events import alert_windows, traffic
from foliospark.plans.reports import report
from foliospark.session import drop_staged, shared_dir, stage
from foliospark.sources.archive import ensure_table, read_archive
from foliospark.streaming.jobs import archive_rows, score_stream

PICTURE = "image_id string, image_png binary, transcription string, split string"


def _pictures(spark, n, **other):
    png = encode(np.arange(40 * 60, dtype=np.uint8).reshape(40, 60))
    rows = [[f"i{k:03d}", png, "a line", ("train", "val")[k % 2]] for k in range(n)]
    for k, v in other.items():
        rows[7]["image_id image_png transcription split".split().index(k)] = v
    return spark.createDataFrame([tuple(r) for r in rows], PICTURE)


def test_report_passes_fails_and_skips(spark, tmp_path):
    def verdict(df):
        r = report(df, "lines").collect()
        assert len(r) == 1
        checks = {c["check_name"]: c["status"] for c in json.loads(r[0].document)["checks"]}
        return r[0].status, r[0].exit_code, checks

    status, code, checks = verdict(_pictures(spark, 240))
    assert (status, code) == ("PASS", 0) and set(checks.values()) == {"PASS"} and len(checks) == 6
    status, code, checks = verdict(_pictures(spark, 40))  # the sample takes all
    assert (status, code, checks["I1 rows per split"]) == ("FAIL", 1, "FAIL")
    status, code, checks = verdict(_pictures(spark, 40, image_png=b"\x89PNG broken"))
    assert checks["I3 pictures decode"] == "FAIL"
    assert verdict(_pictures(spark, 240).drop("transcription"))[2] == {"I0 any rows": "PASS", "I1 rows per split": "PASS", "I2 columns": "FAIL", "I3 pictures decode": "PASS"}
    assert verdict(_pictures(spark, 240).limit(0))[:2] == ("SKIP", 0)
    report(_pictures(spark, 240), "lines", str(tmp_path)).collect()
    assert json.loads(spark.read.text(f"{tmp_path}/_validation").first()[0])["status"] == "PASS"


def test_archive_adds_a_row_once(spark, tmp_path):
    rows = spark.createDataFrame([("c1", "2016-01-02 10:00:00"), ("c2", "2016-01-02 11:00:00"), ("c2", "2016-01-02 11:00:00"), ("c3", None)], "correction_id string, corrected_at string").withColumn("at", F.col("corrected_at").cast("timestamp"))
    for part in (rows.where("correction_id <> 'c1'"), rows, rows):
        archive_rows(part, str(tmp_path / "a"), "correction_id", "at")
    got = sorted((r.correction_id, str(r.date)) for r in read_archive(spark, str(tmp_path / "a"), lines=True).collect())
    assert got == [("c1", "2016-01-02"), ("c2", "2016-01-02"), ("c3", "unknown")]


def test_ensure_table_keeps_rows(spark, tmp_path):
    where = f"file://{tmp_path}/points"
    assert ensure_table(spark, "points_here", "id string, n int", where)
    try:
        spark.sql("insert into points_here values ('a', 1)")
        assert not ensure_table(spark, "points_here", "id string, n int", where) and spark.table("points_here").count() == 1
    finally:
        spark.sql("drop table points_here")


def test_alert_needs_two_windows_above_the_rate(spark):
    e = spark.range(61).select(F.timestamp_seconds(1_451_606_400 + F.col("id")).alias("ts"))  # 61 events in a minute and a second
    a = {str(r.start)[11:16]: (r.n, r.alert) for r in alert_windows(e).collect()}
    assert a["23:56"] == (60, False) and a["23:57"] == (61, False) and a["23:58"] == (61, True) and a["00:00"] == (61, True) and a["00:01"] == (1, False)


def test_traffic_is_paced_and_changes_its_mix(spark):
    t = traffic(spark, 50).cache()
    rows = t.orderBy("stream", "step").collect()
    waits = [b.at_us - a.at_us for a, b in zip(rows, rows[1:]) if a.stream == b.stream]
    assert 300_000 <= min(waits) and max(waits) <= 700_000 and max(r.at_us for r in rows) < 300_000_000
    share = {(r.phase, r.action): r.n for r in t.groupBy("phase", "action").agg(F.count("*").alias("n")).collect()}
    for phase, want in ((1, 0.70), (2, 0.25), (3, 0.10)):
        total = sum(v for (p, _), v in share.items() if p == phase)
        assert abs(share[phase, "upload"] / total - want) < 0.02


def test_running_numbers_in_groups_and_without(spark):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None, ""]), i * 7919 % 1000) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, x int").repartition(3)
    got = sorted(((x.g, x.x), x.n) for x in numbered(df, ["g"], ["x"], "n").collect() if x.g is not None)
    assert got == sorted(((g, x), sorted(y for h, y in rows if h == g).index(x) + 1) for g, x in rows if g is not None)
    assert sorted((x.x, x.n) for x in numbered(df, [], ["x"], "n").select("x", "n").collect()) == [(x, k + 1) for k, x in enumerate(sorted(x for _, x in rows))]
    assert numbered(df.limit(0), ["g"], ["x"], "n").count() == 0


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_search_equals_brute_force_with_and_without_broadcast(spark, bound):
    r = np.random.default_rng(1)
    v = np.round(r.normal(size=(60, 5)), 1)
    v[7] = 0.0
    v[9] = v[3]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(None, [1.0] * 5), (99, None)]
    df = spark.createDataFrame(rows, "i bigint, e array<float>")
    q = df.where("i % 10 = 0 or i = 7")
    got = {}
    for x in top_k(q, df, "i", "e", 4, broadcast_bytes=bound).collect():
        got.setdefault(x.query_id, []).append((-round(x.score, 12), x.vec_id))
    v = v.astype(np.float32).astype(np.float64)
    n = np.sqrt((v * v).sum(1))
    for i in [*range(0, 60, 10), 7]:
        s = [(-round(float(v[i] @ v[j] / (n[i] * n[j])), 12) if n[i] * n[j] else -0.0, j) for j in range(60)]
        assert [j for _, j in sorted(got[i])] == [j for _, j in sorted(s)[:4]]
    assert top_k(df.limit(0), df, "i", "e", 4, broadcast_bytes=bound).count() == 0


def test_as_of_with_a_hot_key_in_parts(spark):
    v = spark.createDataFrame([("d", 10, "a"), ("d", 20, "b"), ("e", 5, "c")], "k string, at int, x string")
    e = spark.createDataFrame([("d", i, i) for i in range(30)] + [("e", 5, 100), ("f", 9, 101), (None, 1, 102)], "k string, t int, id int")
    got = {r.id: r.x for r in corr.as_of(e, v, "k", "t", "at", "x", hot_rows=7).collect()}
    assert got == {**{i: None if i < 10 else "a" if i < 20 else "b" for i in range(30)}, 100: "c", 101: None}


def test_scores_against_a_reference(spark):
    ref = spark.createDataFrame([(10.0, 2.0)], "m double, d double")
    got = {r.i: (r.score, r.is_drift) for r in score_stream(spark.createDataFrame([(1, 13.0), (2, 17.0), (3, None)], "i int, value double"), ref, "value").collect()}
    assert got == {1: (1.5, False), 2: (3.5, True)}


# pictures, with values worked out by hand


def test_features_of_a_drawn_page(spark):
    page = np.full((100, 200), 255, np.uint8)
    page[10:26, 20:120] = 0  # 16 rows, 100 columns
    rgb = np.repeat(page[:, :, None], 3, axis=2)
    df = spark.createDataFrame([("g", encode(page)), ("c", encode(rgb)), ("x", b"no")], "image_id string, image_png binary")
    got = {r.image_id: r for r in images.region_features(df, "image_id", "image_png").collect()}
    assert set(got) == {"g", "c"}
    for r in got.values():
        # the box is padded by 5 on the left; on the right the last dark column, 119, plus 5 is where it ends
        assert r.bbox == [15, 10, 124, 26] and r.shape == [1, 128, 872]
        dark = 100 / 109
        assert abs(r["mean"] - (1 - 2 * dark)) < 0.01 and abs(r["std"] - 2 * (dark * (1 - dark)) ** 0.5) < 0.02


def test_changed_copies_keep_the_kind_of_picture(spark):
    g = np.full((40, 90), 250, np.uint8)
    g[10:30, 20:70] = 30
    c = np.stack([g, np.roll(g, 3, 1), g], axis=2)
    df = spark.createDataFrame([("g", encode(g), "t", "train"), ("c", encode(c), None, "test"), ("b", b"x", "t", "train")], PICTURE)
    rows = {r.image_id: r for r in images.augmented(df).collect()}
    assert set(rows) == {f"{i}_aug{k}" for i in "gc" for k in range(3)}
    assert all(decode(rows[f"g_aug{k}"].image_png).shape == (40, 90) and decode(rows[f"c_aug{k}"].image_png).shape == (40, 90, 3) for k in range(3))
    assert rows["c_aug1"].split == "test_augmented" and rows["c_aug1"].transcription is None
    assert np.array_equal(kernels.augment(g, 5), kernels.augment(g, 5))


def test_hashes_and_features_of_simple_pictures():
    half = np.full((16, 16), 200, np.uint8)
    half[:, 8:] = 20
    assert kernels.average_hash(half) == "11110000" * 8
    assert np.allclose(kernels.grid_feature(np.full((10, 30), 51, np.uint8)), 0.2)
    assert gray(np.array([[[255, 0, 0], [0, 255, 0], [0, 0, 255], [9, 9, 9]]], np.uint8)).tolist() == [[76, 150, 29, 9]]
    s = kernels.typed_strip(3)
    assert s.shape == (64, 512) and set(np.unique(s)) == {15, 245} and (s[:15] == 245).all()
    up = kernels.to_height(np.array([[0, 255]], np.uint8).repeat(2, 0), 4)
    assert up.shape == (4, 4) and (up == np.rint(up)).all()


def test_drift_is_seen_and_seldom_false(spark):
    r = np.random.default_rng(3)
    ref = spark.createDataFrame([(f"r{k}", r.normal(size=8).tolist()) for k in range(300)], "image_id string, feature array<double>")
    new = spark.createDataFrame([(f"n{k:03d}", (r.normal(size=8) + (1.0 if k >= 200 else 0.0)).tolist()) for k in range(401)], "image_id string, feature array<double>")
    rows = {x.window_no: (x.n, x.is_drift) for x in drift.drift_windows(ref, new).collect()}
    assert len(rows) == 20 and all(n == 20 for n, _ in rows.values())
    assert sum(d for w, (_, d) in rows.items() if w < 10) <= 1 and all(d for w, (_, d) in rows.items() if w >= 10)
    with pytest.raises(ValueError):
        drift.calibrated(np.zeros((30, 2)))


def test_any_encoder_and_tensors(spark):
    df = spark.createDataFrame([(1, "a bb"), (2, None), (3, "")], "doc_id bigint, text string")
    got = {r.id: r.embedding for r in encoded(df, "doc_id", "text", lambda: lambda texts: np.array([[len(t), t.count("b")] for t in texts]), batch=2).collect()}
    assert got == {1: [4.0, 2.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}
    p = spark.createDataFrame([("a", encode(np.full((10, 30), 51, np.uint8))), ("x", b"")], "image_id string, image_png binary")
    (t,) = images.tensors(p, "image_id", "image_png").collect()
    assert (t.image_id, t.height, t.width, len(t.pixels)) == ("a", 64, 512, 64 * 512) and np.allclose(t.pixels, 0.2)


def test_sample_of_pictures_that_decode(spark):
    df = _pictures(spark, 60).union(spark.createDataFrame([(f"x{k}", b"broken", "t", "val") for k in range(60)], PICTURE))
    a, b = ([r.image_id for r in images.sample_pictures(df, 20).collect()] for _ in range(2))
    assert a == b and len(set(a)) == 20 and all(x.startswith("i") for x in a)
    with pytest.raises(ValueError):
        images.sample_pictures(df, 61)


def test_staged_tables_can_be_dropped(spark):
    t = stage(spark.range(3))
    assert t.count() == 3 and shared_dir(spark)
    drop_staged()
    with pytest.raises(Exception, match="(?i)exist|not found"):
        spark.read.parquet(t.inputFiles()[0]).count()
