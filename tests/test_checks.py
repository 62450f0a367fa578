"""Drift and reports on rows that the tables here do not hold."""

import random

import numpy as np

from foliospark.functions.png import encode
from foliospark.plans.checks import discrepancy
from foliospark.plans.images import split_report
from foliospark.plans.sessions import p4_queries


def _vectors(spark, sides, shift):
    r = random.Random(4)
    rows = [(i, ref, [r.gauss(0.0 if ref else shift, 0.5) for _ in range(4)]) for i, ref in enumerate(sides)]
    return spark.createDataFrame(rows, "vec_id bigint, ref boolean, embedding array<float>")


def test_drift_of_sides_in_id_ranges_of_their_own_and_of_unequal_size(spark):
    apart = [True] * 201 + [False] * 603
    got = discrepancy(_vectors(spark, apart, 1.0)).first()
    assert (got.n_ref, got.n_new, got.n_blocks, got.drift) == (201, 603, 50, True)
    assert discrepancy(_vectors(spark, apart, 0.0)).first().drift is False
    got = discrepancy(_vectors(spark, [True] * 20, 0.0)).first()
    assert (got.n_ref, got.n_new, got.n_blocks, got.drift) == (20, 0, 0, None)


def test_report_compares_an_augmented_split_with_its_base(spark):
    def picture(k, light):
        return bytearray(encode(np.random.default_rng(k).integers(light, light + 100, (16, 32), np.uint8)))

    rows = [(f"{s}{k}", s, picture(hash_ * 100 + k, light)) for hash_, (s, light) in enumerate((("train", 20), ("Train_augmented ", 120), ("val", 50), ("validation_augmented", 55), ("test", 9))) for k in range(5)]
    got = {r.split: r for r in split_report(spark.createDataFrame(rows, "image_id string, split string, image_png binary")).collect()}
    assert set(got) == {"train", "train_augmented", "validation", "validation_augmented", "test"}
    assert 95 < got["train_augmented"].mean_drift < 105 and got["train_augmented"].std_drift < 3 and not got["train_augmented"].passed
    assert got["validation_augmented"].mean_drift < 10 and got["validation_augmented"].passed
    assert got["train"].mean_drift is None and got["train"].passed


def test_searches_without_an_id_keep_their_texts(spark, tmp_path):
    u, a = "0" * 31 + "1", "0" * 31 + "a"
    rows = [(None, "one", 10, u), (None, "two", 20, u), ("no id", "three", 30, u), (a, "four", 40, u), (a, "four", 40, u)]
    q = spark.createDataFrame(rows, "id string, query_text string, s bigint, user_id string").selectExpr("id", "query_text", "cast(timestamp_seconds(s) as timestamp_ntz) as queried_at", "user_id")
    q.write.parquet(f"{tmp_path}/query_sessions.parquet")
    got = p4_queries(spark, str(tmp_path)).collect()
    assert sorted((x.query_text, x.session_no) for x in got) == [("four", 1), ("one", 1), ("three", 1), ("two", 1)]
