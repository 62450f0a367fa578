"""The rules' behaviours, one by one."""

import json

import pytest
from pyspark.sql import functions as F

from foliospark.operators import quality
from foliospark.operators.corrections import as_of, document_split, newest_per_region

SCHEMA = "correction_id string, region_id string, corrected_text string, original_text string, crop_s3_url string, object_exists boolean"
GOOD = dict(correction_id="c", region_id="r", corrected_text="hello world", original_text="helo wrld", crop_s3_url="s3://images/abc/def.png", object_exists=True)


def judge(spark, *rows, listing=False):
    df = spark.createDataFrame([tuple({**GOOD, **r}.values()) for r in rows], SCHEMA)
    return [x[0] for x in df.select(quality.reason(listing)).collect()]


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None), ({"corrected_text": "hello", "original_text": "hello"}, "R1"), ({"corrected_text": "Hello", "original_text": "hello"}, "R1"), ({"corrected_text": "  hello  ", "original_text": "hello"}, "R1"),
        ({"original_text": ""}, None), ({"original_text": None}, None), ({"corrected_text": " \t\n"}, "R2"), ({"corrected_text": "  "}, "R2"), ({"corrected_text": ""}, "R2"), ({"corrected_text": None}, "R2"),
        ({"crop_s3_url": "http://x/y"}, "R3"), ({"crop_s3_url": ""}, "R3"), ({"crop_s3_url": None}, "R3"), ({"crop_s3_url": "images/abc"}, "R3"), ({"crop_s3_url": "S3://a/b"}, "R3"), ({"crop_s3_url": "s3://bucketonly"}, None),
        ({"corrected_text": "x" * 10_000}, "R5"), ({"corrected_text": "x" * 2000}, None), ({"corrected_text": "x" * 2001}, "R5"), ({"corrected_text": "", "original_text": ""}, "R2"), ({"object_exists": False}, None),
    ],
)
def test_rules(spark, change, reason):
    assert judge(spark, change) == [reason]


def test_listing(spark):
    assert judge(spark, {"object_exists": False}, {}, {"object_exists": None}, {"crop_s3_url": "s3://bucketonly"}, listing=True) == ["R4", None, "R4", "R3"]


def test_report(spark):
    rows = [tuple({**GOOD, "correction_id": f"{i:02d}", "corrected_text": " "}.values()) for i in range(20)] + [tuple({**GOOD, "correction_id": "z", "crop_s3_url": "bad", "corrected_text": "y" * 100}.values())]
    r = quality.report(spark.createDataFrame(rows, SCHEMA).withColumn("reason", quality.reason()), "correction_id").collect()
    by = {x.reason: (x.n, list(x.samples)) for x in r}
    assert by["R2"] == (20, [" "] * 5) and by["R3"] == (1, ["y" * 80]) and json.dumps(by)
    assert quality.report(spark.createDataFrame([], SCHEMA).withColumn("reason", quality.reason()), "correction_id").count() == 0


def test_newest_per_region_breaks_ties_by_id(spark):
    rows = [("a", "r", "2016-01-01 00:00:00", "t", "u"), ("b", "r", "2016-01-02 00:00:00", "t", "u"), ("c", "r", "2016-01-02 00:00:00", "t", "u"), ("d", "q", None, "t", "u"), ("e", None, "2016-01-02 00:00:00", "t", "u")]
    df = spark.createDataFrame(rows, "correction_id string, region_id string, at string, corrected_text string, crop_s3_url string").withColumn("at", F.col("at").cast("timestamp"))
    assert sorted(x.correction_id for x in newest_per_region(df).collect()) == ["b", "d"]


def test_as_of_takes_the_newest_not_later(spark):
    e = spark.createDataFrame([("d", f"e{i}", i * 10) for i in range(5)] + [("x", "e9", 3), (None, "e8", 1)], "doc string, id string, t int")
    v = spark.createDataFrame([("d", 5, "one"), ("d", 20, "two"), ("d", 99, "three")], "doc string, at int, text string")
    got = {x.id: x.text for x in as_of(e, v, "doc", "t", "at", "text").collect()}
    assert got == {"e0": None, "e1": "one", "e2": "two", "e3": "two", "e4": "two", "e9": None}


def test_document_split_share(spark):
    df = document_split(spark.range(4000).select(F.col("id").cast("string").alias("document_id")))
    assert 0.17 < df.where("split = 'val'").count() / 4000 < 0.23
