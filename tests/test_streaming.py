import json
import os

from pyspark.sql import functions as F

from foliospark.sources.archive import read_archive, read_shards, register_dataset, write_snapshot
from foliospark.streaming import jobs


def test_archive_is_idempotent_and_skips_broken_events(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    os.makedirs(src)
    rows = [{"region_id": f"r{i}", "corrected_text": "t", "corrected_at": f"2016-01-0{1 + i % 3}T00:00:00Z", "opted_in": True} for i in range(6)]
    (src / "a.json").write_text("\n".join(json.dumps(x) for x in rows) + "\n{broken\n")
    for k in range(2):  # a second stream without the first one's memory
        jobs.archive(jobs.read_topic(spark, "corrections", str(src)), out, str(tmp_path / f"state{k}"), "region_id").awaitTermination()
    assert spark.read.json(out).count() == 6
    assert sorted(x for x in os.listdir(out) if x.startswith("date=")) == ["date=2016-01-01", "date=2016-01-02", "date=2016-01-03"]


def test_gap_dedup_in_a_stream_equals_batch(spark, tmp_path):
    rows = [("u", "q", f"2016-01-01 00:{m:02d}:00") for m in (0, 3, 4, 12, 20, 21)] + [("v", "q", "2016-01-01 00:01:00")]
    df = spark.createDataFrame(rows, "user string, query string, t string").withColumn("t", F.col("t").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = jobs.dedup_by_gap(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), ["user", "query"], "t")
    q = s.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.user, r.t.minute) for r in spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect())
    assert got == [("u", 0), ("u", 12), ("u", 20), ("v", 1)]


def test_windows_streamed_equal_batch(spark, tmp_path):
    df = spark.range(200).select((F.lit("2016-01-01").cast("timestamp").cast("long") + F.col("id") * 37).cast("timestamp").alias("ts"), (F.col("id") % 3).alias("user"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    for name, fn in (("drift", lambda d: jobs.drift_windows(d, "ts")), ("sessions", lambda d: jobs.session_windows(d, "ts", "user", "1 minute"))):
        q = fn(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName(name).outputMode("complete").start()
        q.processAllAvailable()
        q.stop()
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, fn(df).collect()))


def test_snapshot_shards_and_registry(spark, tmp_path):
    df = spark.range(1201).select(F.col("id"), F.when(F.col("id") < 1100, "train").otherwise("val").alias("split"))
    m = write_snapshot(df, str(tmp_path), "v_20160101_000000", one_file_at_a_time=True)
    assert m["splits"] == {"train": {"rows": 1100, "shards": 3}, "val": {"rows": 101, "shards": 1}}
    assert read_shards(spark, f"{tmp_path}/v_20160101_000000/data").count() == 1201
    reg = spark.createDataFrame([("1", "a", "2016-01-01", 1), ("2", "b", "2016-01-01", 1)], "id string, name string, downloaded_at string, n int")
    new = spark.createDataFrame([("3", "a", "2016-02-01", 2)], "id string, name string, downloaded_at string, n int")
    assert sorted((x.name, x.n) for x in register_dataset(reg, new).collect()) == [("a", 2), ("b", 1)]


def test_archive_reading(spark, tmp_path):
    d = tmp_path / "date=2016-01-02"
    os.makedirs(d)
    (d / "a.json").write_text(json.dumps({"correction_id": "1", "corrected_text": "x"}, indent=2))
    (d / "b.json").write_text("{broken")
    (d / "c.txt").write_text("no json")
    assert [(x.correction_id, x.opted_in, str(x.date)) for x in read_archive(spark, str(tmp_path)).collect()] == [("1", None, "2016-01-02")]
