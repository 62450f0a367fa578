"""Queries that write: snapshots with manifests, archives, event tables; and reports as documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.text import sql_bucket
from ..functions.times import read_time
from ..operators import corrections as op
from ..operators import drift, images, quality
from ..session import read_table, shared_dir, stage
from ..sources.archive import read_archive, read_shards, write_snapshot
from ..streaming.jobs import TIMES, archive_rows, dedup_by_gap, into_table, read_topic, replayed
from .checks import _split, checked
from .corrections import _ELIGIBLE, _REASON, _latest
from .feedback import _PAIRS, _pairs
from .registry import CORE
from .views import AT_SQL, CORR, SESS, corrections, documents, sessions

SAMPLE = 50
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _folder(spark, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


# reports


@CORE.add("ingestion_report")
def ingestion_report(spark, sf_dir):
    """K05 Q-I3 Q-EXIT O05: the checks of the pictures as one JSON document with status and exit code."""
    return report(read_table(spark, sf_dir, "line_images"), "line_images")


def report(rows, dataset: str, base: str | None = None):
    """``dataset, status, exit_code, document`` of a table of pictures, whether it passes or not; written below ``base`` if given.

    To the checks of ``checked`` comes that all of a sample of 50 pictures, by hash, decode. Without rows only the first
    check counts and the status is SKIP; without a required column the checks after it do not run.
    """
    each = checked(rows).where("check_name <> 'all'")
    if {"image_id", "image_png"} <= set(rows.columns):
        some = rows.select(F.col("image_id").cast("string").alias("image_id"), "image_png").orderBy(F.xxhash64("image_id"), "image_id", F.xxhash64("image_png")).limit(SAMPLE)  # the sample is the check
        s = images.picture_stats(some, "image_id", "image_png").agg(F.count("*").alias("n"), F.sum(F.col("decodes").cast("int")).alias("k"))
        ok = F.col("k") == F.col("n")
        each = each.union(s.select(F.lit("I3 pictures decode"), F.when(F.col("n") == 0, "SKIP").when(ok, "PASS").otherwise("FAIL"), F.when((F.col("n") == 0) | ok, 0).otherwise(1)))
    empty = F.max((F.col("check_name") == "I0 any rows") & (F.col("status") == "FAIL"))
    status = F.when(empty, "SKIP").when(F.max("exit_code") == 0, "PASS").otherwise("FAIL")
    lists = F.sort_array(F.collect_list(F.struct("check_name", "status")))  # a handful of checks
    one = each.agg(status.alias("status"), lists.alias("checks")).withColumn("dataset", F.lit(dataset))
    one = one.select("dataset", "status", F.when(F.col("status") == "FAIL", 1).otherwise(0).alias("exit_code"), F.to_json(F.struct("dataset", "status", "checks")).alias("document"))
    if base:
        one = stage(one)
        one.select("document").coalesce(1).write.mode("overwrite").text(f"{base}/_validation")
    return one


_HTR_RULES = '"candidate_selection":{"opted_in":true,"non_empty_text":true,"exclude_test_synthetic":true,"exclude_deleted":true,"dedup_by_region":"keep_latest"},"leakage_prevention":{"split_method":"document_grouped_hash","val_fraction":0.2}'
_SPLIT = f"case when {sql_bucket('document_id')} < 2000 then 'val' else 'train' end"
_MANIFEST = "'{" + _HTR_RULES + ""","counts":{"train":' || train || ',"val":' || val || ',"total":' || (train + val) || '},"shards":{"train":' || cast(ceil(train / 500.0) as bigint) || ',"val":' || cast(ceil(val / 500.0) as bigint)
    || '},"data_quality":{"R1":' || r1 || ',"R2":' || r2 || ',"R3":' || r3 || ',"R5":' || r5 || '}}'"""


@CORE.add(
    "snapshot_manifest",
    f"""with {_ELIGIBLE}, j as (select *, {_REASON} end as reason, {_SPLIT} as split from latest), n as (select count(*) filter (reason is null and split = 'train') as train, count(*) filter (reason is null and split = 'val') as val,
      count(*) filter (reason = 'R1') as r1, count(*) filter (reason = 'R2') as r2, count(*) filter (reason = 'R3') as r3, count(*) filter (reason = 'R5') as r5 from j)
    select train, val, train + val as total, r1 + r2 + r3 + r5 as rejected, {_MANIFEST} as manifest from n""",
)
def snapshot_manifest(spark, sf_dir):
    """The manifest of a training snapshot: rules of selection and against leakage, counts, shards of 500, rejections; in one pass."""
    j = op.document_split(_latest(spark, sf_dir).withColumn("reason", quality.reason()))
    n = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    good = F.col("reason").isNull()
    a = j.agg(n(good & (F.col("split") == "train")).alias("train"), n(good & (F.col("split") == "val")).alias("val"), *(n(F.coalesce(F.col("reason") == r, F.lit(False))).alias(r) for r in ("R1", "R2", "R3", "R5")))
    shards = lambda c: F.ceil(F.col(c) / 500).cast("string")
    text = lambda c: F.col(c).cast("string")
    total = F.col("train") + F.col("val")
    body = F.concat(
        F.lit("{" + _HTR_RULES + ',"counts":{"train":'), text("train"), F.lit(',"val":'), text("val"), F.lit(',"total":'), total.cast("string"), F.lit('},"shards":{"train":'), shards("train"), F.lit(',"val":'), shards("val"),
        F.lit('},"data_quality":{"R1":'), text("R1"), F.lit(',"R2":'), text("R2"), F.lit(',"R3":'), text("R3"), F.lit(',"R5":'), text("R5"), F.lit("}}"),
    )
    return a.select("train", "val", total.alias("total"), (F.col("R1") + F.col("R2") + F.col("R3") + F.col("R5")).alias("rejected"), body.alias("manifest"))


# snapshots and shards


@CORE.add("snapshot_files", f"with {_PAIRS} select split, count(*) as n_rows, count(*) as n_scanned, true as within_limit, 'v_20160201_000000' as version from pairs group by 1")
def snapshot_files(spark, sf_dir):
    """The labelled pairs written as a version in shards of at most 500 rows, and read back whole and split by split."""
    base, version = _folder(spark, "snapshot"), "v_20160201_000000"
    write_snapshot(_pairs(spark, sf_dir).drop("queried_at"), base, version)
    per_file = read_shards(spark, f"{base}/{version}/data").withColumn("file", F.input_file_name()).groupBy("file").agg(F.count("*").alias("k"))
    split = F.regexp_extract("file", "/split=([^/]+)/", 1)
    whole = per_file.groupBy(split.alias("split")).agg(F.sum("k").alias("n_rows"), (F.max("k") <= 500).alias("within_limit"))
    single = None
    for s in ("train", "val"):
        try:
            one = read_shards(spark, f"{base}/{version}/data", f"split={s}").agg(F.count("*").alias("n_scanned")).withColumn("split", F.lit(s))
        except Exception as e:  # a split without rows has no folder
            if "PATH_NOT_FOUND" not in str(e):
                raise
            continue
        single = one if single is None else single.union(one)
    return whole.join(single, "split").select("split", "n_rows", "n_scanned", "within_limit", F.lit(version).alias("version"))


# archive


def _archived(spark, sf_dir, target: str):
    rows = corrections(spark, sf_dir).where("correction_id is not null").withColumn("corrected_at", F.date_format("at", _ISO))
    archive_rows(rows.drop("archived_at", "excluded_from_training"), target, "correction_id", "at")


@CORE.add(
    "archived_training_set",
    f"""with {_ELIGIBLE} select region_id, crop_s3_url, corrected_text, coalesce(original_text, '') as original_text, {_SPLIT} as split, strftime(make_timestamp(us), '%Y-%m-%d') as correction_date
    from (select *, {_REASON} end as reason from latest) where reason is null""",
)
def archived_training_set(spark, sf_dir):
    """From the table into the JSON archive and from the archive to the training set."""
    target = _folder(spark, "archive")
    _archived(spark, sf_dir, target)
    rows = read_archive(spark, target, lines=True).withColumn("at", read_time("corrected_at"))
    latest = op.newest_per_region(op.eligible(rows, documents(spark, sf_dir)))
    good = op.document_split(latest.withColumn("reason", quality.reason()).where("reason is null"))
    return good.select("region_id", "crop_s3_url", "corrected_text", F.coalesce("original_text", F.lit("")).alias("original_text"), "split", F.date_format("at", "yyyy-MM-dd").alias("correction_date"))


@CORE.add("archive_job", f"with {CORR} select correction_id, archived_at is null as newly_archived from corr where correction_id is not null")
def archive_job(spark, sf_dir):
    """The pending corrections go to the archive and are marked; the job run again finds them there and adds none."""
    target = _folder(spark, "archive")
    c = corrections(spark, sf_dir).where("correction_id is not null")
    pending = c.where("archived_at is null").withColumn("corrected_at", F.date_format("at", _ISO))
    for _ in range(2):
        archive_rows(pending, target, "correction_id", "at")
    # counted, not deduplicated: a row archived twice would come out twice
    there = read_archive(spark, target, lines=True).select("correction_id").withColumn("newly_archived", F.lit(True))
    return c.select("correction_id").join(there, "correction_id", "left").select("correction_id", F.coalesce("newly_archived", F.lit(False)).alias("newly_archived"))


# events


def _event_rows(spark, sf_dir) -> dict:
    """The four kinds of events as the API sends them, from the tables."""
    iso = lambda c: F.date_format(F.col(c).cast("timestamp"), _ISO).alias(c)
    d, c, q, f = (read_table(spark, sf_dir, t) for t in ("documents", "corrections", "query_sessions", "search_feedback"))
    return {
        "uploads": d.select(F.col("id").alias("document_id"), "page_count", iso("uploaded_at"), "source"),
        "corrections": c.select("region_id", F.lit(None).cast("string").alias("document_id"), "corrected_text", F.date_format(read_time("corrected_at"), _ISO).alias("corrected_at"), "opted_in"),
        "queries": q.select(F.col("id").alias("session_id"), "query_text", iso("queried_at"), "result_doc_ids"),
        "feedback": f.select("session_id", "document_id", "feedback_type", iso("created_at")),
    }


@CORE.add(
    "event_topics",
    """select 'uploads' as topic, count(*) as n, count(distinct id) as n_keys from documents where uploaded_at is not null union all select 'queries', count(*), count(distinct id) from query_sessions where queried_at is not null
    union all select 'feedback', count(*), count(distinct session_id) from search_feedback where created_at is not null""",
)
def event_topics(spark, sf_dir):
    """Events published as JSON, consumed from each topic into a table by batches, and counted; events without a time are dropped."""
    base, out = _folder(spark, "topics"), None
    keys = {"uploads": "document_id", "queries": "session_id", "feedback": "session_id"}
    for topic, rows in _event_rows(spark, sf_dir).items():
        if topic not in keys:
            continue
        rows.write.json(f"{base}/{topic}")
        into_table(read_topic(spark, topic, f"{base}/{topic}"), f"{base}/tables/{topic}", f"{base}/state/{topic}").awaitTermination()
        one = spark.read.parquet(f"{base}/tables/{topic}").agg(F.lit(topic).alias("topic"), F.count("*").alias("n"), F.countDistinct(keys[topic]).alias("n_keys"))
        out = one if out is None else out.union(one)
    return out


@CORE.add("published_corrections", f"select strftime(make_timestamp(us), '%Y-%m-%d') as day, count(*) as n from (select epoch_us({AT_SQL}) as us from corrections) where us is not null group by 1")
def published_corrections(spark, sf_dir):
    """Corrections published to their topic and consumed through a file sink, counted by day."""
    base = _folder(spark, "topic")
    _event_rows(spark, sf_dir)["corrections"].write.json(f"{base}/corrections")
    got = replayed(read_topic(spark, "corrections", f"{base}/corrections").select(TIMES["corrections"], "event_time"), base)
    return got.groupBy(F.date_format("event_time", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@CORE.add(
    "stream_reformulations",
    f"with {SESS} select id, user_id, query_text from (select *, lag(queried_at) over (partition by user_id, query_text order by queried_at, id) as p from sess where queried_at is not null) where p is null or queried_at > p + interval 5 minutes",
)
def stream_reformulations(spark, sf_dir):
    """Searches not repeated within five minutes by the same user, by a stream that holds the last time of each key."""
    base = _folder(spark, "searches")
    s = sessions(spark, sf_dir).where("queried_at is not null").select("id", "user_id", "query_text", F.col("queried_at").cast("timestamp").alias("queried_at"))
    s.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(s.schema).parquet(f"{base}/in")
    return replayed(dedup_by_gap(stream, ["user_id", "query_text"], "queried_at", 5), base).select("id", "user_id", "query_text")


# pictures


@CORE.add("crop_objects", "select image_id, least(octet_length(image_png), 1024) as n_bytes, octet_length(image_png) > 1024 as is_cut from line_images where image_png is not null")
def crop_objects(spark, sf_dir):
    """The crops as the event API stores them, the first 1,024 bytes of a picture, and whether that cuts it off."""
    i = read_table(spark, sf_dir, "line_images").where("image_png is not null")
    crop = F.substring("image_png", 1, 1024)
    return i.select("image_id", F.octet_length(crop).alias("n_bytes"), (F.octet_length("image_png") > 1024).alias("is_cut"))


@CORE.add("drift_reference")
def drift_reference(spark, sf_dir):
    """The reference of a drift detector: count, mean and deviation of each of the 64 grid features over the training pictures."""
    i = read_table(spark, sf_dir, "line_images").where(_split() == "train").select("image_id", "image_png").distinct()
    f = images.drift_features(i, "image_id", "image_png").select(F.posexplode("feature").alias("place", "x"))
    return f.groupBy("place").agg(F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("mean"), F.round(F.stddev_pop("x"), 6).alias("deviation"))


@CORE.add("drift_pictures")
def drift_pictures(spark, sf_dir):
    """Windows of twenty validation and test pictures against 500 training pictures, with a threshold from permutations."""
    i = read_table(spark, sf_dir, "line_images").select("image_id", "image_png", _split().alias("split")).distinct()
    of = lambda where: images.drift_features(i.where(where), "image_id", "image_png")
    return drift.drift_windows(of("split = 'train'"), of("split in ('validation', 'test')"))
