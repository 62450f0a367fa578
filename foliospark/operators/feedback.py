"""Search feedback to labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 1000
TYPES = ("click", "thumbs_up", "thumbs_down")


def explicit_feedback(fb: DataFrame, sess: DataFrame, docs: DataFrame, types=TYPES) -> DataFrame:
    """Feedback joined with its search and document; test accounts, deleted documents and other types left out."""
    s = sess.where("is_test_account = false").select(F.col("id").alias("session_id"), "query_text", "queried_at", "user_id")
    d = docs.where("deleted_at is null").select(F.col("id").alias("document_id"), F.col("merged_text").alias("doc_text"))
    return fb.where(F.col("feedback_type").isin(*types)).join(s, "session_id").join(d, "document_id")


def first_of_reformulations(rows: DataFrame) -> DataFrame:
    """One row for each user, query text and minute: the first, ties by session, document, type and id."""
    w = Window.partitionBy("user_id", "query_text", F.date_trunc("minute", "queried_at")).orderBy("queried_at", "session_id", "document_id", "feedback_type", "id")
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def labelled(rows: DataFrame, chars: int = 500) -> DataFrame:
    """Pairs with chunk text (the first ``chars`` code points, '(no text)' where there is none), label, date and id."""
    label = F.when(F.col("feedback_type").isin("click", "thumbs_up"), 1).otherwise(0)
    r = rows.withColumn("label", label)
    return r.select(
        F.substring(F.md5(F.concat_ws(":", "session_id", "document_id", F.col("label").cast("string"))), 1, 12).alias("triplet_id"),
        "session_id", "query_text", F.col("document_id").alias("doc_id"),
        F.when(F.coalesce("doc_text", F.lit("")) == "", "(no text)").otherwise(F.substring("doc_text", 1, chars)).alias("chunk_text"),
        "feedback_type", "label", F.date_format("queried_at", "yyyy-MM-dd").alias("query_date"), "queried_at",
    )


def time_split(rows: DataFrame, ts: str, as_of: str, days: int = 7) -> DataFrame:
    """``split``: train before as_of minus days, else val; exactly at the cutoff is val."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {days} days")
    return rows.withColumn("split", F.when(F.col(ts) < cutoff, "train").otherwise("val"))


def number(h, at: int):
    """Eight hexadecimal digits of a hash as a number."""
    return F.conv(F.substring(h, at, 8), 16, 10).cast("bigint")


def bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` with nb, the number of buckets for about ``BUCKET_ROWS`` each, and b, the bucket by the hash h."""
    total = rows.agg(F.greatest(F.lit(1), F.floor(F.count("*") / BUCKET_ROWS)).alias("nb"))
    return rows.crossJoin(F.broadcast(total)).withColumn("b", number(F.col("h"), 1) % F.col("nb"))  # one row


def synthetic_negatives(pairs: DataFrame) -> DataFrame:
    """For half of the positives a text of another positive, label 0, dropped where it equals the own text.

    Positives are dealt by hash into as many buckets as give each about ``BUCKET_ROWS``; within a bucket the first half by
    hash gets negatives, each from a bucket and place drawn by hash, so no step ranks more than a bucket in one task.
    """
    p = bucketed(pairs.where("label = 1 and chunk_text <> '(no text)'").withColumn("h", F.md5(F.concat_ws("|", "session_id", "doc_id", "feedback_type", "query_text"))))
    w = Window.partitionBy("b").orderBy("h", "triplet_id")
    ranked = p.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("b")))
    pool = ranked.select(F.col("b").alias("pb"), F.col("rn").alias("pick"), F.col("n").alias("pn"), F.col("chunk_text").alias("neg_text"))
    sizes = ranked.groupBy("b").agg(F.count("*").alias("pn")).withColumnRenamed("b", "pb")
    g = F.md5(F.concat("h", F.lit("neg")))
    want = ranked.where(F.col("rn") <= F.floor(F.col("n") / 2)).withColumn("pb", number(g, 1) % F.col("nb")).withColumn("z", number(g, 9))
    want = want.join(sizes, "pb")
    want = want.withColumn("pick", (F.col("z") % F.col("pn") + 1).cast("int"))
    got = want.join(pool.drop("pn"), ["pb", "pick"]).where("neg_text <> chunk_text")
    return got.select("session_id", "query_text", F.lit("synthetic_neg").alias("doc_id"), F.col("neg_text").alias("chunk_text"), F.lit(0).alias("label"), "query_date", "queried_at")


def gap_dedup(events: DataFrame, keys: list[str], ts: str, minutes: int = 5) -> DataFrame:
    """Events later than ``minutes`` after the one before of the same keys, and each first one."""
    w = Window.partitionBy(*keys).orderBy(ts, "id")
    prev = F.lag(ts).over(w)
    return events.withColumn("prev_ts", prev).where(F.col("prev_ts").isNull() | (F.col(ts) > F.col("prev_ts") + F.expr(f"interval {minutes} minutes"))).drop("prev_ts")
