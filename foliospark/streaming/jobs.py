"""Structured Streaming jobs on event files: reading, archiving, alerts, deduplication."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Schemas of the four event topics as sent.
SCHEMAS = {
    "uploads": "document_id string, page_count int, uploaded_at string, source string",
    "corrections": "region_id string, document_id string, corrected_text string, corrected_at string, opted_in boolean",
    "queries": "session_id string, query_text string, queried_at string, result_doc_ids array<string>",
    "feedback": "session_id string, document_id string, feedback_type string, created_at string",
}
TIMES = {"uploads": "uploaded_at", "corrections": "corrected_at", "queries": "queried_at", "feedback": "created_at"}


def read_topic(spark: SparkSession, topic: str, path: str) -> DataFrame:
    """A stream of one topic's JSON events with ``event_time``; malformed events have only nulls and are dropped."""
    s = spark.readStream.schema(SCHEMAS[topic]).option("mode", "PERMISSIVE").json(path)
    t = s.withColumn("event_time", F.col(TIMES[topic]).try_cast("timestamp"))
    return t.where("event_time is not null")


def kafka_topic(spark: SparkSession, topic: str, servers: str) -> DataFrame:
    """The same from Kafka, where its connector is on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.from_json(F.col("value").cast("string"), SCHEMAS[topic]).alias("e")).select("e.*").withColumn("event_time", F.col(TIMES[topic]).try_cast("timestamp"))


def archive_rows(rows: DataFrame, target: str, key: str, date_col: str) -> None:
    """Appends rows not yet archived as JSON under ``date=`` folders; rows given again add nothing.

    Only the keys archived under the rows' own dates are read back.
    """
    spark = rows.sparkSession
    out = rows.withColumn("date", F.coalesce(F.date_format(date_col, "yyyy-MM-dd"), F.lit("unknown"))).dropDuplicates([key])
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    if path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        dates = [r[0] for r in out.select("date").distinct().collect()]  # the days of one batch
        kinds = dict(rows.dtypes)
        old = spark.read.schema(f"{key} {kinds[key]}, date string").json(target).where(F.col("date").isin(dates)).select(key).distinct()
        out = out.join(old, key, "left_anti")
    out.write.mode("append").partitionBy("date").json(target)


def archive(stream: DataFrame, target: str, checkpoint: str, key: str, date_col: str = "event_time"):
    """``archive_rows`` of every batch of a stream; the same event twice has the same date, so replays add nothing."""
    write = lambda batch, _: archive_rows(batch, target, key, date_col)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replayed(stream: DataFrame, base: str) -> DataFrame:
    """A stream run until its source is read, its rows as a table below ``base``."""
    schema, spark = stream.schema, stream.sparkSession
    q = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/out")


def score_stream(log: DataFrame, reference: DataFrame, value: str, limit: float = 3.0) -> DataFrame:
    """``log`` with score and is_drift: how many deviations a value lies off the mean of ``reference`` (one row: m, d); nulls are left out."""
    score = F.abs(F.col(value) - F.col("m")) / F.col("d")
    return log.where(F.col(value).isNotNull()).crossJoin(F.broadcast(reference)).withColumn("score", score).withColumn("is_drift", score > limit).drop("m", "d")


def into_table(stream: DataFrame, table: str, checkpoint: str):
    """Appends a stream to a Parquet table batch by batch; a batch that is tried again replaces its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drift_windows(events: DataFrame, ts: str, watermark: str = "10 minutes") -> DataFrame:
    """Events in sliding windows of five minutes, every minute; late ones beyond the watermark are dropped when streamed."""
    e = events.withWatermark(ts, watermark) if events.isStreaming else events
    return e.groupBy(F.window(ts, "5 minutes", "1 minute").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", (F.col("n") / 300.0).alias("rate"))


def session_windows(events: DataFrame, ts: str, user: str, gap: str = "30 minutes", watermark: str = "10 minutes") -> DataFrame:
    """Session windows of each user; append mode closes them after the watermark."""
    e = events.withWatermark(ts, watermark) if events.isStreaming else events
    return e.groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count("*").alias("n")).select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def dedup_by_gap(stream: DataFrame, keys: list[str], ts: str, minutes: int = 5, hold_hours: int = 24) -> DataFrame:
    """Drops an event within ``minutes`` of the one before of the same keys; state ends ``hold_hours`` after the watermark.

    Within a batch events are put in time order; one that comes after a later one of its key is compared with the
    newest seen and, being older, dropped when it lies within the gap of it.
    """
    gap = pd.Timedelta(minutes=minutes)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(parts))
        rows = rows.sort_values([ts, *(c for c in rows.columns if c == "id")], kind="stable")  # equal times by id
        last = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        keep = []
        for t in rows[ts]:
            t = pd.Timestamp(t)
            keep.append(last is None or t - last > gap or last - t > gap)
            last = t if last is None else max(last, t)
        state.update((int(last.value // 1000),))
        mark = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(mark + 1, int(last.value // 1_000_000)) + hold_hours * 3_600_000)
        yield rows[keep]

    return stream.withWatermark(ts, "10 minutes").groupBy(*keys).applyInPandasWithState(step, stream.schema, "last_us bigint", "append", GroupStateTimeout.EventTimeTimeout)
