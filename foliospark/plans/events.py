"""Queries on event streams, in their batch form, and a replay through Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.ids import norm_id, sql_id
from ..operators.order import numbered
from ..operators.sessions import GAP_US
from ..operators.sessions import sessions as by_gap
from ..session import read_table, shared_dir, stage
from ..streaming.jobs import drift_windows, replayed, score_stream
from .registry import CORE
from .views import SESS, sessions

#: Fixed value: events a second above which windows alert.
ALERT_RATE = 0.2


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@CORE.add(
    "drift_alert_windows",
    """with w as (select distinct e.event_id, date_trunc('minute', ts) - to_minutes(cast(k as int)) as start from events e, range(0, 5) r(k) where event_type = 'error'),
    c as (select start, count(*) as n from w group by 1), f as (select *, n / 300.0 > 0.2 as over from c),
    g as (select *, coalesce(lag(over) over (order by start) and lag(start) over (order by start) = start - interval 1 minute, false) as before from f)
    select start, n, over and before as alert from g""",
)
def drift_alert_windows(spark, sf_dir):
    """Windows of five minutes with more than 0.2 events a second, alerting when the window before did too."""
    return alert_windows(_events(spark, sf_dir).where("event_type = 'error'"))


def alert_windows(events):
    f = drift_windows(events, "ts").withColumn("over", F.col("rate") > ALERT_RATE)
    before = f.select((F.col("start") + F.expr("interval 1 minute")).alias("start"), F.col("over").alias("before"))
    return f.join(before, "start", "left").select(F.col("start").cast("timestamp_ntz").alias("start"), "n", (F.col("over") & F.coalesce("before", F.lit(False))).alias("alert"))


@CORE.add("drift_minute_median", "select date_trunc('minute', ts) as minute, round(median(value), 6) as median_value from events group by 1")
def drift_minute_median(spark, sf_dir):
    """The median of the statistic in tumbling windows of a minute."""
    e = _events(spark, sf_dir)
    return e.groupBy(F.window("ts", "1 minute")["start"].cast("timestamp_ntz").alias("minute")).agg(F.round(F.median("value"), 6).alias("median_value"))


#: Shares of upload, search, correction and feedback in the first fifth, the middle and the last fifth of a run.
_SHARES = ((70, 15, 10, 5), (25, 35, 20, 20), (10, 40, 15, 35))
_ACTIONS = ("upload", "search", "correction", "feedback")
STREAMS, DURATION_US, RATE = 20, 300_000_000, 2.0


def _draw(kind: str, of):
    """A number in [0, 1000000) drawn by hash."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{kind}:"), of)), 1, 8), 16, 10).cast("bigint") % 1_000_000


def traffic(spark, streams: int = STREAMS, duration_us: int = DURATION_US, rate: float = RATE):
    """``stream, step, at_us, phase, action``: generated traffic, the same on every run.

    Each stream waits 1 / rate seconds between actions, 0.2 more or less by chance and 0.1 at least, for ``duration_us``;
    the shares of the actions change after a fifth and four fifths of it.
    """
    pause = round(1_000_000 / rate)
    steps = duration_us // max(100_000, pause - 200_000) + 1
    e = spark.range(streams).select(F.col("id").alias("stream"), F.explode(F.sequence(F.lit(0), F.lit(int(steps)))).alias("step"))
    name = F.concat_ws("|", F.col("stream").cast("string"), F.col("step").cast("string"))
    e = e.withColumn("wait", F.greatest(F.lit(100_000), pause - 200_000 + F.floor(_draw("wait", name) * 400_000 / 1_000_000)))
    before = Window.partitionBy("stream").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("at_us", F.coalesce(F.sum("wait").over(before), F.lit(0))).where(F.col("at_us") < duration_us)
    phase = F.when(F.col("at_us") * 5 < duration_us, 1).when(F.col("at_us") * 5 < 4 * duration_us, 2).otherwise(3)
    e = e.withColumn("phase", phase).withColumn("u", _draw("action", name))
    action = F.lit(_ACTIONS[-1])
    for p, shares in enumerate(_SHARES, 1):
        upto, chosen = 0, None
        for k, share in enumerate(shares[:-1]):
            upto += share
            hit = F.col("u") < upto * 10_000
            chosen = F.when(hit, _ACTIONS[k]) if chosen is None else chosen.when(hit, _ACTIONS[k])
        action = F.when(F.col("phase") == p, chosen.otherwise(_ACTIONS[-1])).otherwise(action)
    return e.select("stream", "step", "at_us", "phase", action.alias("action"))


@CORE.add(
    "traffic_mix",
    """with s as (select s.i as stream, t.i as step, s.i || '|' || t.i as name from range(0, 20) s(i), range(0, 1001) t(i)),
    w as (select *, greatest(100000, 300000 + (cast('0x' || substr(md5('wait:' || name), 1, 8) as bigint) % 1000000) * 400000 // 1000000) as wait from s),
    e as (select *, coalesce(sum(wait) over (partition by stream order by step rows between unbounded preceding and 1 preceding), 0) as at_us from w),
    p as (select *, case when at_us < 60000000 then 1 when at_us < 240000000 then 2 else 3 end as phase, (cast('0x' || substr(md5('action:' || name), 1, 8) as bigint) % 1000000) / 1000000.0 as u from e where at_us < 300000000)
    select cast(phase as int) as phase, case when u < [0.70, 0.25, 0.10][phase] then 'upload' when u < [0.85, 0.60, 0.50][phase] then 'search' when u < [0.95, 0.80, 0.65][phase] then 'correction' else 'feedback' end as action, count(*) as n from p group by 1, 2""",
)
def traffic_mix(spark, sf_dir):
    """The actions of twenty generated streams of five minutes at two a second, counted by phase. Reads no table."""
    return traffic(spark).groupBy("phase", "action").agg(F.count("*").alias("n"))


@CORE.add("feedback_mix", "select case when u < 0.6 then 'click' when u < 0.85 then 'thumbs_up' else 'thumbs_down' end as feedback_type, count(*) as n from (select cast('0x' || substr(md5(cast(event_id as varchar)), 1, 8) as bigint) / 4294967296.0 as u from events) group by 1")
def feedback_mix(spark, sf_dir):
    """Feedback kinds drawn by hash in the shares 60, 25 and 15."""
    u = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), 16, 10).cast("double") / 4294967296.0
    return read_table(spark, sf_dir, "events").groupBy(F.when(u < 0.6, "click").when(u < 0.85, "thumbs_up").otherwise("thumbs_down").alias("feedback_type")).agg(F.count("*").alias("n"))


@CORE.add(
    "follow_up_traffic",
    f"""with {SESS}, s as (select id, user_id, queried_at, result_doc_ids as docs from sess where user_id is not null and queried_at is not null and len(result_doc_ids) > 0),
    r as (select *, row_number() over (partition by user_id order by queried_at, id) as k, cast('0x' || substr(md5('search:' || id), 1, 8) as bigint) as a, cast('0x' || substr(md5('doc:' || id), 1, 8) as bigint) as b, cast('0x' || substr(md5('kind:' || id), 1, 8) as bigint) % 100 as c from s)
    select n.id as after_session, o.id as session_id, {sql_id('o.docs[n.b % len(o.docs) + 1]')} as document_id, case when n.c < 60 then 'click' when n.c < 85 then 'thumbs_up' else 'thumbs_down' end as feedback_type
    from r n join r o on n.user_id = o.user_id and o.k = n.a % n.k + 1""",
)
def follow_up_traffic(spark, sf_dir):
    """After each search its user's feedback on a document of a search remembered so far, drawn by hash; searches without results are not remembered."""
    s = sessions(spark, sf_dir).where("user_id is not null and queried_at is not null and size(result_doc_ids) > 0").select("id", "user_id", "queried_at", F.col("result_doc_ids").alias("docs"))
    r = stage(numbered(s.select("id", "user_id", "queried_at", "docs"), ["user_id"], ["queried_at", "id"], "k"))
    h = lambda kind: F.conv(F.substring(F.md5(F.concat(F.lit(f"{kind}:"), "id")), 1, 8), 16, 10).cast("bigint")
    c = h("kind") % 100
    new = r.select(F.col("id").alias("after_session"), "user_id", (h("search") % F.col("k") + 1).alias("k"), h("doc").alias("b"), F.when(c < 60, "click").when(c < 85, "thumbs_up").otherwise("thumbs_down").alias("feedback_type"))
    old = r.select(F.col("id").alias("session_id"), "user_id", "k", "docs")
    doc = F.element_at("docs", (F.col("b") % F.size("docs") + 1).cast("int"))
    return new.join(old, ["user_id", "k"]).select("after_session", "session_id", norm_id(doc).alias("document_id"), "feedback_type")


@CORE.add("drift_scores", "select event_id, round(abs(value - m) / d, 6) as score, abs(value - m) / d > 3 as is_drift from events, (select avg(value) as m, stddev_pop(value) as d from events where event_id % 2 = 0 and value is not null) where value is not null")
def drift_scores(spark, sf_dir):
    """Events scored against a reference apart from the path they are served on, by a stream of its own over their log.

    The reference is the even ids' mean and deviation; the stream joins its one row.
    """
    e = read_table(spark, sf_dir, "events")
    reference = e.where("event_id % 2 = 0 and value is not null").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("d"))
    base = f"{shared_dir(spark)}/scores-{uuid.uuid4().hex}"
    log = spark.readStream.schema(e.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    return replayed(score_stream(log, reference, "value").select("event_id", F.round("score", 6).alias("score"), "is_drift"), base)


@CORE.add(
    "event_sessions",
    """with f as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end as s from events), g as (select *, sum(s) over (partition by user_id order by ts rows unbounded preceding) as k from f)
    select user_id, min(ts) as start, max(ts) + interval 30 minutes as "end", count(*) as n from g group by user_id, k""",
)
def event_sessions(spark, sf_dir):
    """Session windows of each user in batch form; a gap of 30 minutes parts. By slabs, so no user is one task; the stream's form is ``session_windows``."""
    e = _events(spark, sf_dir).where("user_id is not null").groupBy("user_id", F.unix_micros("ts").alias("us")).agg(F.count("*").alias("n"))
    s = by_gap(e, gap_us=GAP_US - 1)
    ntz = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return s.select("user_id", ntz(F.col("start_us")).alias("start"), ntz(F.col("end_us") + GAP_US).alias("end"), F.col("n_events").alias("n"))


@CORE.add("stream_replay", "select event_type, count(*) as n, round(sum(value), 4) as total from events group by 1")
def stream_replay(spark, sf_dir):
    """The events replayed as a stream into a table, equal to the batch result."""
    base = f"{shared_dir(spark)}/replay-{uuid.uuid4().hex}"
    src = read_table(spark, sf_dir, "events")
    stream = spark.readStream.schema(src.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    return replayed(stream, base).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
