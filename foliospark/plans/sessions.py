"""p4: searches of each user in sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import norm_id, sql_hex, sql_id
from ..functions.times import micros
from ..operators.sessions import distinct_events, marked_events, sessions
from ..session import read_table
from .registry import CORE

_EVENTS_SQL = f"""
once as (select {sql_hex('id')} as k, min(row(epoch_us(queried_at), {sql_id('user_id')})) as e from query_sessions
         where queried_at is not null and {sql_hex('user_id')} is not null group by 1),
ev as (select struct_extract_at(e, 2) as user_id, struct_extract_at(e, 1) as us from once),
lagged as (select user_id, us, case when us - lag(us) over (partition by user_id order by us) <= 1800000000 then 0 else 1 end as st from ev),
numbered as (select user_id, us, sum(st) over (partition by user_id order by us rows unbounded preceding) as s from lagged)
"""


def _events(spark, sf_dir):
    q = read_table(spark, sf_dir, "query_sessions")
    return q.select(norm_id("id").alias("id"), norm_id("user_id").alias("user_id"), micros("queried_at").alias("us"), "query_text")


@CORE.add("p4_found", f"with {_EVENTS_SQL} select user_id, min(us) as start_us, max(us) as end_us, count(*) as n_queries from numbered group by user_id, s")
def p4_found(spark, sf_dir):
    """Every session of every user: first and last search in microseconds and the number of searches."""
    s = sessions(distinct_events(_events(spark, sf_dir), "id", "user_id", "us"))
    return s.select("user_id", "start_us", "end_us", F.col("n_events").cast("bigint").alias("n_queries"))


@CORE.add(
    "p4_sessions",
    f"with {_EVENTS_SQL} select user_id, cast(s as bigint) as session_no, min(us) as start_us, max(us) as end_us, max(us) - min(us) as duration_us, count(*) as n_queries from numbered group by user_id, s",
)
def p4_sessions(spark, sf_dir):
    """Sessions with number and duration."""
    s = sessions(distinct_events(_events(spark, sf_dir), "id", "user_id", "us"))
    return s.select("user_id", "session_no", "start_us", "end_us", (F.col("end_us") - F.col("start_us")).alias("duration_us"), F.col("n_events").alias("n_queries"))


@CORE.add(
    "p4_queries",
    f"""with {_EVENTS_SQL},
    texts as (select {sql_id('id')} as id, min(row(epoch_us(queried_at), {sql_id('user_id')}, query_text)) as e from query_sessions where queried_at is not null and {sql_hex('user_id')} is not null and {sql_hex('id')} is not null group by 1
      union all select null, row(epoch_us(queried_at), {sql_id('user_id')}, query_text) from query_sessions where queried_at is not null and {sql_hex('user_id')} is not null and {sql_hex('id')} is null)
    select struct_extract_at(t.e, 2) as user_id, cast(n.s as bigint) as session_no, struct_extract_at(t.e, 1) as us, t.id, struct_extract_at(t.e, 3) as query_text
    from texts t join (select distinct user_id, us, s from numbered) n on struct_extract_at(t.e, 2) = n.user_id and struct_extract_at(t.e, 1) = n.us""",
)
def p4_queries(spark, sf_dir):
    """The query_texts of each session, a row for each search, so no session is gathered whole."""
    e = _events(spark, sf_dir).where("user_id is not null and us is not null")
    once = e.where("id is not null").groupBy("id").agg(F.min(F.struct("us", "user_id", "query_text")).alias("e")).select("id", "e.*")
    once = once.unionByName(e.where("id is null"))  # each of these is a search of its own, as in distinct_events
    m = marked_events(distinct_events(e, "id", "user_id", "us")).select("user_id", "us", F.col("start_rank").alias("session_no"))
    return once.join(m, ["user_id", "us"]).select("user_id", "session_no", "us", "id", "query_text")
